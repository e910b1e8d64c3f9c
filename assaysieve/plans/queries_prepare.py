"""Queries over imputing, scaling, selection, profiling and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaysieve.operators import linear, prepare, profile
from assaysieve.operators import roles as R
from assaysieve.plans.registry import FEATURES, PARTS_SQL, TARGETS, parts, query, rounded, table

_Z = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in FEATURES)


def _scaled(spark, folder):
    train = parts(spark, folder).persist()
    return prepare.scale(train, prepare.fit_scaler(train, FEATURES))


@query("impute_median_mode", """
WITH holes AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price,
         CASE WHEN o_totalprice <= 400000 THEN o_orderstatus END AS status, CAST(NULL AS VARCHAR) AS remark FROM orders)
SELECT o_orderkey, coalesce(price, (SELECT median(price) FROM holes)) AS price,
  coalesce(status, (SELECT status FROM holes WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)) AS status,
  'Unknown' AS remark FROM holes""")
def impute_median_mode(spark, folder):
    holes = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_totalprice") <= 400000, F.col("o_orderstatus")).alias("status"), F.lit(None).cast("string").alias("remark"),
    )
    return prepare.impute(holes, prepare.fit_imputer(holes, ["price"], ["status", "remark"]))


@query("standard_scale", "WITH " + PARTS_SQL + f", z AS (SELECT p_partkey, {_Z} FROM train) SELECT p_partkey, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES) + " FROM z")
def standard_scale(spark, folder):
    return rounded(_scaled(spark, folder).select("p_partkey", *FEATURES), *FEATURES)


@query("outlier_ratio", """
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY event_type)
SELECT event_type, count(*) AS n_rows, round(count(*) FILTER (abs((value - m) / d) > 3) / CAST(count(*) AS DOUBLE), 6) AS outlier_ratio
FROM events JOIN s USING (event_type) GROUP BY event_type""")
def outlier_ratio(spark, folder):
    events = table(spark, folder, "events").select("event_type", "value")
    return rounded(profile.outlier_ratio(events, ["value"], by=["event_type"]), "outlier_ratio")


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_FAR = " + ".join(f"count(*) FILTER (abs(({c} - m{i}) / d{i}) > 3)" for i, c in enumerate(_NUMBERS))
_STATS = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(_NUMBERS))


@query("outlier_ratio_table", f"""
WITH s AS (SELECT {_STATS} FROM lineitem)
SELECT count(*) AS n_rows, round(({_FAR}) / CAST(count(*) * 4 AS DOUBLE), 6) AS outlier_ratio FROM lineitem, s""")
def outlier_ratio_table(spark, folder):
    return rounded(profile.outlier_ratio(table(spark, folder, "lineitem").select(*_NUMBERS)), "outlier_ratio")


@query("dataset_profile", "WITH " + PARTS_SQL + ", s AS (SELECT "
       + ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(FEATURES)) + """ FROM train),
r AS (SELECT count(*) AS n, """ + " + ".join(f"count(*) FILTER (abs(({c} - m{i}) / d{i}) > 3)" for i, c in enumerate(FEATURES)) + """ AS far FROM train, s)
SELECT n AS n_samples, 4 AS n_features, CAST(0 AS DOUBLE) AS missing_pct, round(far / CAST(n * 4 AS DOUBLE), 6) AS outlier_ratio,
  CASE WHEN n < 20 THEN 'Gaussian Process' WHEN n <= 50 THEN 'Random Forest|SVR|XGBoost|CatBoost'
       WHEN n <= 200 THEN 'Random Forest|XGBoost|LightGBM|CatBoost|Gaussian Process'
       ELSE 'Neural Networks|XGBoost|LightGBM|Random Forest' END AS models,
  CASE WHEN n < 20 THEN 'LOOCV' WHEN n <= 50 THEN '5-Fold CV' ELSE '10-Fold CV + Test Set' END AS validation_strategy
FROM r""")
def dataset_profile(spark, folder):
    shown = profile.dataset_profile(parts(spark, folder).persist(), FEATURES)
    return rounded(shown.withColumn("models", F.concat_ws("|", "models")), "outlier_ratio", "missing_pct")


@query("group_recommendation", """
SELECT p_brand, count(*) AS n, CASE WHEN count(*) < 20 THEN 'LOOCV' WHEN count(*) <= 50 THEN '5-Fold CV' ELSE '10-Fold CV + Test Set' END AS strategy,
  CASE WHEN count(*) < 20 THEN 1 WHEN count(*) <= 50 THEN 4 WHEN count(*) <= 200 THEN 5 ELSE 4 END AS n_models
FROM part GROUP BY p_brand""")
def group_recommendation(spark, folder):
    models, strategy = profile.recommendation_columns(F.col("n"))
    counted = table(spark, folder, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return counted.select("p_brand", "n", strategy.alias("strategy"), F.size(models).alias("n_models"))


@query("target_unpivot", "WITH " + PARTS_SQL + """
SELECT p_partkey, 'discount_pct' AS target, discount_pct AS y FROM train UNION ALL SELECT p_partkey, 'return_pct', return_pct FROM train""")
def target_unpivot(spark, folder):
    train = parts(spark, folder).select("p_partkey", *FEATURES, *TARGETS)
    targets = R.infer_targets(train, [*FEATURES, "p_partkey"])
    return linear.long_targets(train, targets, ["p_partkey"])


@query("constant_drop", "WITH " + PARTS_SQL + " SELECT p_partkey, size, price, qty, tax_pct FROM train")
def constant_drop(spark, folder):
    train = parts(spark, folder).select("p_partkey", *FEATURES).persist().withColumns(
        {"fifty": F.lit(50.0), "empty": F.lit(None).cast("double"), "one_text": F.when(F.col("size") > 9, "same")}
    )
    return train.drop(*prepare.constant_columns(train))


@query("mandated_features", "WITH " + PARTS_SQL + """
SELECT p_partkey, qty AS "Viscosity", size AS "LogP", price AS "Dielectric_Constant" FROM train""")
def mandated_features(spark, folder):
    train = parts(spark, folder).persist().select(
        "p_partkey", F.col("qty").alias("Viscosity"), F.lit(1.0).alias("Dynamic_Viscosity"), F.col("tax_pct").alias("Density"),
        F.col("size").alias("LogP"), F.col("price").alias("Dielectric_Constant"),
    )
    left = train.drop(*prepare.constant_columns(train))
    selected, missing = R.mandated_selection(left.columns, R.numeric_columns(left))
    assert missing == ["water_solubility"]
    return R.apply_selection(left, selected, ["p_partkey"])


@query("poly_features", "WITH " + PARTS_SQL + f""", z AS (SELECT p_partkey, {_Z} FROM train)
SELECT p_partkey, round(size, 6) AS "XLogP", round(price, 6) AS "Molecular_Weight", round(pow(size, 2), 6) AS "XLogP_squared",
  round(size * price, 6) AS "XLogP_x_MW" FROM z""")
def poly_features(spark, folder):
    scaled = _scaled(spark, folder).select("p_partkey", F.col("size").alias("XLogP"), F.col("price").alias("Molecular_Weight"))
    made = prepare.engineer(scaled, *prepare.default_engineering(scaled.columns))
    return rounded(made, *[c for c in made.columns if c != "p_partkey"])


_CORR = [*FEATURES, *TARGETS]


def _corr_sql(columns, source):
    pairs = [f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM {source}" for a in columns for b in columns]
    return "\nUNION ALL ".join(pairs)


@query("corr_matrix", "WITH " + PARTS_SQL + ", holes AS (SELECT * REPLACE (CASE WHEN size > 9 THEN qty END AS qty) FROM train)\n" + _corr_sql(_CORR, "holes")
       + "\nUNION ALL SELECT c, 'flat', NULL FROM (VALUES " + ", ".join(f"('{c}')" for c in [*_CORR, "flat"]) + ") v(c)"
       + "\nUNION ALL SELECT 'flat', c, NULL FROM (VALUES " + ", ".join(f"('{c}')" for c in _CORR) + ") v(c)")
def corr_matrix(spark, folder):
    train = parts(spark, folder).persist().withColumns({"qty": F.when(F.col("size") > 9, F.col("qty")), "flat": F.lit(3.0)})
    return rounded(profile.correlations(train, [*_CORR, "flat"]), "corr")


@query("corr_heatmap", _corr_sql(_NUMBERS, "lineitem"))
def corr_heatmap(spark, folder):
    return rounded(profile.correlation_heatmap(table(spark, folder, "lineitem").select(*_NUMBERS, "l_returnflag")), "corr")


@query("target_corr_rank", "WITH " + PARTS_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, discount_pct), 6) AS discount_pct, round(corr({c}, return_pct), 6) AS return_pct FROM train"
    for c in FEATURES))
def target_corr_rank(spark, folder):
    return rounded(profile.target_correlations(parts(spark, folder).select(*FEATURES, *TARGETS), TARGETS), *TARGETS)


_BINS_SQL = "WITH " + PARTS_SQL + """,
long AS (SELECT 'discount_pct' AS target, discount_pct AS v FROM train UNION ALL SELECT 'return_pct', return_pct FROM train),
s AS (SELECT target, count(*) AS n, min(v) AS low, max(v) AS high, stddev_samp(v) AS deviation,
        quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM long GROUP BY target),
w AS (SELECT *, least((high - low) / (log2(n) + 1), 2 * iqr / pow(n, CAST(1 AS DOUBLE) / 3)) AS w0 FROM s),
plan AS (SELECT *, CAST(ceil((high - low) / w0) AS INTEGER) AS bins, (high - low) / ceil((high - low) / w0) AS width FROM w)
"""


@query("target_histogram", _BINS_SQL + """,
cells AS (SELECT target, unnest(range(bins)) AS bin, low, width FROM plan),
hits AS (SELECT target, least(CAST(floor((v - low) / width) AS INTEGER), bins - 1) AS bin, count(*) AS n FROM long JOIN plan USING (target) GROUP BY ALL)
SELECT target, CAST(bin AS BIGINT) AS bin, round(low + bin * width, 6) AS bin_start, coalesce(hits.n, 0) AS n
FROM cells LEFT JOIN hits USING (target, bin)""")
def target_histogram(spark, folder):
    return rounded(profile.histogram(parts(spark, folder).select(*TARGETS).persist(), TARGETS), "bin_start")


@query("target_density", _BINS_SQL + """,
p AS (SELECT *, deviation * pow(n, CAST(-1 AS DOUBLE) / 5) AS h, (high - low) / 199 AS step FROM plan WHERE target = 'return_pct'),
grid AS (SELECT p.*, g, low + g * step AS x FROM p, (SELECT unnest(range(200)) AS g)),
curve AS (SELECT g, x, n, h, width, sum(exp(-pow((x - v) / h, 2) / 2)) / (n * h * sqrt(2 * pi())) AS density
          FROM grid JOIN long USING (target) GROUP BY g, x, n, h, width)
SELECT CAST(g AS INTEGER) AS grid_index, round(x, 6) AS x, round(density, 9) AS density, round(density * n * width, 6) AS scaled_count FROM curve""")
def target_density(spark, folder):
    curve = profile.density(parts(spark, folder).select("return_pct").persist(), "return_pct")
    return rounded(rounded(curve, "x", "scaled_count"), "density", digits=9)


@query("target_stats", "WITH " + PARTS_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS target, count({t}) AS n, min({t}) AS low, max({t}) AS high, round(avg({t}), 6) AS mean, round(stddev_samp({t}), 6) AS deviation FROM train"
    for t in TARGETS))
def target_stats(spark, folder):
    return rounded(profile.target_stats(parts(spark, folder), TARGETS), "mean", "deviation")
