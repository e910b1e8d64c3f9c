"""Queries over scoring, measured values, desirability and ranking. The library is all documents; labels are measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaysieve.functions.exprs import percent_text, percent_value
from assaysieve.operators import linear, score, validate, views
from assaysieve.plans import persistence, screening, training
from assaysieve.plans.registry import DOC_TARGETS, DOCS_SQL, PARTS_SQL, TARGETS, doc_library, doc_measured, parts, query, table
from assaysieve.session import scratch_path

_MODEL_SQL = "WITH " + DOCS_SQL + """,
long AS (
  SELECT entity, CAST(doc_id % 5 AS INTEGER) AS fold, chars AS x, 'quality_pct' AS target, quality_pct AS y FROM measured
  UNION ALL SELECT entity, CAST(doc_id % 5 AS INTEGER), chars, 'clean_pct', clean_pct FROM measured),
full_fit AS (SELECT target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i, min(y) AS low, max(y) AS high FROM long GROUP BY target),
fold_fit AS (SELECT f.fold, l.target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i
             FROM (SELECT DISTINCT fold FROM long) f JOIN long l ON l.fold <> f.fold GROUP BY f.fold, l.target),
rmse AS (SELECT l.target, sqrt(avg(pow(y - k.i - k.s * x, 2))) AS e FROM long l JOIN fold_fit k USING (target, fold) GROUP BY l.target),
model AS (SELECT * FROM full_fit JOIN rmse USING (target)),
q AS (SELECT * FROM model WHERE target = 'quality_pct'), t AS (SELECT * FROM model WHERE target = 'clean_pct')
"""
_SCORED_SQL = _MODEL_SQL + """,
scored AS (
  SELECT library.entity, m.entity IS NOT NULL AS measured,
    coalesce(round_even(m.quality_pct, 1), round_even(q.i + q.s * library.chars, 1)) AS "quality_pct_Prediction",
    CASE WHEN m.entity IS NOT NULL THEN 0 ELSE round_even(1.96 * q.e, 1) END AS "quality_pct_Uncertainty",
    coalesce(round_even(m.clean_pct, 1), round_even(t.i + t.s * library.chars, 1)) AS "clean_pct_Prediction",
    CASE WHEN m.entity IS NOT NULL THEN 0 ELSE round_even(1.96 * t.e, 1) END AS "clean_pct_Uncertainty",
    q.low AS ql, q.high AS qh, t.low AS tl, t.high AS th
  FROM library LEFT JOIN measured m ON library.entity = m.entity, q, t),
ranked AS (
  SELECT * EXCLUDE (ql, qh, tl, th), round_even(100 * sqrt(
      greatest(0.001, least(1, ("quality_pct_Prediction" - ql) / (qh - ql))) * greatest(0.001, least(1, ("clean_pct_Prediction" - tl) / (th - tl)))), 1) AS score
  FROM scored)
"""


def _doc_models(spark, folder):
    """Single-feature fits of both targets with their 5-fold error and range; a few numbers on the driver."""
    train = doc_measured(spark, folder).select("doc_id", "entity", "chars", *DOC_TARGETS).withColumn(
        "fold", F.pmod("doc_id", F.lit(5)).cast("int")
    ).persist()
    fits = linear.fit_folds(train, ["chars"], DOC_TARGETS, ["Linear Regression"], "fold").persist()
    oof = linear.out_of_fold(train, fits, ["chars"], DOC_TARGETS, ["Linear Regression"], "fold")
    error = {r["target"]: r["cv_rmse"] for r in validate.metrics(oof).collect()}
    full = {r["target"]: r for r in fits.where(F.col("fold") == linear.FULL).collect()}
    best = {
        t: training.Best(t, "Linear Regression", "Linear Regression", "linear", None, None, error[t], (full[t]["intercept"], full[t]["weights"]))
        for t in DOC_TARGETS
    }
    return train, best, score.target_bounds(train, DOC_TARGETS)


def _scored(spark, folder):
    train, best, bounds = _doc_models(spark, folder)
    predicted = screening.predict(doc_library(spark, folder), best, ["chars"], ["entity"])
    measured = score.measured_values(train, DOC_TARGETS, "doc_id", "entity")
    return train, score.desirability(score.override_measured(predicted, measured, DOC_TARGETS, "entity"), bounds)


@query("score_interval", _MODEL_SQL + """
SELECT entity, chars AS "LogP", round_even(q.i + q.s * chars, 1) AS "quality_pct_Prediction", round_even(1.96 * q.e, 1) AS "quality_pct_Uncertainty",
  round_even(t.i + t.s * chars, 1) AS "clean_pct_Prediction", round_even(1.96 * t.e, 1) AS "clean_pct_Uncertainty" FROM library, q, t""")
def score_interval(spark, folder):
    _, best, _ = _doc_models(spark, folder)
    library = doc_library(spark, folder).withColumn("LogP", F.col("chars"))
    return screening.predict(library.withColumn("LogP", score.carried_feature(library)), best, ["chars"], ["entity", "LogP"])


def _bounded(name, prefix):
    value = f"{prefix}.i + {prefix}.s * chars"
    return ", ".join(
        f"round_even(greatest(0, least(100, {value}{shift})), 1) AS \"{name}_{part}\""
        for part, shift in (("Prediction", ""), ("CI_Lower", f" - 1.96 * {prefix}.e"), ("CI_Upper", f" + 1.96 * {prefix}.e"))
    )


@query("score_bounded_class", _MODEL_SQL + f"""
SELECT *, CASE WHEN "quality_pct_Prediction" > 50 AND "clean_pct_Prediction" > 50 THEN 'Highly Compatible'
  WHEN "quality_pct_Prediction" > 20 OR "clean_pct_Prediction" > 20 THEN 'Moderately Compatible' ELSE 'Incompatible' END AS "Compatibility"
FROM (SELECT entity, {_bounded("quality_pct", "q")}, {_bounded("clean_pct", "t")} FROM library, q, t)""")
def score_bounded_class(spark, folder):
    _, best, _ = _doc_models(spark, folder)
    predicted = screening.predict(doc_library(spark, folder), best, ["chars"], ["entity"], (0.0, 100.0))
    return score.classify(predicted, DOC_TARGETS)


@query("measured_override", "WITH " + PARTS_SQL + """,
fit AS (SELECT regr_slope(discount_pct, size) AS s, regr_intercept(discount_pct, size) AS i, regr_slope(return_pct, size) AS s2,
          regr_intercept(return_pct, size) AS i2 FROM train),
lasts AS (SELECT lower(p_name) AS k, arg_max(discount_pct, p_partkey) AS d, arg_max(return_pct, p_partkey) AS r FROM train
          WHERE NOT contains(lower(p_name), 'red') GROUP BY 1)
SELECT p_partkey, p_name, k IS NOT NULL AS measured, coalesce(round_even(d, 1), round_even(i + s * p_size, 1)) AS "discount_pct_Prediction",
  CASE WHEN k IS NULL THEN CAST(3.9 AS DOUBLE) ELSE 0 END AS "discount_pct_Uncertainty",
  coalesce(round_even(r, 1), round_even(i2 + s2 * p_size, 1)) AS "return_pct_Prediction",
  CASE WHEN k IS NULL THEN CAST(3.9 AS DOUBLE) ELSE 0 END AS "return_pct_Uncertainty"
FROM part LEFT JOIN lasts ON k = lower(p_name), fit""")
def measured_override(spark, folder):
    """Names repeat across parts: the last measured part of a name counts. Names with "red" play the controls."""
    train = parts(spark, folder).persist()
    fits = linear.solve(linear.gram(train, ["size"], TARGETS), ["size"], ["Linear Regression"]).collect()
    best = {
        r["target"]: training.Best(r["target"], r["model"], r["model"], "linear", None, None, 2.0, (r["intercept"], r["weights"])) for r in fits
    }
    library = table(spark, folder, "part").select("p_partkey", "p_name", F.col("p_size").cast("double").alias("size"))
    predicted = screening.predict(library, best, ["size"], ["p_partkey", "p_name"])
    measured = score.measured_values(train, TARGETS, "p_partkey", "p_name", controls="red")
    return score.override_measured(predicted, measured, TARGETS, "p_name")


@query("desirability_rank", _SCORED_SQL + "SELECT *, row_number() OVER (ORDER BY score DESC, entity) AS rank FROM ranked")
def desirability_rank(spark, folder):
    return score.rank_all(_scored(spark, folder)[1], "entity")


@query("best_entity", _SCORED_SQL + "SELECT entity, score FROM ranked ORDER BY score DESC, entity LIMIT 1")
def best_entity(spark, folder):
    return score.best_entity(_scored(spark, folder)[1], "entity")


@query("novel_topk", _SCORED_SQL + """
SELECT entity, score FROM ranked WHERE entity NOT IN (SELECT entity FROM measured) ORDER BY score DESC, entity LIMIT 15""")
def novel_topk(spark, folder):
    train, scored = _scored(spark, folder)
    return views.novel_top(scored, train, 15, "entity").select("entity", "score")


@query("measured_vs_novel", _SCORED_SQL + """,
novel AS (SELECT * FROM ranked WHERE NOT measured ORDER BY score DESC, entity LIMIT 15)
SELECT entity, target, y AS value, CAST(0 AS DOUBLE) AS error, 'measured' AS origin FROM long
UNION ALL SELECT entity, 'quality_pct', "quality_pct_Prediction", "quality_pct_Uncertainty", 'novel' FROM novel
UNION ALL SELECT entity, 'clean_pct', "clean_pct_Prediction", "clean_pct_Uncertainty", 'novel' FROM novel""")
def measured_vs_novel(spark, folder):
    train, scored = _scored(spark, folder)
    return views.measured_vs_novel(scored, train, DOC_TARGETS, 15, "entity")


@query("top20_bars", _SCORED_SQL + """,
best AS (SELECT * FROM ranked ORDER BY score DESC, entity LIMIT 20)
SELECT entity, 'quality_pct' AS target, "quality_pct_Prediction" AS value, "quality_pct_Uncertainty" AS error FROM best
UNION ALL SELECT entity, 'clean_pct', "clean_pct_Prediction", "clean_pct_Uncertainty" FROM best""")
def top20_bars(spark, folder):
    return views.error_bars(_scored(spark, folder)[1], ["entity"])


@query("top_ranked", _SCORED_SQL + """
SELECT entity, printf('%.1f%%', score) AS "Overall_Compatibility", score AS parsed, CAST(row_number() OVER (ORDER BY score DESC, entity) AS INTEGER) AS rank
FROM ranked QUALIFY rank <= 3""")
def top_ranked(spark, folder):
    top = score.top_ranked(_scored(spark, folder)[1], 3, "entity").withColumn("Overall_Compatibility", percent_text("score"))
    return top.select("entity", "Overall_Compatibility", percent_value("Overall_Compatibility").alias("parsed"), "rank")


@query("measured_order", "WITH " + PARTS_SQL + """
SELECT p_partkey, return_pct, CAST(row_number() OVER (ORDER BY return_pct DESC, p_partkey) AS INTEGER) AS position FROM train QUALIFY position <= 15""")
def measured_order(spark, folder):
    return views.measured_order(parts(spark, folder), "return_pct", "p_partkey", 15)


@query("measured_positions", "WITH " + PARTS_SQL + """,
long AS (SELECT p_partkey, 'return_pct' AS target, return_pct AS value FROM train UNION ALL SELECT p_partkey, 'discount_pct', discount_pct FROM train)
SELECT p_partkey, target, value, CAST(row_number() OVER (PARTITION BY target ORDER BY value DESC, p_partkey) AS INTEGER) AS position
FROM long QUALIFY position <= 15""")
def measured_positions(spark, folder):
    return views.measured_positions(parts(spark, folder), ["return_pct", "discount_pct"], "p_partkey", 15)


@query("result_table", _SCORED_SQL + """,
shown AS (SELECT entity, "quality_pct_Prediction", score FROM ranked ORDER BY score DESC, entity LIMIT 100)
SELECT entity, 'https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound/smiles/' || replace(url_encode(entity), '%2F', '/') || '/PNG?record_type=3d&image_size=large' AS "Structure",
  "quality_pct_Prediction", score, printf('%.1f%%', score) AS "Overall_Compatibility" FROM shown""")
def result_table(spark, folder):
    """The hundred best documents as the screening page lists them; their names stand for identifiers."""
    best = score.top_ranked(_scored(spark, folder)[1], 100, "entity").withColumn("SMILES", F.col("entity"))
    return screening.result_table(best.select("entity", "SMILES", "quality_pct_Prediction", "score"), name="entity")


_END_SQL = "WITH " + DOCS_SQL + """,
med AS (SELECT median(blanks) AS m FROM measured),
filled AS (SELECT doc_id, entity, coalesce(blanks, m) AS b, quality_pct, clean_pct FROM measured, med),
st AS (SELECT avg(b) AS mu, stddev_pop(b) AS sd FROM filled),
long AS (
  SELECT CAST(doc_id % 5 AS INTEGER) AS fold, (b - mu) / sd AS x, 'quality_pct' AS target, quality_pct AS y FROM filled, st
  UNION ALL SELECT CAST(doc_id % 5 AS INTEGER), (b - mu) / sd, 'clean_pct', clean_pct FROM filled, st),
full_fit AS (SELECT target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i, min(y) AS low, max(y) AS high FROM long GROUP BY target),
fold_fit AS (SELECT f.fold, l.target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i
             FROM (SELECT DISTINCT fold FROM long) f JOIN long l ON l.fold <> f.fold GROUP BY f.fold, l.target),
rmse AS (SELECT l.target, sqrt(avg(pow(y - k.i - k.s * x, 2))) AS e FROM long l JOIN fold_fit k USING (target, fold) GROUP BY l.target),
model AS (SELECT * FROM full_fit JOIN rmse USING (target)),
q AS (SELECT * FROM model WHERE target = 'quality_pct'), t AS (SELECT * FROM model WHERE target = 'clean_pct'),
z AS (SELECT entity, coalesce(blanks, 0) AS "LogP", (coalesce(blanks, 0) - mu) / sd AS x FROM library, st),
scored AS (
  SELECT z.entity, z."LogP", m.entity IS NOT NULL AS measured,
    coalesce(round_even(m.quality_pct, 1), round_even(q.i + q.s * x, 1)) AS "quality_pct_Prediction",
    CASE WHEN m.entity IS NOT NULL THEN 0 ELSE round_even(1.96 * q.e, 1) END AS "quality_pct_Uncertainty",
    coalesce(round_even(m.clean_pct, 1), round_even(t.i + t.s * x, 1)) AS "clean_pct_Prediction",
    CASE WHEN m.entity IS NOT NULL THEN 0 ELSE round_even(1.96 * t.e, 1) END AS "clean_pct_Uncertainty",
    q.low AS ql, q.high AS qh, t.low AS tl, t.high AS th
  FROM z LEFT JOIN measured m ON z.entity = m.entity, q, t),
ranked AS (SELECT * EXCLUDE (ql, qh, tl, th), round_even(100 * sqrt(
      greatest(0.001, least(1, ("quality_pct_Prediction" - ql) / (qh - ql))) * greatest(0.001, least(1, ("clean_pct_Prediction" - tl) / (th - tl)))), 1) AS score
  FROM scored)
SELECT *, row_number() OVER (ORDER BY score DESC, entity) AS rank FROM ranked"""


def _end_trained(spark, folder):
    experiment = doc_measured(spark, folder).select(F.col("doc_id").alias("row_id"), "entity", F.col("blanks").alias("LogP"), *DOC_TARGETS)
    prepared = training.prepare_training(experiment, "entity", ids=["entity"])
    return training.train(prepared, ["Linear Regression"], "5-Fold CV", fold=F.pmod("row_id", F.lit(5)))


def _end_library(spark, folder):
    return doc_library(spark, folder).select("entity", F.col("blanks").alias("LogP"))


@query("screen_end_to_end", _END_SQL)
def screen_end_to_end(spark, folder):
    """Infer targets, impute, scale, select, fit, validate, choose, score the library, override, rank."""
    return screening.screen(_end_trained(spark, folder), _end_library(spark, folder), "entity")


@query("saved_screening", _END_SQL)
def saved_screening(spark, folder):
    """The same ranking by a model that was saved and loaded again."""
    path = scratch_path(spark, "saved-model")
    persistence.save(_end_trained(spark, folder), path)
    return screening.screen(persistence.load(spark, path), _end_library(spark, folder), "entity")
