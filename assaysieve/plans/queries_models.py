"""Queries over model fitting, validation and explanation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from assaysieve.operators import explain, histogram_trees, kernels, linear, support_vectors, target_statistics, tree_paths, trees, validate, views
from assaysieve.operators.skew import lookup_join
from assaysieve.plans import experiments
from assaysieve.plans.registry import FEATURES, PARTS_SQL, TARGETS, parts, query, rounded, table


# Long targets with one feature x; the fold is the part key modulo 5, which both engines compute alike.
_LONG = "WITH " + PARTS_SQL + """,
long AS (
  SELECT p_partkey, p_brand, CAST(p_partkey % 5 AS INTEGER) AS fold, 'discount_pct' AS target, size, price, qty, size AS x, discount_pct AS y FROM train
  UNION ALL SELECT p_partkey, p_brand, CAST(p_partkey % 5 AS INTEGER), 'return_pct', size, price, qty, size, return_pct FROM train)
"""


def _train(spark, folder):
    """The measured parts, kept: every pass after the first reads one row per part instead of all order lines."""
    return parts(spark, folder).persist()


def _folded(spark, folder):
    return _train(spark, folder).withColumn("fold", F.pmod("p_partkey", F.lit(5)).cast("int"))


def _full_fits(spark, folder, features, models):
    degree = max(linear.LINEAR_MODELS[m].degree for m in models)
    return linear.solve(linear.gram(parts(spark, folder), features, TARGETS, degree=degree), features, models)


@query("ols_1d", _LONG + """
SELECT target, count(*) AS n, round(regr_intercept(y, x), 6) AS intercept, round(regr_slope(y, x), 6) AS slope FROM long GROUP BY target""")
def ols_1d(spark, folder):
    fits = _full_fits(spark, folder, ["size"], ["Linear Regression"])
    shown = fits.select("target", F.col("n").cast("bigint").alias("n"), "intercept", F.col("weights")[0].alias("slope"))
    return rounded(shown, "intercept", "slope")


_TWO = """,
c AS (SELECT target, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS aa, covar_pop(a, b) AS ab, covar_pop(b, b) AS bb,
        covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM pairs GROUP BY target),
w AS (SELECT *, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM c)
SELECT target, round(my - wa * ma - wb * mb, 5) AS intercept, round(wa, 6) AS w1, round(wb, 6) AS w2 FROM w"""


def _two_weights(fits):
    shown = fits.select("target", F.round("intercept", 5).alias("intercept"), F.col("weights")[0].alias("w1"), F.col("weights")[1].alias("w2"))
    return rounded(shown, "w1", "w2")


@query("ols_2d", _LONG + ", pairs AS (SELECT target, size AS a, qty AS b, y FROM long)" + _TWO)
def ols_2d(spark, folder):
    return _two_weights(_full_fits(spark, folder, ["size", "qty"], ["Linear Regression"]))


@query("polynomial_regression", _LONG + ", pairs AS (SELECT target, size AS a, size * size AS b, y FROM long)" + _TWO)
def polynomial_regression(spark, folder):
    return _two_weights(_full_fits(spark, folder, ["size"], ["Polynomial Regression"]))


_ONE = """, c AS (SELECT target, count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, x) * count(*) AS g, covar_pop(x, y) * count(*) AS b
  FROM long GROUP BY target), w AS (SELECT *, {weight} AS w FROM c)
SELECT target, round(my - w * mx, 6) AS intercept, round(w, 6) AS slope FROM w"""


@query("ridge_regression", _LONG + _ONE.format(weight="b / (g + 1)"))
def ridge_regression(spark, folder):
    fits = _full_fits(spark, folder, ["size"], ["Ridge"])
    return rounded(fits.select("target", "intercept", F.col("weights")[0].alias("slope")), "intercept", "slope")


@query("lasso_regression", _LONG + _ONE.format(weight="sign(b) * greatest(abs(b) - n * CAST(0.1 AS DOUBLE), 0) / g"))
def lasso_regression(spark, folder):
    fits = _full_fits(spark, folder, ["size"], ["Lasso"])
    return rounded(fits.select("target", "intercept", F.col("weights")[0].alias("slope")), "intercept", "slope")


@query("linear_family")
def linear_family(spark, folder):
    """Four features, all linear models, every fold: not expressible as plain SQL."""
    fits = linear.fit_folds(_folded(spark, folder), FEATURES, TARGETS, list(linear.LINEAR_MODELS), "fold")
    return fits.select("target", "fold", "model", "n", "intercept", "weights", "status")


@query("two_feature_folds", _LONG + """,
spec AS (SELECT * FROM (VALUES ('Linear Regression', CAST(0 AS DOUBLE)), ('Ridge', CAST(1 AS DOUBLE))) AS t(model, a)),
folds AS (SELECT DISTINCT fold FROM long UNION ALL SELECT -1),
c AS (SELECT l.target, f.fold, model, count(*) AS n, avg(size) AS ma, avg(qty) AS mb, avg(y) AS my, covar_pop(size, size) * count(*) + a AS aa,
        covar_pop(size, qty) * count(*) AS ab, covar_pop(qty, qty) * count(*) + a AS bb, covar_pop(size, y) * count(*) AS ay, covar_pop(qty, y) * count(*) AS by_
      FROM folds f JOIN long l ON l.fold <> f.fold, spec GROUP BY l.target, f.fold, model, a),
w AS (SELECT *, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM c)
SELECT target, CAST(fold AS INTEGER) AS fold, model, n, round(my - wa * ma - wb * mb, 6) AS intercept, round(wa, 6) AS w_size, round(wb, 6) AS w_qty FROM w""")
def two_feature_folds(spark, folder):
    """Least squares and ridge on two features: the full fits and those without each fold."""
    fits = linear.fit_folds(_folded(spark, folder), ["size", "qty"], TARGETS, ["Linear Regression", "Ridge"], "fold")
    shown = fits.select("target", "fold", "model", F.col("n").cast("bigint").alias("n"), "intercept", F.col("weights")[0].alias("w_size"), F.col("weights")[1].alias("w_qty"))
    return rounded(shown, "intercept", "w_size", "w_qty")


_OOF = _LONG + """,
full_fit AS (SELECT target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM long GROUP BY target),
fold_fit AS (SELECT f.fold, l.target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i
             FROM (SELECT DISTINCT fold FROM long) f JOIN long l ON l.fold <> f.fold GROUP BY f.fold, l.target),
oof AS (SELECT l.*, a.i + a.s * x AS yhat_train, c.i + c.s * x AS yhat_cv
        FROM long l JOIN full_fit a USING (target) JOIN fold_fit c USING (target, fold))
"""
_METRICS = """round(1 - sum((y - yhat_train) * (y - yhat_train)) / (var_pop(y) * count(*)), 6) AS train_r2,
  round(1 - sum((y - yhat_cv) * (y - yhat_cv)) / (var_pop(y) * count(*)), 6) AS cv_r2,
  round(sqrt(avg((y - yhat_cv) * (y - yhat_cv))), 6) AS cv_rmse, round(avg(abs(y - yhat_cv)), 6) AS cv_mae"""
_SCORES = ["train_r2", "cv_r2", "cv_rmse", "cv_mae"]


def _oof(spark, folder, feature="size"):
    train = _folded(spark, folder)
    fits = linear.fit_folds(train, [feature], TARGETS, ["Linear Regression"], "fold").persist()
    return linear.out_of_fold(train, fits, [feature], TARGETS, ["Linear Regression"], "fold", keep=["p_partkey"])


@query("kfold_predictions", _OOF + """
SELECT p_partkey, target, fold, y, round(yhat_train, 6) AS yhat_train, round(yhat_cv, 6) AS yhat_cv FROM oof""")
def kfold_predictions(spark, folder):
    return rounded(_oof(spark, folder).drop("model"), "yhat_train", "yhat_cv")


@query("kfold_cv_metrics", _OOF + f"SELECT target, 'Linear Regression' AS model, count(*) AS n, {_METRICS}, 'ok' AS status FROM oof GROUP BY target")
def kfold_cv_metrics(spark, folder):
    return rounded(validate.metrics(_oof(spark, folder)), *_SCORES)


@query("loocv_metrics", _LONG + """,
s AS (SELECT p_brand, target, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
        regr_slope(y, x) AS fs, regr_intercept(y, x) AS fi FROM long GROUP BY p_brand, target),
r AS (SELECT l.*, fs, fi, n - 1 AS m, sx - x AS ax, sy - y AS ay, sxx - x * x AS axx, sxy - x * y AS axy FROM long l JOIN s USING (p_brand, target)),
e AS (SELECT *, (m * axy - ax * ay) / (m * axx - ax * ax) AS ls FROM r),
oof AS (SELECT p_brand, target, y, fi + fs * x AS yhat_train, (ay - ls * ax) / m + ls * x AS yhat_cv FROM e)
SELECT p_brand, target, 'Linear Regression' AS model, count(*) AS n, """ + _METRICS.replace(", 6)", ", 5)") + """, 'ok' AS status FROM oof GROUP BY p_brand, target""")
def loocv_metrics(spark, folder):
    train = _train(spark, folder)
    sums = linear.gram(train, ["size"], TARGETS, ["p_brand"])
    fits = linear.solve(sums, ["size"], ["Linear Regression"], ["p_brand"]).persist()
    oof = linear.leave_one_out(train, fits, ["size"], TARGETS, ["p_brand"])
    return rounded(validate.metrics(oof, ["p_brand"]), *_SCORES, digits=5)


_EXPERIMENTS_SQL = _LONG + """,
typed AS (SELECT l.*, t.p_type FROM long l JOIN train t USING (p_partkey)),
spec AS (SELECT * FROM (VALUES ('Linear Regression', CAST(0 AS DOUBLE)), ('Ridge', CAST(1 AS DOUBLE))) AS t(model, a)),
full_fit AS (SELECT p_type, target, model, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) / (covar_pop(x, x) * count(*) + a) AS s
             FROM typed, spec GROUP BY p_type, target, model, a),
fold_fit AS (SELECT l.p_type, f.fold, l.target, model, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) / (covar_pop(x, x) * count(*) + a) AS s
             FROM (SELECT DISTINCT p_type, fold FROM typed) f JOIN typed l ON l.p_type = f.p_type AND l.fold <> f.fold, spec
             GROUP BY l.p_type, f.fold, l.target, model, a),
oof AS (SELECT l.*, a.model, a.my + a.s * (x - a.mx) AS yhat_train, k.my + k.s * (x - k.mx) AS yhat_cv
        FROM typed l JOIN full_fit a USING (p_type, target) JOIN fold_fit k ON k.p_type = l.p_type AND k.target = l.target AND k.fold = l.fold AND k.model = a.model),
scores AS (SELECT p_type, target, model, count(*) AS n, 1 - sum((y - yhat_train) * (y - yhat_train)) / (var_pop(y) * count(*)) AS train_r2,
  1 - sum((y - yhat_cv) * (y - yhat_cv)) / (var_pop(y) * count(*)) AS cv_r2, sqrt(avg((y - yhat_cv) * (y - yhat_cv))) AS cv_rmse
  FROM oof GROUP BY p_type, target, model)
"""


def _experiments(spark, folder):
    """A type of part is an experiment."""
    return experiments.train_experiments(_folded(spark, folder), ["size"], TARGETS, ["p_type"], ["Linear Regression", "Ridge"], "p_partkey", fold=F.col("fold"))


@query("experiment_scores", _EXPERIMENTS_SQL + "SELECT p_type, target, model, n, round(cv_r2, 4) AS cv_r2, round(cv_rmse, 4) AS cv_rmse FROM scores")
def experiment_scores(spark, folder):
    return rounded(_experiments(spark, folder).scores.select("p_type", "target", "model", "n", "cv_r2", "cv_rmse"), "cv_r2", "cv_rmse", digits=4)


@query("experiment_predictions", _EXPERIMENTS_SQL + """,
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY p_type, target ORDER BY
  CASE WHEN train_r2 - cv_r2 > 0.4 AND cv_r2 < 0.5 THEN 1 ELSE 0 END, cv_r2 DESC, model) = 1),
library AS (SELECT p_partkey, p_type, CAST(p_size AS DOUBLE) AS x FROM part)
SELECT p_partkey, b.target, b.model, round(my + s * (x - mx), 4) AS prediction, round(1.96 * cv_rmse, 4) AS half_width
FROM library l LEFT JOIN best b USING (p_type) LEFT JOIN full_fit f ON f.p_type = b.p_type AND f.target = b.target AND f.model = b.model""")
def experiment_predictions(spark, folder):
    library = table(spark, folder, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("size"))
    scored = experiments.screen_experiments(_experiments(spark, folder), library, ["p_partkey"])
    return rounded(scored.drop("p_type"), "prediction", "half_width", digits=4)


@query("fold_sizes", """
WITH f AS (SELECT p_brand, CAST(ntile(5) OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS fold FROM part)
SELECT p_brand, fold, count(*) AS n FROM f GROUP BY p_brand, fold""")
def fold_sizes(spark, folder):
    train = parts(spark, folder, "left").select("p_brand", "p_partkey")
    return validate.assign_folds(train, "p_partkey", 5, by=["p_brand"]).groupBy("p_brand", "fold").agg(F.count("*").alias("n"))


@query("left_out_numbers", """
SELECT p_brand, count(*) AS n, CAST(0 AS INTEGER) AS low, CAST(count(*) - 1 AS INTEGER) AS high, count(*) AS folds FROM part GROUP BY p_brand""")
def left_out_numbers(spark, folder):
    """Leave-one-out folds number the rows of each experiment without gap or repeat."""
    numbered = validate.assign_folds(parts(spark, folder, "left").select("p_brand", "p_partkey"), "p_partkey", None, by=["p_brand"])
    return numbered.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.min("fold").alias("low"), F.max("fold").alias("high"), F.countDistinct("fold").alias("folds"))


def _candidates(spark, folder):
    """One single-feature model per descriptor, scored by 5 folds: all from the sums of one pass, and scored in one more."""
    names = ["size", "price", "qty"]
    train = _folded(spark, folder)
    sums = linear.gram(train, names, TARGETS, fold="fold")
    fits = linear.solve_subsets(linear.training_sums(sums), names, {c: [c] for c in names})
    oof = linear.out_of_fold(train, fits, names, TARGETS, ["Linear Regression"], "fold", keep=["p_partkey"])
    return names, validate.metrics(oof)


def _candidate_sql():
    parts_ = []
    for c in ("size", "price", "qty"):
        source = f"(SELECT p_partkey, fold, target, {c} AS x, y FROM long)"
        parts_.append(f"""SELECT target, '{c}' AS model, {_METRICS} FROM (
  SELECT l.*, a.i + a.s * x AS yhat_train, k.i + k.s * x AS yhat_cv FROM {source} l
  JOIN (SELECT target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM {source} GROUP BY target) a USING (target)
  JOIN (SELECT f.fold, l2.target, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM (SELECT DISTINCT fold FROM long) f
        JOIN {source} l2 ON l2.fold <> f.fold GROUP BY f.fold, l2.target) k USING (target, fold)) GROUP BY target""")
    return _LONG + ", scores AS (" + "\nUNION ALL ".join(parts_) + ")\n"


@query("model_comparison", _candidate_sql() + """
SELECT target, model, cv_r2, CASE WHEN cv_r2 < 0.4 THEN 'red' WHEN cv_r2 < 0.7 THEN 'yellow' ELSE 'green' END AS quality FROM scores""")
def model_comparison(spark, folder):
    return rounded(views.model_comparison(_candidates(spark, folder)[1]), "cv_r2")


@query("best_model", _candidate_sql() + """
SELECT target, model, train_r2, cv_r2, cv_rmse, cv_mae, (train_r2 - cv_r2) > 0.4 AND cv_r2 < 0.5 AS is_overfit FROM scores
QUALIFY row_number() OVER (PARTITION BY target ORDER BY cv_r2 DESC) = 1""")
def best_model(spark, folder):
    names, scores = _candidates(spark, folder)
    return rounded(validate.best_models(scores, names).drop("n", "status"), *_SCORES)


_BEST_OOF = _OOF + """, m AS (SELECT target, """ + _METRICS + """ FROM oof GROUP BY target)"""


@query("actual_vs_predicted", _BEST_OOF + """
SELECT p_partkey, target, 'Linear Regression' AS model, y, round(yhat_train, 6) AS yhat_train, round(yhat_cv, 6) AS yhat_cv, train_r2, cv_rmse
FROM oof JOIN m USING (target)""")
def actual_vs_predicted(spark, folder):
    oof = _oof(spark, folder)
    best = validate.best_models(validate.metrics(oof), ["Linear Regression"])
    return rounded(views.actual_vs_predicted(oof, best, keep=["p_partkey"]), "yhat_train", "yhat_cv", "train_r2", "cv_rmse")


@query("plot_bounds", _OOF + """
SELECT target, round(least(min(y), min(yhat_train)), 6) AS low, round(greatest(max(y), max(yhat_train)), 6) AS high FROM oof GROUP BY target""")
def plot_bounds(spark, folder):
    return rounded(views.plot_bounds(_oof(spark, folder)), "low", "high")


def _scaled(spark, folder):
    """Every measured part with its features on comparable scales; a brand is an experiment."""
    scaled = [((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in (("size", 25.0, 14.0), ("qty", 25.0, 3.0))]
    return _train(spark, folder).select("p_partkey", "p_brand", *scaled, *TARGETS)


@query("gp_fit")
def gp_fit(spark, folder):
    fits = kernels.fit_kernels(_scaled(spark, folder), ["size", "qty"], TARGETS, ["gaussian_process"], ["p_brand"])
    return fits.select("p_brand", "target", "model", "n", "amplitude", "centre", "spread", "status")


@query("gp_fit_score")
def gp_fit_score(spark, folder):
    train = _scaled(spark, folder)
    fits = kernels.fit_kernels(train, ["size", "qty"], TARGETS, ["gaussian_process"], ["p_brand"])
    return kernels.score_kernels(train, fits, ["size", "qty"], ["p_partkey"], ["p_brand"])


@query("kernel_ridge")
def kernel_ridge(spark, folder):
    train = _scaled(spark, folder).withColumn("fold", validate.hashed_fold("p_partkey", 5))
    oof = kernels.kernel_out_of_fold(train, ["size", "qty"], TARGETS, ["kernel_ridge", "gaussian_process"], "fold", "p_partkey", ["p_brand"])
    return validate.metrics(oof, ["p_brand"])


# Parts in experiments of two rows (or one), where both kernel models have a closed form: k is the kernel of the pair, d half the difference.
_PAIRS_SQL = "WITH " + PARTS_SQL + """,
rows AS (SELECT p_partkey, p_partkey // 2 AS pair, (size - 25) / 14 AS x, return_pct AS y FROM train),
pairs AS (SELECT pair, count(*) AS n, avg(y) AS m, max(x) - min(x) AS dx, var_pop(x) AS vx, stddev_pop(y) AS sd FROM rows GROUP BY pair),
"""


def _pairs(spark, folder):
    x = ((F.col("size") - 25.0) / 14.0).alias("x")
    return _train(spark, folder).select("p_partkey", F.floor(F.col("p_partkey") / 2).alias("pair"), x, F.col("return_pct").alias("y"))


@query("kernel_ridge_pairs", _PAIRS_SQL + """
k AS (SELECT *, CASE WHEN vx > 0 THEN exp(-dx * dx / vx) ELSE 1.0 END AS k FROM pairs)
SELECT p_partkey, round(m + (y - m) * (1 - k) / (2 - k), 6) AS prediction FROM rows JOIN k USING (pair)""")
def kernel_ridge_pairs(spark, folder):
    rows = _pairs(spark, folder)
    fits = kernels.fit_kernels(rows, ["x"], ["y"], ["kernel_ridge"], ["pair"])
    return rounded(kernels.score_kernels(rows, fits, ["x"], ["p_partkey"], ["pair"]).select("p_partkey", "prediction"), "prediction")


@query("support_vector_pairs", _PAIRS_SQL + """
k AS (SELECT pair, n, m, CASE WHEN vx > 0 THEN exp(-dx * dx / vx) ELSE 1.0 END AS k, ds FROM pairs
      JOIN (SELECT pair, max(y) - min(y) AS ds FROM rows GROUP BY pair) USING (pair)),
t AS (SELECT *, CASE WHEN ds <= 0.2 THEN 0 WHEN k = 1 THEN 1 ELSE least((ds - 0.2) / (2 - 2 * k), 1) END AS t FROM k)
SELECT p_partkey, round(m + sign(y - m) * t * (1 - k), 5) AS prediction FROM rows JOIN t USING (pair)""")
def support_vector_pairs(spark, folder):
    """Support-vector regression over pairs of parts, whose dual has one unknown."""
    rows = _pairs(spark, folder)
    models = support_vectors.fit_support_vectors(rows, ["x"], ["y"], "p_partkey", by=["pair"], tolerance=1e-9).models
    scored = support_vectors.score_experiments(rows, models, ["x"], ["p_partkey"], ["pair"])
    return rounded(scored.select("p_partkey", "prediction"), "prediction", digits=5)


@query("support_vectors")
def support_vector_metrics(spark, folder):
    """Every brand's support-vector regression, cross-validated."""
    fitted = support_vectors.fit_support_vectors(_scaled(spark, folder).withColumn("fold", F.pmod("p_partkey", F.lit(5)).cast("int")), ["size", "qty"], ["return_pct"], "p_partkey", "fold", ["p_brand"])
    return validate.metrics(fitted.predictions, ["p_brand"])


@query("gp_pairs", _PAIRS_SQL + """
k AS (SELECT *, exp(-0.5 * dx * dx) AS k, 1 + 0.01 + 0.000001 AS a, CASE WHEN sd > 0 THEN sd ELSE 1.0 END AS s FROM pairs)
SELECT p_partkey, round(CASE WHEN n = 2 THEN m + (y - m) * (1 - k) / (a - k) ELSE m END, 5) AS prediction,
  round(s * sqrt(1 + 0.01 - CASE WHEN n = 2 THEN (a - 2 * k * k + a * k * k) / (a * a - k * k) ELSE 1 / a END), 5) AS deviation
FROM rows JOIN k USING (pair)""")
def gp_pairs(spark, folder):
    """Gaussian processes of fixed amplitude 1 over pairs of parts."""
    rows = _pairs(spark, folder)
    fits = kernels.fit_kernels(rows, ["x"], ["y"], ["gaussian_process"], ["pair"], bounds=(1.0, 1.0))
    return rounded(kernels.score_kernels(rows, fits, ["x"], ["p_partkey"], ["pair"]).select("p_partkey", "prediction", "deviation"), "prediction", "deviation", digits=5)


def _tree_scores(spark, folder, kind, features, **options):
    model = trees.fit_tree(_train(spark, folder), features, "return_pct", kind, **options)
    return trees.score_tree(parts(spark, folder, "left").select("p_partkey", *features), model, features).select("p_partkey", "yhat")


def _tree_models(spark, folder, kind, features, **options):
    return histogram_trees.fit_trees(_train(spark, folder), features, ["return_pct"], [kind], "p_partkey", options={kind: options}).models


def _library_scores(spark, folder, model, features):
    return histogram_trees.score_trees(parts(spark, folder, "left").select("p_partkey", *features), model, features).select("p_partkey", "yhat")


@query("forest")
def forest(spark, folder):
    return _library_scores(spark, folder, _tree_models(spark, folder, "random_forest", FEATURES), FEATURES)


@query("gbt")
def gbt(spark, folder):
    return _library_scores(spark, folder, _tree_models(spark, folder, "second_order", FEATURES), FEATURES)


@query("leaf_wise_boosting")
def leaf_wise_boosting(spark, folder):
    return _library_scores(spark, folder, _tree_models(spark, folder, "leaf_wise", FEATURES, one_sided=(0.2, 0.1)), FEATURES)


@query("symmetric_boosting")
def symmetric_boosting(spark, folder):
    return _library_scores(spark, folder, _tree_models(spark, folder, "symmetric", FEATURES), FEATURES)


@query("tree_metrics")
def tree_metrics(spark, folder):
    kind = validate.resolve_model("XGBoost").fitted_as
    fitted = histogram_trees.fit_trees(_folded(spark, folder), FEATURES, ["return_pct"], [kind], "p_partkey", "fold")
    return validate.metrics(fitted.predictions.replace(kind, "XGBoost", "model")).withColumn("fitted_as", F.lit(kind))


def _best_split_sql(name: str, source: str) -> str:
    """The split of `source` (size, y) between two neighbouring sizes with the least squared error, and the means of both sides."""
    return f"""
{name}_sums AS (SELECT size, count(*) AS n, sum(y) AS s FROM {source} GROUP BY size),
{name}_left AS (SELECT size, sum(n) OVER (ORDER BY size) AS nl, sum(s) OVER (ORDER BY size) AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s,
    lead(size) OVER (ORDER BY size) AS next FROM {name}_sums),
{name} AS (SELECT (size + next) / 2 AS cut, sl / nl AS below, (s - sl) / (n - nl) AS above FROM {name}_left
    WHERE next IS NOT NULL ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, size LIMIT 1),
"""


_STUMP_SQL = "WITH " + PARTS_SQL + ", measured AS (SELECT size, return_pct AS y FROM train)," + _best_split_sql("one", "measured") + """
library AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size FROM part),
first AS (SELECT p_partkey, size, CASE WHEN size <= cut THEN below ELSE above END AS yhat FROM library, one)
"""


def _boosted_split_sql(name: str, source: str, group: str, penalty: float, rate: float, least: float = 0) -> str:
    """Per group the split of `source` (size, g) between two sizes with the largest gain in g, and the steps of both sides."""
    own = f"{group}, " if group else ""
    over = f"PARTITION BY {group} " if group else ""
    return f"""
{name}_sums AS (SELECT {own}size, CAST(count(*) AS DOUBLE) AS n, sum(g) AS s FROM {source} GROUP BY {own}size),
{name}_left AS (SELECT *, sum(n) OVER ({over}ORDER BY size) AS nl, sum(s) OVER ({over}ORDER BY size) AS sl, sum(n) OVER ({over}) AS nt, sum(s) OVER ({over}) AS st,
    lead(size) OVER ({over}ORDER BY size) AS next FROM {name}_sums),
{name}_gain AS (SELECT *, sl * sl / (nl + {penalty}) + (st - sl) * (st - sl) / (nt - nl + {penalty}) - st * st / (nt + {penalty}) AS gain FROM {name}_left
    WHERE next IS NOT NULL AND least(nl, nt - nl) >= {least}),
{name} AS (SELECT {own}(size + next) / 2 AS cut, -{rate} * sl / (nl + {penalty}) AS below, -{rate} * (st - sl) / (nt - nl + {penalty}) AS above FROM {name}_gain
    QUALIFY row_number() OVER ({over}ORDER BY gain DESC, size) = 1),
"""


_ROUNDS = {"second_order": (1.0, 0.3, 1), "leaf_wise": (0.0, 0.1, 20), "symmetric": (3.0, 0.1, 0)}


def _boosting_sql() -> str:
    steps, union = [], []
    for kind, setting in _ROUNDS.items():
        one, two = f"{kind}_one", f"{kind}_two"
        steps.append(_boosted_split_sql(one, "sloped", "", *setting))
        steps.append(f"{kind}_left_over AS (SELECT size, g + CASE WHEN size <= cut THEN below ELSE above END AS g FROM sloped, {one}),")
        steps.append(_boosted_split_sql(two, f"{kind}_left_over", "", *setting))
        union.append(f"""SELECT p_partkey, '{kind}' AS model, round(m + CASE WHEN size <= a.cut THEN a.below ELSE a.above END + CASE WHEN size <= b.cut THEN b.below ELSE b.above END, 6) AS yhat
FROM library, mean, {one} AS a, {two} AS b""")
    return ("WITH " + PARTS_SQL + """, mean AS (SELECT avg(return_pct) AS m FROM train), sloped AS (SELECT size, m - return_pct AS g FROM train, mean),
library AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size FROM part),""" + "".join(steps).rstrip().rstrip(",") + "\n" + "\nUNION ALL ".join(union))


def _two_rounds(spark, folder, local_rows=histogram_trees.LOCAL_ROWS):
    options = {"second_order": {"trees": 2, "depth": 1}, "leaf_wise": {"trees": 2, "leaves": 2}, "symmetric": {"trees": 2, "depth": 1}}
    models = histogram_trees.fit_trees(_train(spark, folder), ["size"], ["return_pct"], list(options), "p_partkey", options=options, local_rows=local_rows).models
    scored = histogram_trees.score_experiments(parts(spark, folder, "left").select("p_partkey", "size"), models, ["size"], ["p_partkey"], [])
    return rounded(scored.select("p_partkey", "model", F.col("prediction").alias("yhat")), "yhat")


@query("boosting_kinds", _boosting_sql())
def boosting_kinds(spark, folder):
    """Two rounds of one split of each kind of boosting: curvature with a leaf penalty, best-first leaves, symmetric trees."""
    return _two_rounds(spark, folder)


@query("boosting_by_levels", _boosting_sql())
def boosting_by_levels(spark, folder):
    """The same rounds over a table that no task holds: every sum is a job."""
    return _two_rounds(spark, folder, local_rows=1)


_BRAND_STUMPS_SQL = "WITH " + PARTS_SQL + """, means AS (SELECT p_brand, avg(return_pct) AS m FROM train GROUP BY p_brand),
sloped AS (SELECT p_brand, size, m - return_pct AS g FROM train JOIN means USING (p_brand)),
library AS (SELECT p_partkey, p_brand, CAST(p_size AS DOUBLE) AS size FROM part),""" + _boosted_split_sql("one", "sloped", "p_brand", 0.0, 1.0).rstrip().rstrip(",")


@query("experiment_trees", _BRAND_STUMPS_SQL + """
SELECT p_partkey, p_brand, 'return_pct' AS target, 'random_forest' AS model, round(m + CASE WHEN size <= cut THEN below ELSE above END, 6) AS prediction
FROM library JOIN means USING (p_brand) JOIN one USING (p_brand)""")
def experiment_trees(spark, folder):
    """A forest of one whole-sample split for every brand, fitted and applied together."""
    trained = experiments.train_experiments(_folded(spark, folder), ["size"], ["return_pct"], ["p_brand"], ["Random Forest"], "p_partkey", fold=F.col("fold"),
                                            tree_options={"random_forest": {"trees": 1, "depth": 1, "resampled": False}})
    library = table(spark, folder, "part").select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("size"))
    return rounded(experiments.screen_experiments(trained, library, ["p_partkey"]).drop("half_width"), "prediction")


@query("target_statistics", "WITH " + PARTS_SQL + """,
placed AS (SELECT *, (p_partkey * 7919) % 100003 AS place FROM train)
SELECT p_partkey, round((coalesce(sum(return_pct) OVER w, 0) + (SELECT avg(return_pct) FROM train)) / (count(*) OVER w + 1), 6) AS p_brand_mean,
  round((coalesce(sum(return_pct) OVER t, 0) + (SELECT avg(return_pct) FROM train)) / (count(*) OVER t + 1), 6) AS p_type_mean
FROM placed WINDOW w AS (PARTITION BY p_brand ORDER BY place, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  t AS (PARTITION BY p_type ORDER BY place, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_statistics(spark, folder):
    """Brand and type as the mean return of the parts before, in an order that has nothing to do with returns."""
    order = (F.col("p_partkey") * 7919) % 100003
    found = target_statistics.ordered_statistics(_train(spark, folder), ["p_brand", "p_type"], "return_pct", "p_partkey", order)
    return rounded(found.select("p_partkey", "p_brand_mean", "p_type_mean"), "p_brand_mean", "p_type_mean")


@query("forest_stump", _STUMP_SQL + "SELECT p_partkey, round(yhat, 6) AS yhat FROM first")
def forest_stump(spark, folder):
    """A forest of one tree of one split over all rows: its split is the best one."""
    return rounded(_tree_scores(spark, folder, "random_forest", ["size"], numTrees=1, maxDepth=1, bootstrap=False), "yhat")


@query("boosted_stumps", "WITH " + PARTS_SQL + ", measured AS (SELECT size, return_pct AS y FROM train)," + _best_split_sql("one", "measured") + """
left_over AS (SELECT size, 2 * (y - CASE WHEN size <= cut THEN below ELSE above END) AS y FROM measured, one),""" + _best_split_sql("two", "left_over") + """
library AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size FROM part)
SELECT p_partkey, round(CASE WHEN size <= one.cut THEN one.below ELSE one.above END + 0.3 * CASE WHEN size <= two.cut THEN two.below ELSE two.above END, 6) AS yhat
FROM library, one, two""")
def boosted_stumps(spark, folder):
    """Two rounds of boosting with one split each; the second follows the slope of the squared error, at the step size."""
    return rounded(_tree_scores(spark, folder, "gbt", ["size"], maxIter=2, maxDepth=1), "yhat")


_SHAP_FEATURES = ["size", "qty"]
_SHAP_SQL = "WITH " + PARTS_SQL + """,
c AS (SELECT avg(size) AS ma, avg(qty) AS mb, covar_pop(size, size) AS aa, covar_pop(size, qty) AS ab, covar_pop(qty, qty) AS bb,
        covar_pop(size, return_pct) AS ay, covar_pop(qty, return_pct) AS by_ FROM train),
w AS (SELECT ma, mb, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM c),
shap AS (SELECT p_partkey, wa * (size - ma) AS phi_size, wb * (qty - mb) AS phi_qty FROM train, w)
"""


def _linear_fit(train):
    return linear.solve(linear.gram(train, _SHAP_FEATURES, ["return_pct"]), _SHAP_FEATURES, ["Linear Regression"]).first()


def _linear_shap(spark, folder):
    train = _train(spark, folder)
    fit = _linear_fit(train)
    return explain.linear_shap(train, _SHAP_FEATURES, fit["weights"], fit["means"], ["p_partkey"])


@query("linear_shap", _SHAP_SQL + "SELECT p_partkey, round(phi_size, 6) AS phi_size, round(phi_qty, 6) AS phi_qty FROM shap")
def linear_shap(spark, folder):
    return rounded(_linear_shap(spark, folder), "phi_size", "phi_qty")


@query("shap_importance", _SHAP_SQL + """
SELECT 'size' AS feature, round(avg(abs(phi_size)), 6) AS importance FROM shap
UNION ALL SELECT 'qty', round(avg(abs(phi_qty)), 6) FROM shap""")
def shap_importance(spark, folder):
    return rounded(explain.importance(_linear_shap(spark, folder), _SHAP_FEATURES), "importance")


@query("shap_long", _SHAP_SQL + """
SELECT p_partkey, 'size' AS feature, round(phi_size, 6) AS phi FROM shap UNION ALL SELECT p_partkey, 'qty', round(phi_qty, 6) FROM shap""")
def shap_long(spark, folder):
    return rounded(explain.shap_long(_linear_shap(spark, folder), _SHAP_FEATURES, ["p_partkey"]), "phi")


@query("kernel_shap_linear", _SHAP_SQL + "SELECT p_partkey, round(phi_size, 6) AS phi_size, round(phi_qty, 6) AS phi_qty FROM shap")
def kernel_shap_linear(spark, folder):
    """Enumeration against the mean of the parts: equals the closed form."""
    train = _train(spark, folder)
    fit = _linear_fit(train)
    points, share = np.array([list(fit["means"])]), np.ones(1)
    intercept, weights = fit["intercept"], np.array(fit["weights"])
    shap = explain.kernel_shap(train, _SHAP_FEATURES, lambda x: intercept + x @ weights, points, share, ["p_partkey"])
    return rounded(shap.drop("base"), "phi_size", "phi_qty")


@query("kernel_shap")
def kernel_shap(spark, folder):
    """Kernel ridge on all measured parts, explained for every part against a 10-centre summary."""
    train = _train(spark, folder)
    fit = kernels.unpack(kernels.fit_kernels(train, _SHAP_FEATURES, ["return_pct"], ["kernel_ridge"]).first())
    points, share = explain.background(train, _SHAP_FEATURES)
    return explain.kernel_shap(train, _SHAP_FEATURES, lambda x: kernels.kernel_predict(fit, x)[0], points, share, ["p_partkey"])


_MANY = 20
_MANY_SQL = "WITH " + PARTS_SQL + ", " + f"""
wide AS (SELECT p_partkey, j, CAST((p_partkey * (j + 3)) % 17 AS DOUBLE) AS x FROM train, (SELECT unnest(range({_MANY})) AS j)),
means AS (SELECT j, avg(x) AS m FROM wide GROUP BY j)
"""


@query("shap_regression", _MANY_SQL + """
SELECT p_partkey, 'f' || CAST(j AS VARCHAR) AS feature, round((j - 9) * (x - m), 6) AS phi, CAST(0 AS DOUBLE) AS error FROM wide JOIN means USING (j)""")
def shap_regression(spark, folder):
    """A linear model of 20 features by constrained regression over drawn coalitions: equals the closed form, without error."""
    names = [f"f{j}" for j in range(_MANY)]
    wide = _train(spark, folder).select("p_partkey", *[((F.col("p_partkey") * (j + 3)) % 17).cast("double").alias(f"f{j}") for j in range(_MANY)])
    means = np.array([list(wide.agg(*[F.avg(c) for c in names]).first())])
    weights = np.arange(_MANY) - 9.0
    shap = explain.kernel_shap(wide, names, lambda x: x @ weights, means, np.ones(1), ["p_partkey"])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"phi_{c}").alias("phi"), F.col(f"error_{c}").alias("error")) for c in names])).alias("e")
    # Adding 0.0 makes a rounded minus zero plain.
    return shap.select("p_partkey", pairs).select("p_partkey", "e.feature", (F.round("e.phi", 6) + 0.0).alias("phi"), (F.round("e.error", 6) + 0.0).alias("error"))


@query("background_point", "WITH " + PARTS_SQL + """, c AS (SELECT avg(size) AS ms, avg(qty) AS mq FROM train)
SELECT (SELECT size FROM train, c ORDER BY abs(size - ms), size LIMIT 1) AS size, round((SELECT qty FROM train, c ORDER BY abs(qty - mq), qty LIMIT 1), 6) AS qty,
  CAST(1 AS DOUBLE) AS share, (SELECT count(*) FROM train) AS n""")
def background_point(spark, folder):
    """The background of one centre: per feature the observed value nearest to the mean."""
    train = _train(spark, folder)
    points, share = explain.background(train, _SHAP_FEATURES, k=1)
    summary = train.agg(F.count("*").alias("n"))
    return summary.select(F.lit(float(points[0, 0])).alias("size"), F.round(F.lit(float(points[0, 1])), 6).alias("qty"), F.lit(float(share[0])).alias("share"), "n")


@query("strategy_metrics", _OOF + f"SELECT target, 'Neural Networks' AS model, 'Linear Regression' AS fitted_as, count(*) AS n, {_METRICS}, 'ok' AS status FROM oof GROUP BY target")
def strategy_metrics(spark, folder):
    """A strategy chosen by its name and an unknown model name, which is fitted as least squares."""
    choice, folds = validate.resolve_model("Neural Networks"), validate.fold_count("5-Fold CV")
    train = _train(spark, folder).withColumn("fold", F.pmod("p_partkey", F.lit(folds)).cast("int"))
    fits = linear.fit_folds(train, ["size"], TARGETS, [choice.fitted_as], "fold").persist()
    oof = linear.out_of_fold(train, fits, ["size"], TARGETS, [choice.fitted_as], "fold", keep=["p_partkey"])
    scores = validate.metrics(oof).withColumnRenamed("model", "fitted_as").withColumn("model", F.lit(choice.asked))
    return rounded(scores, *_SCORES)


@query("tree_shap")
def tree_shap(spark, folder):
    return tree_paths.explain_trees(_train(spark, folder), FEATURES, _tree_models(spark, folder, "second_order", FEATURES), ["p_partkey"])


@query("path_shap", _boosting_sql().split("second_order_two_sums")[0].rsplit("second_order_left_over", 1)[0].rstrip().rstrip(",") + """,
shares AS (SELECT avg(CASE WHEN size <= cut THEN below ELSE above END) AS b FROM train, second_order_one)
SELECT p_partkey, round(CASE WHEN size <= cut THEN below ELSE above END - b, 6) AS phi_size, CAST(0 AS DOUBLE) AS phi_qty, round(m + b, 6) AS base
FROM train, mean, second_order_one, shares""")
def path_shap(spark, folder):
    """One boosted split on size, explained along its paths in shares that meet the rows in groups."""
    train = _train(spark, folder).withColumn("_flat", F.lit(0.0))
    models = histogram_trees.fit_trees(train, ["size", "_flat"], ["return_pct"], ["second_order"], "p_partkey", options={"second_order": {"trees": 1, "depth": 1}}).models
    shap = tree_paths.explain_trees(train, ["size", "_flat"], models, ["p_partkey"], limit=1).withColumnRenamed("phi__flat", "phi_qty")
    return rounded(shap, "phi_size", "phi_qty", "base")


@query("stump_shap", _STUMP_SQL + """
SELECT p_partkey, round(CASE WHEN size <= cut THEN below ELSE above END - m, 6) AS phi_size, CAST(0 AS DOUBLE) AS phi_qty, round(m, 6) AS base
FROM train, one, (SELECT avg(y) AS m FROM measured)""")
def stump_shap(spark, folder):
    """One split on size: the value is the distance from the mean of the training rows, and a feature without a split has none."""
    train = _train(spark, folder).withColumn("_flat", F.lit(0.0))
    model = trees.fit_tree(train, ["size", "_flat"], "return_pct", "random_forest", numTrees=1, maxDepth=1, bootstrap=False)
    shap = explain.tree_shap(train, ["size", "_flat"], model, ["p_partkey"]).withColumnRenamed("phi__flat", "phi_qty")
    return rounded(shap, "phi_size", "phi_qty", "base")


@query("feature_map", "WITH " + PARTS_SQL + """,
c AS (SELECT avg(size) AS ma, avg(qty) AS mb, covar_pop(size, size) AS a, covar_pop(size, qty) AS b, covar_pop(qty, qty) AS d FROM train),
l AS (SELECT *, (a + d) / 2 + sqrt(pow((a - d) / 2, 2) + b * b) AS l1, (a + d) / 2 - sqrt(pow((a - d) / 2, 2) + b * b) AS l2 FROM c),
v AS (SELECT *, (l1 - d) / sqrt(pow(l1 - d, 2) + b * b) AS u, b / sqrt(pow(l1 - d, 2) + b * b) AS w FROM l),
library AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size FROM part)
SELECT p_partkey, round(u * (size - ma) + w * (qty - mb), 6) AS pc1, round(-w * (size - ma) + u * (qty - mb), 6) AS pc2, 'training' AS kind,
  round(l1 / (l1 + l2), 6) AS explained_1, round(l2 / (l1 + l2), 6) AS explained_2 FROM train, v
UNION ALL SELECT p_partkey, round(u * (size - ma) - w * mb, 6), round(-w * (size - ma) - u * mb, 6), 'novel',
  round(l1 / (l1 + l2), 6), round(l2 / (l1 + l2), 6) FROM library, v""")
def feature_map(spark, folder):
    train = _train(spark, folder)
    library = parts(spark, folder, "left").select("p_partkey", "size")
    mapped = views.feature_map(train, library, ["size", "qty"], ["p_partkey"])
    return rounded(mapped, "pc1", "pc2", "explained_1", "explained_2")
