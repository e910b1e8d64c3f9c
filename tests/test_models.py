from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaysieve.operators import explain, kernels, linear, trees, validate

FEATURES = ["a", "b", "c"]


def arrays(n=60, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 3 + x @ [1.5, -2.0, 0.0] + 0.3 * x[:, 0] * x[:, 1] + rng.normal(scale=0.2, size=n)
    return x, y


def frame(spark, x, y, folds=5):
    rows = [(i, i % folds, *map(float, r), float(t), float(-2 * t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "row_id int, fold int, a double, b double, c double, y1 double, y2 double").repartition(4)


def expand(x):
    return np.column_stack([x] + [x[:, i] * x[:, j] for i in range(x.shape[1]) for j in range(i, x.shape[1])])


def direct(x, y, model):
    """Intercept and weights by dense algebra."""
    if model == "Polynomial Regression":
        x = expand(x)
    m, t = x.mean(0), y.mean()
    if model == "Ridge":
        w = np.linalg.solve((x - m).T @ (x - m) + np.eye(x.shape[1]), (x - m).T @ (y - t))
    else:
        w = np.linalg.lstsq(x - m, y - t, rcond=None)[0]
    return t - m @ w, w


@pytest.fixture(scope="module")
def data(spark):
    x, y = arrays()
    return x, y, frame(spark, x, y).persist()


@pytest.mark.parametrize("model", ["Linear Regression", "Polynomial Regression", "Ridge"])
def test_all_folds_from_one_gram_equal_refits(data, model):
    x, y, df = data
    fits = {(r["target"], r["fold"]): r for r in linear.fit_folds(df, FEATURES, ["y1", "y2"], [model], "fold").collect()}
    assert len(fits) == 12
    folds = np.arange(len(y)) % 5
    for (target, fold), r in fits.items():
        keep = folds != fold
        b0, w = direct(x[keep], (y if target == "y1" else -2 * y)[keep], model)
        assert r["intercept"] == pytest.approx(b0, abs=1e-9) and r["weights"] == pytest.approx(w.tolist(), abs=1e-9)


def test_lasso_meets_its_optimality_conditions(data):
    x, y, df = data
    fit = linear.fit_folds(df, FEATURES, ["y1"], ["Lasso"], "fold").where(F.col("fold") == linear.FULL).first()
    w = np.array(fit["weights"])
    gradient = x.T @ (y - fit["intercept"] - x @ w) / len(y)
    active = w != 0
    assert active.tolist() == [True, True, False]
    assert gradient[active] == pytest.approx(0.1 * np.sign(w[active]), abs=1e-9)
    assert np.all(np.abs(gradient[~active]) <= 0.1 + 1e-9)


@pytest.mark.parametrize("model", ["Linear Regression", "Ridge", "Lasso"])
def test_single_feature_closed_form_equals_solver(data, model):
    x, y, df = data
    sums = linear.training_sums(linear.gram(df, ["a"], ["y1"], fold="fold"))
    closed = {r["fold"]: r for r in linear.solve_line(sums, [model]).collect()}
    for r in sums.collect():
        b0, w, _, inv = linear.solve_one(r["n"], np.array([r["sx_0"]]), np.array([[r["sxx_0_0"]]]), r["sy"], np.array([r["sxy_0"]]), linear.LINEAR_MODELS[model])
        c = closed[r["fold"]]
        assert (c["intercept"], c["weights"][0], c["precision"][0]) == pytest.approx((b0, w[0], inv[0, 0]), abs=1e-10)


def test_collinear_features_give_the_shortest_weights(spark):
    x, y = arrays(30)
    x[:, 2] = x[:, 0]
    fit = linear.fit_folds(frame(spark, x, y), FEATURES, ["y1"], ["Linear Regression"], "fold").where("fold = -1").first()
    assert fit["weights"] == pytest.approx(direct(x, y, "Linear Regression")[1].tolist(), abs=1e-8)


def test_constant_feature_gets_no_weight(spark):
    x, y = arrays(30)
    x[:, 1] = 0.1
    fits = linear.fit_folds(frame(spark, x, y), FEATURES, ["y1"], ["Linear Regression", "Lasso"], "fold").collect()
    assert all(abs(r["weights"][1]) < 1e-9 for r in fits)
    line = linear.solve_line(linear.gram(frame(spark, x, y), ["b"], ["y1"]))
    assert [(r["fold"], r["weights"]) for r in line.collect()] == [(linear.FULL, [0.0])]


def test_missing_targets_are_left_out(spark, data):
    x, y, df = data
    holes = df.withColumn("y1", F.when(F.col("row_id") >= 10, F.col("y1")))
    fit = linear.fit_folds(holes, FEATURES, ["y1", "y2"], ["Linear Regression"], "fold").where("fold = -1 and target = 'y1'").first()
    assert fit["n"] == 50 and fit["weights"] == pytest.approx(direct(x[10:], y[10:], "Linear Regression")[1].tolist(), abs=1e-9)


def test_empty_training_side_is_reported(spark):
    x, y = arrays(4)
    df = frame(spark, x, y).withColumn("fold", F.lit(0))
    status = {r["fold"]: r["status"] for r in linear.fit_folds(df, FEATURES, ["y1"], ["Ridge"], "fold").collect()}
    assert status[linear.FULL] == "ok" and status[0].startswith("error")


def test_out_of_fold_predictions(data):
    x, y, df = data
    models = ["Linear Regression", "Polynomial Regression"]
    fits = linear.fit_folds(df, FEATURES, ["y1"], models, "fold").persist()
    got = linear.out_of_fold(df, fits, FEATURES, ["y1"], models, "fold", keep=["row_id"]).collect()
    assert len(got) == 120
    folds = np.arange(len(y)) % 5
    for r in got:
        i = r["row_id"]
        for kind, keep in (("yhat_train", np.ones(len(y), bool)), ("yhat_cv", folds != folds[i])):
            b0, w = direct(x[keep], y[keep], r["model"])
            z = expand(x[i:i + 1]) if r["model"].startswith("Poly") else x[i:i + 1]
            assert r[kind] == pytest.approx(float(b0 + z[0] @ w), abs=1e-8)


@pytest.mark.parametrize("model", ["Linear Regression", "Ridge"])
def test_leave_one_out_needs_no_refit(spark, model):
    x, y = arrays(25)
    df = frame(spark, x, y)
    fits = linear.fit_folds(df, FEATURES, ["y1"], [model], "fold")
    got = linear.leave_one_out(df, fits, FEATURES, ["y1"], keep=["row_id"]).collect()
    for r in got:
        keep = np.arange(25) != r["row_id"]
        b0, w = direct(x[keep], y[keep], model)
        assert r["yhat_cv"] == pytest.approx(float(b0 + x[r["row_id"]] @ w), abs=1e-8)


def test_gram_exchanges_sums_not_rows(data):
    _, _, df = data
    plan = linear.training_sums(linear.gram(df, FEATURES, ["y1", "y2"], fold="fold"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") > 0 and "Cartesian" not in plan and "NestedLoop" not in plan


# Folds, metrics, choice

def test_strategies():
    assert [validate.fold_count(s) for s in ("LOOCV", "5-Fold CV", "10-Fold CV + Test Set", "other")] == [None, 5, 10, None]


def test_models_resolve():
    assert validate.resolve_model("Neural Networks").fitted_as == "Linear Regression"
    fitted = [validate.resolve_model(m).fitted_as for m in ("XGBoost", "LightGBM", "CatBoost", "Random Forest")]
    assert fitted == ["second_order", "leaf_wise", "symmetric", "random_forest"]
    assert validate.resolve_model("LightGBM", boosting="random_forest").fitted_as == "random_forest"


def test_fold_sizes_differ_by_at_most_one(spark):
    df = spark.range(23).select(F.col("id").alias("k"), (F.col("id") % 2).alias("g"))
    sizes = [r["count"] for r in validate.assign_folds(df, "k", 5).groupBy("fold").count().collect()]
    assert sorted(sizes) == [4, 4, 5, 5, 5]
    single = validate.assign_folds(df, "k", None)
    assert sorted(r["fold"] for r in single.collect()) == list(range(23))
    grouped = validate.assign_folds(df, "k", 5, by=["g"]).groupBy("g", "fold").count()
    assert grouped.agg(F.max("count") - F.min("count")).first()[0] == 1


@pytest.mark.parametrize("rows", [1, 4, 23, 5000])
def test_folds_follow_one_rule_at_every_size(spark, rows):
    """Folds are those of a plain sort by hash and key, however many rows there are."""
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    order = Window.partitionBy("g").orderBy(F.xxhash64(F.col("k"), F.lit(42)), "k")
    want = df.withColumns({"a": F.ntile(5).over(order) - 1, "b": F.row_number().over(order) - 1})
    got = validate.assign_folds(df, "k", 5, by=["g"]).join(validate.assign_folds(df, "k", None, by=["g"]).withColumnRenamed("fold", "single"), ["k", "g"])
    both = got.join(want, ["k", "g"])
    assert both.count() == rows and both.where("fold <> a or single <> b").count() == 0


def test_metrics_edges(spark):
    rows = [("flat_hit", 2.0, 2.0, 2.0), ("flat_hit", 2.0, 2.0, 2.0), ("flat_miss", 2.0, 2.0, 3.0), ("flat_miss", 2.0, 2.0, 2.0),
            ("gap", 1.0, 1.0, None), ("gap", 3.0, 3.0, 3.0), ("ok", 1.0, 1.0, 2.0), ("ok", 3.0, 3.0, 2.0)]
    df = spark.createDataFrame([("t", *r) for r in rows], "target string, model string, y double, yhat_train double, yhat_cv double")
    got = {r["model"]: r for r in validate.metrics(df).collect()}
    assert got["flat_hit"]["cv_r2"] == 1.0 and got["flat_miss"]["cv_r2"] == 0.0
    assert got["gap"]["cv_r2"] is None and got["gap"]["status"] == "incomplete"
    assert got["ok"]["cv_r2"] == 0.0 and got["ok"]["cv_rmse"] == 1.0 and got["ok"]["cv_mae"] == 1.0 and got["ok"]["train_r2"] == 1.0


def test_best_model_choice(spark):
    rows = [
        ("plain", "m1", 0.9, 0.6), ("plain", "m2", 0.9, 0.8), ("overfit", "m1", 1.0, 0.45), ("overfit", "m2", 0.5, 0.3),
        ("tie", "m2", 0.9, 0.7), ("tie", "m1", 0.9, 0.7), ("all_overfit", "m1", 1.0, 0.1), ("all_overfit", "m2", 1.0, 0.2),
        ("null", "m1", 0.9, None), ("null", "m2", 1.0, 0.1), ("negative", "m1", -0.5, -2.0), ("weak_only_gap", "m1", 1.0, 0.5),
    ]
    df = spark.createDataFrame(rows, "target string, model string, train_r2 double, cv_r2 double")
    got = {r["target"]: r["model"] for r in validate.best_models(df, ["m1", "m2"]).collect()}
    assert got == {"plain": "m2", "overfit": "m2", "tie": "m1", "all_overfit": "m2", "null": "m2", "negative": "m1", "weak_only_gap": "m1"}


# Kernels

def dense_gp(x, y, c):
    z = (y - y.mean()) / y.std()
    k = c * np.exp(-0.5 * kernels.squared_distances(x, x)) + (0.01 + 1e-6) * np.eye(len(y))
    sign, logdet = np.linalg.slogdet(k)
    return k, z, -0.5 * z @ np.linalg.solve(k, z) - 0.5 * logdet - len(y) / 2 * np.log(2 * np.pi)


def test_gaussian_process_against_dense_algebra():
    x, y = arrays(25)
    fit = kernels.fit_rows("gaussian_process", x, y)
    grid = np.exp(np.linspace(np.log(1e-5), np.log(1e5), 4001))
    best = grid[np.argmax([dense_gp(x, y, c)[2] for c in grid])]
    assert np.log(fit["amplitude"]) == pytest.approx(np.log(best), abs=0.01)
    k, z, _ = dense_gp(x, y, fit["amplitude"])
    new = arrays(5, seed=9)[0]
    ks = fit["amplitude"] * np.exp(-0.5 * kernels.squared_distances(new, x))
    mean, deviation = kernels.kernel_predict(fit, new)
    assert mean == pytest.approx(ks @ np.linalg.solve(k, z) * y.std() + y.mean(), abs=1e-8)
    variance = fit["amplitude"] + 0.01 - np.einsum("ij,ij->i", ks, np.linalg.solve(k, ks.T).T)
    assert deviation == pytest.approx(np.sqrt(variance) * y.std(), abs=1e-8)


def test_gaussian_process_amplitude_bounds_and_constant_target():
    x = np.array([[0.0], [1.0], [2.0]])
    fit = kernels.fit_rows("gaussian_process", x, np.array([4.0, 4.0, 4.0]))
    assert kernels.kernel_predict(fit, x)[0] == pytest.approx([4.0] * 3)
    assert 1e-5 <= fit["amplitude"] <= 1e5


def test_kernel_ridge_against_dense_algebra():
    x, y = arrays(20)
    fit = kernels.fit_rows("kernel_ridge", x, y)
    k = np.exp(-kernels.squared_distances(x, x) / (3 * x.var()))
    assert fit["dual"] == pytest.approx(np.linalg.solve(k + np.eye(20), y - y.mean()))


@pytest.mark.parametrize("rows", [12, 201, 3000])
def test_experiments_of_any_size_get_models(spark, rows):
    """Beyond the landmarks every row still counts: the model is the projected one, computed densely."""
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, 3))
    y = x @ [1.0, -2.0, 0.5] + np.sin(x[:, 0]) + rng.normal(size=rows) / 10
    df = frame(spark, x, y)
    fits = {r["model"]: r for r in kernels.fit_kernels(df, FEATURES, ["y1"], list(kernels.KERNEL_MODELS), landmarks=60, chunk_rows=500).collect()}
    for name in kernels.KERNEL_MODELS:
        assert (fits[name]["status"], fits[name]["n"], fits[name]["m"]) == ("ok", rows, min(rows, 60))
        fit = kernels.unpack(fits[name])
        z, gamma, c = fit["points"], fit["gamma"], fit["amplitude"]
        noise = kernels.RIDGE_STRENGTH if name == "kernel_ridge" else kernels.NOISE + kernels.JITTER
        spread = 1.0 if name == "kernel_ridge" else y.std()
        kzz, kzx = (c * np.exp(-gamma * kernels.squared_distances(z, o)) for o in (z, x))
        dense = np.linalg.lstsq(kzx @ kzx.T + noise * kzz, kzx @ (y - y.mean()) / spread, rcond=1e-13)[0]
        assert kernels.kernel_predict(fit, x)[0] == pytest.approx((dense @ kzx) * spread + y.mean(), abs=1e-4)
    oof = kernels.kernel_out_of_fold(df, FEATURES, ["y1"], list(kernels.KERNEL_MODELS), "fold", "row_id", landmarks=60, chunk_rows=500)
    assert oof.count() == 2 * rows and oof.where("yhat_cv is null").count() == 0


def test_replicates_beyond_the_landmarks_are_fitted_exactly(spark):
    """Rows of few distinct settings: one landmark per setting gives the model of all rows, for single features and hot settings too."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(40, 3)), [5] * 39 + [200], axis=0)
    y = x @ [1.0, -2.0, 0.5] + np.sin(x[:, 0]) + rng.normal(size=len(x)) / 10
    df = frame(spark, x, y)
    names = list(kernels.KERNEL_MODELS)
    for r in kernels.fit_kernels(df, FEATURES, ["y1"], names, landmarks=60, chunk_rows=100).collect():
        exact, fit = kernels.fit_rows(r["model"], x, y), kernels.unpack(r)
        assert (r["status"], r["n"], r["m"]) == ("ok", len(x), 40)
        for got, want in zip(kernels.kernel_predict(fit, x), kernels.kernel_predict(exact, x), strict=True):
            assert got is want is None or got == pytest.approx(want, abs=1e-5)
    single = {r["model"]: r for r in kernels.fit_kernels(df, ["a"], ["y1"], names, landmarks=60).collect()}
    assert {r["m"] for r in single.values()} == {40}
    folds = np.arange(len(x)) % 5
    for r in kernels.kernel_out_of_fold(df, FEATURES, ["y1"], ["kernel_ridge"], "fold", "row_id", landmarks=60, chunk_rows=100).where("row_id < 10").collect():
        keep = folds != r["fold"]
        refit = kernels.fit_rows(r["model"], x[keep], y[keep], gamma_of_all(r["model"], x))
        assert r["yhat_cv"] == pytest.approx(kernels.kernel_predict(refit, x[r["row_id"]:r["row_id"] + 1])[0][0], abs=1e-5)


def gamma_of_all(name, x):
    return kernels.gamma_of(name, x.shape[1], len(x), x.sum(), (x * x).sum())


def test_kernel_out_of_fold_equals_refits(spark):
    x, y = arrays(20)
    got = kernels.kernel_out_of_fold(frame(spark, x, y), FEATURES, ["y1"], ["kernel_ridge", "gaussian_process"], "fold", "row_id").collect()
    folds = np.arange(20) % 5
    assert len(got) == 40
    for r in got:
        keep = folds != r["fold"]
        fit = kernels.fit_rows(r["model"], x[keep], y[keep], gamma_of_all(r["model"], x))
        assert r["yhat_cv"] == pytest.approx(kernels.kernel_predict(fit, x[r["row_id"]:r["row_id"] + 1])[0][0], abs=1e-5)


def test_kernel_leave_one_out_equals_refits(spark):
    x, y = arrays(15)
    df = frame(spark, x, y).withColumn("fold", F.col("row_id").cast("int"))
    got = kernels.kernel_out_of_fold(df, FEATURES, ["y1"], list(kernels.KERNEL_MODELS), "fold", "row_id", single=True, chunk_rows=4).collect()
    assert len(got) == 30
    for r in got:
        keep = np.arange(15) != r["row_id"]
        fit = kernels.fit_rows(r["model"], x[keep], y[keep], gamma_of_all(r["model"], x))
        assert r["yhat_cv"] == pytest.approx(kernels.kernel_predict(fit, x[r["row_id"]:r["row_id"] + 1])[0][0], abs=1e-5)


def test_scoring_keeps_rows_with_gaps_and_without_models(spark):
    x, y = arrays(12)
    df = frame(spark, x, y).withColumn("g", F.lit("a"))
    fits = kernels.fit_kernels(df, FEATURES, ["y1"], ["gaussian_process"], ["g"])
    gap = df.withColumn(FEATURES[0], F.when(F.col("row_id") > 2, F.col(FEATURES[0])))
    library = gap.unionByName(df.where("row_id < 2").withColumn("g", F.lit("other")))
    rows = kernels.score_kernels(library, fits, FEATURES, ["row_id"], ["g"]).collect()
    assert len(rows) == 14
    assert sorted(r["row_id"] for r in rows if r["g"] == "a" and r["prediction"] is None) == [0, 1, 2]
    assert all(r["model"] is None and r["prediction"] is None for r in rows if r["g"] == "other")


def test_linear_leave_one_out_equals_refits(spark):
    x, y = arrays(14)
    df = frame(spark, x, y).withColumn("fold", F.col("row_id").cast("int"))
    names = ["Linear Regression", "Ridge", "Lasso", "Polynomial Regression"]
    sums = linear.gram(df, FEATURES, ["y1"], degree=2)
    by_sums = {(r["model"], r["row_id"]): r for r in linear.leave_one_out_refits(df, sums, FEATURES, ["y1"], names, ["row_id", "fold"]).collect()}
    by_folds = {(r["model"], r["row_id"]): r for r in linear.out_of_fold(
        df, linear.fit_folds(df, FEATURES, ["y1"], names, "fold"), FEATURES, ["y1"], names, "fold", keep=["row_id"]).collect()}
    assert by_sums.keys() == by_folds.keys() and len(by_sums) == 56
    for k, r in by_sums.items():
        assert (r["yhat_train"], r["yhat_cv"]) == pytest.approx((by_folds[k]["yhat_train"], by_folds[k]["yhat_cv"]), abs=1e-6)
    fits = linear.solve(sums, FEATURES, names)
    for degree, model in ((1, "Linear Regression"), (1, "Ridge")):
        got = linear.leave_one_out(df, fits.where(F.col("model") == model), FEATURES, ["y1"], keep=["row_id"], degree=degree).collect()
        assert len(got) == 14
        for r in got:
            assert r["yhat_cv"] == pytest.approx(by_folds[model, r["row_id"]]["yhat_cv"], abs=1e-7)


def test_chunked_scoring_equals_streaming(spark):
    x, y = arrays(30)
    df = frame(spark, x, y).withColumn("g", F.lit("only"))
    whole = kernels.fit_kernels(df, FEATURES, ["y1"], ["gaussian_process"])
    grouped = kernels.fit_kernels(df, FEATURES, ["y1"], ["gaussian_process"], ["g"])
    a = kernels.score_kernels(df, whole, FEATURES, ["row_id"]).orderBy("row_id").collect()
    b = kernels.score_kernels(df, grouped, FEATURES, ["row_id"], ["g"], chunk_rows=7).orderBy("row_id").collect()
    assert len(a) == len(b) == 30
    assert [r["prediction"] for r in a] == pytest.approx([r["prediction"] for r in b])
    assert [r["deviation"] for r in a] == pytest.approx([r["deviation"] for r in b])


# Trees

def test_trees_fit_and_validate(spark):
    x, y = arrays(80)
    df = frame(spark, x, y)
    forest, oof = trees.tree_out_of_fold(df, FEATURES, "y1", "random_forest", "fold", 5, ["row_id"], numTrees=20, maxDepth=6)
    row = validate.metrics(oof).first()
    assert row["n"] == 80 and row["train_r2"] > 0.8 and row["cv_r2"] > 0.4
    assert trees.score_tree(df, forest, FEATURES, "p").where("p is null").count() == 0
    with pytest.raises(ValueError):
        trees.estimator("unknown")


# Explanation

def test_enumeration_adds_up(spark):
    x, y = arrays(30)
    df = frame(spark, x, y)
    fit = kernels.fit_rows("kernel_ridge", x, y)
    points, share = explain.background(df, FEATURES, k=4)
    assert share.sum() == pytest.approx(1.0) and all(v in x[:, j] for j in range(3) for v in points[:, j])
    got = explain.kernel_shap(df, FEATURES, lambda z: kernels.kernel_predict(fit, z)[0], points, share, ["row_id"]).collect()
    value = kernels.kernel_predict(fit, x)[0]
    for r in got:
        assert r["base"] + sum(r[f"phi_{c}"] for c in FEATURES) == pytest.approx(value[r["row_id"]], abs=1e-9)


def test_enumeration_of_a_linear_model_is_its_closed_form(spark):
    x, y = arrays(20)
    df = frame(spark, x, y)
    w = np.array([1.0, -2.0, 0.5])
    points, share = np.array([[0.0, 1.0, 2.0], [1.0, 1.0, -1.0]]), np.array([0.25, 0.75])
    got = explain.kernel_shap(df, FEATURES, lambda z: 4 + z @ w, points, share, ["row_id"]).orderBy("row_id").collect()
    closed = explain.linear_shap(df, FEATURES, w, share @ points, ["row_id"]).orderBy("row_id").collect()
    for a, b in zip(got, closed, strict=True):
        assert [a[f"phi_{c}"] for c in FEATURES] == pytest.approx([b[f"phi_{c}"] for c in FEATURES])


def path_values_by_force(forest, row):
    """Shapley values over all orders, where an unknown feature follows both branches."""
    p = len(row)

    def value(known):
        total = 0.0
        for low, high, share, leaf in forest:
            for a, b, r, v in zip(low, high, share, leaf, strict=True):
                total += v * np.prod([float(a[j] < row[j] <= b[j]) if j in known else r[j] for j in range(p)])
        return total

    phi = np.zeros(p)
    orders = list(permutations(range(p)))
    for order in orders:
        for i, j in enumerate(order):
            phi[j] += (value(set(order[:i + 1])) - value(set(order[:i]))) / len(orders)
    return phi, value(set())


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_tree_explanation_follows_the_paths(spark, kind):
    x, y = arrays(40)
    df = frame(spark, x, y)
    model = trees.fit_tree(df, FEATURES, "y1", kind, maxDepth=4, **({"numTrees": 5} if kind == "random_forest" else {"maxIter": 4}))
    gap = df.withColumn(FEATURES[1], F.when(F.col("row_id") != 7, F.col(FEATURES[1])))
    both = explain.tree_shap(gap, FEATURES, model, ["row_id"]).join(trees.score_tree(gap, model, FEATURES).select("row_id", "yhat"), "row_id").collect()
    assert len(both) == 40
    forest = trees.leaves(model, 3, spark)
    for r in both:
        phi = [r[f"phi_{c}"] for c in FEATURES]
        if r["row_id"] == 7:
            assert phi == [None] * 3 and r["yhat"] is None
            continue
        assert r["base"] + sum(phi) == pytest.approx(r["yhat"], abs=1e-9)
        if r["row_id"] < 6:
            want, base = path_values_by_force(forest, x[r["row_id"]])
            assert phi == pytest.approx(want, abs=1e-9) and r["base"] == pytest.approx(base)


def test_importance_orders_features(spark):
    df = spark.createDataFrame([(1.0, -3.0), (-1.0, 3.0)], "phi_a double, phi_b double")
    assert [tuple(r) for r in explain.importance(df, ["a", "b"]).collect()] == [("b", 3.0), ("a", 1.0)]


def test_many_features_are_explained_by_regression(spark):
    """Values with errors: exact for what is linear in coalitions, within the errors for products."""
    rng = np.random.default_rng(2)
    names, w = [f"f{i}" for i in range(14)], rng.normal(size=14)
    x = rng.normal(size=(6, 14))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["row_id", *names])
    points, share = rng.normal(size=(2, 14)), np.array([0.5, 0.5])
    line, bent = (lambda z: z @ w), (lambda z: z @ w + z[:, 0] * z[:, 1] + np.maximum(z[:, 2], 0) * z[:, 3])
    for r in explain.kernel_shap(df, names, line, points, share, ["row_id"]).collect():
        row = x[r["row_id"]]
        assert [r[f"phi_{c}"] for c in names] == pytest.approx(list(w * (row - points.mean(0))), abs=1e-9)
        assert max(r[f"error_{c}"] for c in names) < 1e-9
    whole = {r["row_id"]: r for r in explain.kernel_shap(df, names, bent, points, share, ["row_id"], exact=True).collect()}
    assert "error_f0" not in whole[0].asDict()
    far = total = 0
    for r in explain.kernel_shap(df, names, bent, points, share, ["row_id"]).collect():
        phi, sure = ([q[f"phi_{c}"] for c in names] for q in (r, whole[r["row_id"]]))
        errors = [r[f"error_{c}"] for c in names]
        assert r["base"] + sum(phi) == pytest.approx(bent(x[r["row_id"]][None])[0])
        assert max(errors) <= explain.ERROR * (max(phi) - min(phi))
        far += sum(abs(a - b) > 2 * e + 1e-9 for a, b, e in zip(phi, sure, errors, strict=True))
        total += len(phi)
    assert far <= 0.15 * total
    one = explain.regression_values(lambda z: z[:, 0] ** 2, x[:, :1], points[:, :1], share)
    assert one[0][:, 0] == pytest.approx(x[:, 0] ** 2 - share @ points[:, 0] ** 2)


def test_many_small_experiments_share_a_group_of_a_task(spark):
    from assaysieve.operators import kernels

    rows = [(i, -0.0 if i == 0 else float(i // 2), (i * 7 % 11) / 3.0, (i * 5 % 13) / 2.0) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, pair double, x double, y double").repartition(3)
    fits = kernels.fit_kernels(df, ["x"], ["y"], ["gaussian_process", "kernel_ridge"], ["pair"], bounds=(1.0, 1.0))
    got = {(r["id"], r["model"]): r for r in kernels.score_kernels(df, fits, ["x"], ["id"], ["pair"]).collect()}
    assert len(got) == 1200
    for i in range(0, 600, 37):
        own = [r for r in rows if r[1] == rows[i][1]]
        x, y = np.array([[r[2]] for r in own]), np.array([r[3] for r in own])
        for model in kernels.KERNEL_MODELS:
            alone = kernels.fit_rows(model, x, y) if model == "kernel_ridge" else kernels.solve_kernel(model, x, 0.5, kernels.kernel_sums(x, y, x, 0.5), (1.0, 1.0))
            mean, deviation = kernels.kernel_predict(alone, np.array([[rows[i][2]]]))
            assert got[i, model]["prediction"] == pytest.approx(mean[0], abs=1e-9)
            assert got[i, model]["deviation"] == (None if deviation is None else pytest.approx(deviation[0], abs=1e-9))
    assert kernels.buckets_for(df, 10_000, 20_000, 80_000) <= 2 * spark.sparkContext.defaultParallelism  # not a group for each of 10,000 experiments
    assert kernels.buckets_for(df, 10_000, 20_000, 10**9) == 250
