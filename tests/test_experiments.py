"""Many experiments at once against one at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.operators import kernels, linear, validate
from assaysieve.plans.experiments import screen_experiments, train_experiments

FEATURES = ["a", "b"]


def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for g, (n, bend) in {"x": (30, 0.0), "y": (24, 2.0), "z": (18, 0.0)}.items():
        for i in range(n):
            a, b = map(float, rng.normal(size=2))
            rows.append((f"{g}{i}", g, a, b, float(1 + a - b + bend * np.sin(2 * a) + rng.normal() / 20)))
    return spark.createDataFrame(rows, "name string, g string, a double, b double, y double").repartition(5)


MODELS = ["Ridge", "Polynomial Regression", "Kernel Ridge", "Gaussian Process"]


def test_each_experiment_is_trained_as_if_alone(spark):
    df = table(spark)
    trained = train_experiments(df, FEATURES, ["y"], ["g"], MODELS, "name")
    scores = {(r["g"], r["model"]): r for r in trained.scores.collect()}
    assert len(scores) == 12 and {r["status"] for r in scores.values()} == {"ok"}
    best = {r["g"]: r["model"] for r in trained.best.collect()}
    for g in "xyz":
        alone = validate.assign_folds(df.where(F.col("g") == g), "name", 5).persist()
        fits = linear.fit_folds(alone, FEATURES, ["y"], ["Ridge", "Polynomial Regression"], "fold")
        oof = linear.out_of_fold(alone, fits, FEATURES, ["y"], ["Ridge", "Polynomial Regression"], "fold", keep=["name"]).drop("fold")
        more = kernels.kernel_out_of_fold(alone, FEATURES, ["y"], list(kernels.KERNEL_MODELS), "fold", "name").drop("fold")
        for r in validate.metrics(oof.unionByName(more)).collect():
            assert r["cv_r2"] == pytest.approx(scores[g, r["model"]]["cv_r2"], abs=1e-6)
        assert best[g] == max((m for k, m in scores if k == g), key=lambda m: scores[g, m]["cv_r2"])


def test_every_row_is_scored_by_its_experiments_best_model(spark):
    df = table(spark)
    trained = train_experiments(df, FEATURES, ["y"], ["g"], MODELS, "name")
    best = {r["g"]: r["model"] for r in trained.best.collect()}
    rows = screen_experiments(trained, df.unionByName(df.limit(1).withColumn("g", F.lit("unknown"))), ["name"]).collect()
    assert len(rows) == 73 and [r["name"] for r in rows if r["model"] is None] == [r["name"] for r in rows if r["g"] == "unknown"]
    rows = [r for r in rows if r["g"] != "unknown"]
    assert all(r["model"] == best[r["g"]] and r["half_width"] > 0 for r in rows)
    values = {r["name"]: r["prediction"] for r in rows}
    truth = {r["name"]: r["y"] for r in df.collect()}
    assert np.corrcoef([values[k] for k in truth], list(truth.values()))[0, 1] > 0.95


def test_rows_without_a_model_are_kept(spark):
    df = table(spark)
    trained = train_experiments(df, FEATURES, ["y"], ["g"], ["Ridge", "Kernel Ridge", "SVR"], "name")
    more = df.limit(2)
    library = df.unionByName(more.withColumn("g", F.lit("unknown"))).unionByName(more.withColumn("g", F.lit(None).cast("string")))
    rows = screen_experiments(trained, library, ["name"]).collect()
    assert len(rows) == library.count() == 76
    for r in rows:
        values = (r["target"], r["model"], r["prediction"], r["half_width"])
        assert all(v is None for v in values) if r["g"] in ("unknown", None) else None not in values
    assert screen_experiments(trained, library, ["name"], unmatched=False).count() == 72


def test_trees_of_all_experiments(spark):
    """Tree families compete with the others, and score their experiment's rows."""
    df = table(spark).withColumn("y", F.when(F.col("g") == "y", F.when(F.col("a") > 0, 5.0).otherwise(-5.0)).otherwise(F.col("y")))
    names = ["Ridge", "Random Forest", "XGBoost", "CatBoost"]
    trained = train_experiments(df, FEATURES, ["y"], ["g"], names, "name", tree_options={"random_forest": {"trees": 20}, "symmetric": {"trees": 40}})
    scores = {(r["g"], r["model"]): r for r in trained.scores.collect()}
    assert len(scores) == 12 and {r["status"] for r in scores.values()} == {"ok"}
    best = {r["g"]: r["model"] for r in trained.best.collect()}
    assert best["x"] == best["z"] == "Ridge" and best["y"] != "Ridge"
    rows = screen_experiments(trained, df, ["name"]).collect()
    assert len(rows) == 72 and all(r["model"] == best[r["g"]] and r["half_width"] is not None for r in rows)
    truth = {r["name"]: r["y"] for r in df.collect()}
    assert all(abs(r["prediction"] - truth[r["name"]]) < 2 for r in rows if r["g"] == "y")
