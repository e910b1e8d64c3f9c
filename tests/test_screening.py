import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaysieve.operators import score, views
from assaysieve.plans import persistence, screening, training
from assaysieve.session import delete_paths


def results(spark):
    return spark.createDataFrame([
        ("A", 80.0, 5.0, 40.0, 5.0), (" b ", 20.0, 5.0, 90.0, 5.0), ("c", 50.0, 5.0, 50.0, 5.0), ("Control", 1.0, 5.0, 1.0, 5.0),
    ], "solvent_name string, u_Prediction double, u_Uncertainty double, s_Prediction double, s_Uncertainty double")


def experiment(spark):
    return spark.createDataFrame([
        (1, "a", 10.0, 1.0), (2, "B", 60.25, None), (3, " A ", 95.04, 71.0), (4, "control", 99.0, 99.0),
    ], "row_id int, solvent_name string, u double, s double")


def test_measured_values_replace_predictions(spark):
    measured = score.measured_values(experiment(spark), ["u", "s"], "row_id")
    got = {r["solvent_name"]: r for r in score.override_measured(results(spark), measured, ["u", "s"]).collect()}
    assert (got["A"]["u_Prediction"], got["A"]["s_Prediction"], got["A"]["u_Uncertainty"]) == (95.0, 71.0, 0.0)
    assert (got[" b "]["u_Prediction"], got[" b "]["s_Prediction"]) == (60.2, 90.0)
    assert (got[" b "]["u_Uncertainty"], got[" b "]["s_Uncertainty"]) == (0.0, 5.0)
    assert (got["c"]["u_Prediction"], got["c"]["measured"]) == (50.0, False)
    assert (got["Control"]["u_Prediction"], got["Control"]["u_Uncertainty"]) == (1.0, 5.0)


def test_desirability(spark):
    got = {r["solvent_name"]: r["score"] for r in score.desirability(results(spark), {"u": (0.0, 100.0), "s": (0.0, 100.0)}).collect()}
    assert got["A"] == pytest.approx(np.round(np.sqrt(0.8 * 0.4) * 100, 1)) and got["c"] == 50.0
    flat = {r["solvent_name"]: r["score"] for r in score.desirability(results(spark), {"u": (5.0, 5.0), "s": (0.0, 100.0)}).collect()}
    assert flat["A"] == pytest.approx(np.round(np.sqrt(0.4) * 100, 1))
    own = {r["solvent_name"]: r["score"] for r in score.desirability(results(spark), {}).collect()}
    assert own["Control"] == 0.1
    assert {r["score"] for r in score.desirability(results(spark).select("solvent_name"), {}).collect()} == {0.0}


def test_desirability_is_one_projection(spark):
    plan = score.desirability(results(spark), {"u": (0.0, 1.0), "s": (0.0, 1.0)})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rank_of_a_large_table_equals_the_window(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("e"), F.col("id")).alias("solvent_name"), F.when(F.col("id") % 3 == 0, 0.1).otherwise(F.pmod(F.hash("id"), F.lit(50)) / 10.0).alias("score")
    )
    window = Window.orderBy(F.col("score").desc(), "solvent_name")
    plain = {r["solvent_name"]: r["rank"] for r in df.withColumn("rank", F.row_number().over(window)).collect()}
    written = []
    ranked = score.rank_all(df, written=written)
    assert {r["solvent_name"]: r["rank"] for r in ranked.collect()} == plain and len(written) == 2
    delete_paths(spark, written)
    with pytest.raises(Exception):
        ranked.collect()


def test_models_score_a_library_once(spark):
    """What scores the rows runs in one pass, though they are ranked by a sort that looks at its input twice."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(500).selectExpr("cast(id as string) solvent_name", "cast(id % 9 as double) score").mapInPandas(count, "solvent_name string, score double")
    assert score.rank_all(df).count() == 500 and seen.value == 500


def test_top_rank_keeps_k_rows_per_task(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("solvent_name"), (F.col("id") % 7).cast("double").alias("score"))
    assert [r["rank"] for r in score.top_ranked(df, 5).collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in df.orderBy("score").limit(5)._jdf.queryExecution().executedPlan().toString()
    assert score.best_entity(df).first()[0] == "13"


def test_interval_forms(spark):
    df = spark.createDataFrame([(99.95, 3.0), (-4.0, 1.0)], "p double, e double")
    free = df.select(*score.interval(F.col("p"), F.col("e"), "t")).collect()
    assert free[0][:] == (np.round(99.95, 1), 3.0) and free[1][:] == (-4.0, 1.0)
    held = df.select(*score.interval(F.col("p"), F.col("e"), "t", (0.0, 100.0)))
    assert held.columns == ["t_Prediction", "t_CI_Lower", "t_CI_Upper"]
    assert held.collect()[1][:] == (0.0, 0.0, 0.0) and held.collect()[0]["t_CI_Upper"] == 100.0


def test_classes_need_all_targets(spark):
    assert "Compatibility" not in score.classify(results(spark), ["u", "other"]).columns
    assert score.classify(results(spark), ["u", "s"]).where("Compatibility = 'Moderately Compatible'").count() == 3


# Tables for charts

def ranked(spark):
    return score.rank_all(score.desirability(results(spark), {"u": (0.0, 100.0), "s": (0.0, 100.0)}))


def test_novel_rows_exclude_measured_names(spark):
    assert [r["solvent_name"] for r in views.novel_top(ranked(spark), experiment(spark), 2).collect()] == ["c"]


def test_measured_vs_novel(spark):
    got = views.measured_vs_novel(ranked(spark), experiment(spark), ["u", "s", "absent"])
    assert got.where("origin = 'measured'").count() == 8 and got.where("origin = 'measured' and error <> 0").count() == 0
    assert {(r["target"], r["value"], r["error"]) for r in got.where("origin = 'novel'").collect()} == {("u", 50.0, 5.0), ("s", 50.0, 5.0)}


def test_error_bars_without_uncertainty(spark):
    bars = views.error_bars(ranked(spark).drop("s_Uncertainty"), ["solvent_name"], 1).collect()
    assert {(r["target"], r["error"]) for r in bars} == {("u", 5.0), ("s", 0.0)}


def test_links(spark):
    df = spark.createDataFrame([("a", "CCO", "N"), ("b", "nan", "O"), ("c", None, None)], "solvent_name string, SMILES string, other string")
    linked = views.with_links(df, fallback="other")
    assert linked.columns[:2] == ["solvent_name", "Structure"]
    assert [r["Structure"] is not None for r in linked.orderBy("solvent_name").collect()] == [True, True, False]
    assert "Structure" not in views.with_links(df.where("solvent_name = 'c'")).columns


def test_projection_matches_svd(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 3)) @ np.diag([3.0, 1.0, 0.2]) + 5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double")
    fit = views.fit_projection(df, ["a", "b", "c"])
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert fit.explained == pytest.approx((s**2 / (s**2).sum())[:2].tolist())
    for got, want in zip(fit.loadings, vt[:2], strict=True):
        assert np.abs(got) == pytest.approx(np.abs(want)) and got[int(np.argmax(np.abs(got)))] > 0
    mapped = views.feature_map(df, df.drop("c"), ["a", "b", "c"], ["i"])
    assert mapped.where("kind = 'novel'").count() == 50 and set(mapped.columns) >= {"pc1", "pc2", "explained_1"}


def test_plot_bounds_and_headings(spark):
    pairs = spark.createDataFrame([("t", 1.0, 2.0), ("t", 5.0, 0.5)], "target string, y double, yhat_train double")
    assert tuple(views.plot_bounds(pairs).first()) == ("t", 0.5, 5.0)
    assert views.display_names(results(spark)).columns[1] == "u Prediction"
    assert views.measured_order(experiment(spark), "u", "solvent_name", 2).orderBy("position").first()["solvent_name"] == "control"


# Whole runs on the documented kind of input

def sample(spark):
    rows = [("Water", 95, 71, -0.5, 80.1, 1e6, 1.0), ("Ethanol", 40, 55, -0.1, 24.6, 1e6, 1.07), ("Hexane", 5, 12, 3.9, 1.88, 9.5, 0.3),
            ("Toluene", 2, 3, 2.7, 2.38, 526.0, 0.56), ("Acetone", 60, 50, -0.1, 20.7, 1e6, None), ("Water", 95, 71, -0.5, 80.1, 1e6, 1.0),
            ("CONTROL 1", 100, 100, None, None, None, None)]
    return spark.createDataFrame(rows, "solvent_name string, glucose_uptake long, `cfu/ml` long, LogP double, Dielectric_Constant double, Water_Solubility double, Dynamic_Viscosity double").withColumn(
        "Solvent_Concentration", F.lit(50.0)).withColumn("SMILES", F.lit("C"))


def library(spark):
    return sample(spark).drop("glucose_uptake", "cfu/ml").where("solvent_name <> 'Water'").unionByName(
        spark.createDataFrame([("Methanol", -0.5, 32.7, None, 0.54, 50.0, "CO")], "solvent_name string, LogP double, Dielectric_Constant double, Water_Solubility double, Dynamic_Viscosity double, Solvent_Concentration double, SMILES string"))


def test_preparation(spark):
    t = training.prepare_training(sample(spark))
    assert t.targets == ["glucose_uptake", "cfu/ml"] and t.frame.count() == 5
    assert t.features == ["LogP", "Dielectric_Constant", "Water_Solubility", "Dynamic_Viscosity"]
    assert t.preparation.scaler.constant == ("Solvent_Concentration", "SMILES")
    assert t.preparation.imputer.medians["Dynamic_Viscosity"] == pytest.approx(0.78)
    assert t.preparation.missing_groups == ()


def test_last_measurement_wins_across_duplicates(spark):
    rows = [(1, "a", 1.0, 5.0), (2, "a", 2.0, 5.0), (3, "a", 1.0, 5.0), (4, "b", 9.0, 6.0)]
    t = training.prepare_training(spark.createDataFrame(rows, "row_id int, solvent_name string, y double, LogP double"))
    got = {r["name_key"]: r["_measured"]["m_0"] for r in score.measured_values(t.raw, ["y"], "row_id").collect()}
    assert got == {"a": 1.0, "b": 9.0} and t.frame.count() == 3


@pytest.mark.parametrize("models", [None, ["Linear Regression", "Ridge", "Lasso", "Polynomial Regression", "Neural Networks", "SVR"]])
def test_train_screen_save_load(spark, tmp_path, models):
    trained = training.train(training.prepare_training(sample(spark)), models)
    assert trained.strategy == "LOOCV" and set(trained.best) == {"glucose_uptake", "cfu/ml"}
    if models is None:
        assert {b.fitted_as for b in trained.best.values()} == {"gaussian_process"}
    else:
        names = {(r["model"], r["fitted_as"]) for r in trained.scores.collect()}
        assert ("Neural Networks", "Linear Regression") in names and ("SVR", "support_vectors") in names and len(names) == 6
    got = screening.screen(trained, library(spark))
    rows = {r["solvent_name"]: r for r in got.collect()}
    assert sorted(r["rank"] for r in rows.values()) == list(range(1, len(rows) + 1))
    assert rows["Ethanol"]["glucose_uptake_Prediction"] == 40.0 and rows["Ethanol"]["cfu/ml_Uncertainty"] == 0.0
    assert rows["Methanol"]["measured"] is False and rows["Methanol"]["LogP"] == -0.5 and rows["CONTROL 1"]["measured"] is False
    persistence.save(trained, str(tmp_path / "m"))
    again = screening.screen(persistence.load(spark, str(tmp_path / "m")), library(spark))
    assert again.exceptAll(got).count() == 0 and again.count() == got.count()


def test_bounded_variant_and_fill(spark):
    trained = training.train(training.prepare_training(sample(spark)), ["Ridge"])
    held = screening.screen(trained, library(spark), bounds=(0.0, 100.0), classes=["glucose_uptake", "cfu/ml"])
    assert {"glucose_uptake_CI_Lower", "Compatibility"} <= set(held.columns)
    zero = screening.screen(trained, library(spark)).where("solvent_name = 'Methanol'").first()
    median = screening.screen(trained, library(spark), fill="train_median").where("solvent_name = 'Methanol'").first()
    assert zero["glucose_uptake_Prediction"] != median["glucose_uptake_Prediction"]
    with pytest.raises(ValueError):
        screening.screen(trained, library(spark), fill="other")


def test_failed_models_are_recorded_and_skipped(spark):
    prepared = training.prepare_training(sample(spark))
    options = {"random_forest": {"trees": 0}}
    trained = training.train(prepared, ["Random Forest", "Ridge"], "5-Fold CV", tree_options=options)
    status = {(r["model"], r["status"][:5]) for r in trained.scores.collect()}
    assert status == {("Random Forest", "error"), ("Ridge", "ok")} and {b.model for b in trained.best.values()} == {"Ridge"}


def test_scoring_a_library_is_one_projection(spark):
    trained = training.train(training.prepare_training(sample(spark)), ["Ridge"])
    prepared = screening.prepare_library(library(spark), trained.training.preparation)
    plan = screening.predict(prepared, trained.best, trained.training.features, ["solvent_name"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def measured(spark, rows, folds=5):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, 2))
    y = 2 + x @ [1.0, -0.5] + rng.normal(size=rows) / 20
    data = [(i, f"e{i}", float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(data, "row_id bigint, solvent_name string, LogP double, Density double, yield_pct double")
    return training.prepare_training(df, targets=["yield_pct"])


def test_leave_one_out_of_many_rows(spark):
    """No fit per row is made, kept or joined for models that need none."""
    rows = 20_000
    df = spark.range(rows).select(
        F.col("id").alias("row_id"), F.concat(F.lit("e"), "id").alias("solvent_name"), F.rand(1).alias("LogP"), F.rand(2).alias("Density")
    ).withColumn("yield_pct", F.col("LogP") * 3 - F.col("Density") + F.rand(3) / 10)
    trained = training.train(training.prepare_training(df, targets=["yield_pct"]), ["Ridge", "Linear Regression"], "LOOCV")
    assert trained.oof.count() == 2 * rows and trained.oof.where("yhat_cv is null").count() == 0
    assert trained.best["yield_pct"].cv_r2 > 0.85
    plan = trained.oof._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan
    trained.release()


def test_kernel_models_beyond_the_landmarks_are_screened(spark):
    trained = training.train(measured(spark, 260), ["Gaussian Process", "Kernel Ridge"], "5-Fold CV")
    assert {r["status"] for r in trained.scores.collect()} == {"ok"} and trained.best["yield_pct"].cv_r2 > 0.7
    library = spark.createDataFrame([("new", 0.1, 0.2), ("gap", None, 0.2)], "solvent_name string, LogP double, Density double")
    assert screening.screen(trained, library).count() == 2
    trained.release()


def test_nothing_fitted_raises(spark, monkeypatch):
    monkeypatch.setattr(training.histogram_trees, "fit_trees", lambda *a, **k: 1 / 0)
    with pytest.raises(ValueError, match="no model could be fitted"):
        training.train(measured(spark, 12), ["Random Forest"], "5-Fold CV")


@pytest.mark.parametrize("model", ["Ridge", "Polynomial Regression", "SVR", "Random Forest", "LightGBM"])
def test_the_chosen_model_is_explained(spark, model):
    trained = training.train(measured(spark, 40), [model], "5-Fold CV", tree_options={"random_forest": {"trees": 5, "depth": 4}})
    frame, features = trained.training.frame, trained.training.features
    shap = screening.explain(trained, "yield_pct", keep=["row_id"])
    unbounded = screening.predict(frame, trained.best, features, ["row_id"])
    both = shap.join(unbounded, "row_id").collect()
    assert len(both) == 40
    for r in both:
        assert r["base"] + sum(r[f"phi_{c}"] for c in features) == pytest.approx(r["yield_pct_Prediction"], abs=0.051)


def test_boosting_falls_back_to_forests(spark):
    trained = training.train(measured(spark, 30), ["XGBoost"], "5-Fold CV", tree_options={"random_forest": {"trees": 3, "depth": 3}}, boosting="random_forest")
    assert trained.best["yield_pct"].fitted_as == "random_forest"


def test_positions_per_target(spark):
    got = {(r["target"], r["solvent_name"]): r["position"] for r in views.measured_positions(experiment(spark), ["u", "s"], "solvent_name", 2).collect()}
    assert got == {("u", "control"): 1, ("u", " A "): 2, ("s", "control"): 1, ("s", " A "): 2}


def test_result_table(spark):
    df = ranked(spark).withColumn("SMILES", F.when(F.col("solvent_name") == "A", "C"))
    shown = screening.result_table(df)
    assert shown.columns[:2] == ["solvent_name", "Structure"] and "SMILES" not in shown.columns
    assert all(r["Overall_Compatibility"].endswith("%") for r in shown.collect())
