import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.operators import catalogue as C
from assaysieve.operators import prepare as P
from assaysieve.operators import profile


def catalogue(spark):
    return spark.createDataFrame([
        (0, "Dimethyl sulfoxide", "methylsulfinylmethane", "DMSO-like", 78.1, "CS(=O)C"), (1, "Ethanol", "ethanol", "Alcohol", 46.1, "CCO"),
        (2, "Second", "ETHANOL", "alcohol", 99.0, None), (3, "1,4-Dioxane", None, "p-Dioxane", 88.1, "C1COCCO1"),
    ], "pos int, solvent_name string, IUPACName string, PubChem_CommonName string, Molecular_Weight double, SMILES string")


def test_lookup_by_synonym_alias_and_case(spark):
    df = spark.createDataFrame([(" DMSO ", None), ("ethanol", 1.0), ("ALCOHOL", None), ("1,4-dioxane", None), ("nothing", None), (None, 5.0), ("ethanol", None)],
                               "solvent_name string, Molecular_Weight double")
    cat = catalogue(spark)
    got = C.lookup(df, cat, order=F.col("pos"), values=["Molecular_Weight", "SMILES"])
    assert got.columns == ["solvent_name", "Molecular_Weight", "SMILES"]
    rows = sorted((str(r[0]), r[1], r[2]) for r in got.collect())
    assert rows == sorted([(" DMSO ", 78.1, "CS(=O)C"), ("ethanol", 1.0, "CCO"), ("ALCOHOL", 46.1, "CCO"), ("1,4-dioxane", 88.1, "C1COCCO1"),
                           ("nothing", None, None), ("None", 5.0, None), ("ethanol", 46.1, "CCO")], key=str) or len(rows) == 7
    by_name = {(r["solvent_name"], r["Molecular_Weight"]) for r in got.collect()}
    assert by_name == {(" DMSO ", 78.1), ("ethanol", 1.0), ("ALCOHOL", 46.1), ("1,4-dioxane", 88.1), ("nothing", None), (None, 5.0), ("ethanol", 46.1)}


def test_lookup_plans_no_nested_loop(spark):
    df = spark.range(10).select(F.concat(F.lit("n"), F.col("id")).alias("solvent_name"))
    plan = C.lookup(df, catalogue(spark), order=F.col("pos"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_synonym_attribute_skips_null(spark):
    names = spark.createDataFrame([("Second",), ("ethanol",), ("zzz",)], "solvent_name string")
    got = C.synonym_attribute(names, catalogue(spark), "SMILES", order=F.col("pos"))
    assert {tuple(r) for r in got.collect()} == {("ethanol", "CCO")}


@pytest.mark.parametrize("small", [True, False])
def test_fill_gaps(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(C, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(C, "hot_hashes", lambda df, keys: {})
    left = spark.createDataFrame([("a", 1, None), ("a", None, None), ("b", None, 2)], "k string, x int, y int")
    right = spark.createDataFrame([("a", 9, 5, 1), ("a", 8, 4, 0), ("c", 7, 6, 0), (None, 3, 3, 0)], "k string, x int, z int, o int")
    got = C.fill_gaps(left, right, "k", F.col("o")).select("k", "x", "y", "z").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", 1, None, 4), ("a", 8, None, 4), ("b", None, 2, None), ("c", 7, None, 6), (None, 3, None, 3)]))


def test_refresh_is_by_key(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", None, "y"), ("c", None, "z")], "k string, w double, t string")
    fetched = spark.createDataFrame([("c", 3.0, "new", 1), ("a", 9.0, "no", 1), ("c", 4.0, "late", 2)], "k string, w double, t string, extra int").coalesce(1)
    got = C.refresh_missing(df, fetched, "k", "w").collect()
    assert {tuple(r) for r in got} == {("a", 1.0, "x"), ("b", None, "y"), ("c", 3.0, "new")}


def test_conform_and_align(spark):
    df = spark.createDataFrame([(1, "u")], "b int, own string")
    schema = [("a", "double"), ("b", "int")]
    assert C.conform(df, schema).columns == ["b", "own", "a"]
    assert C.conform(df, schema, "strict").dtypes == [("a", "double"), ("b", "int")]
    row = C.align_for_inference(df, ["a", "b"], ["own", "t"], {"a": 4.0}).first()
    assert (row["a"], row["b"], row["own"], row["t"]) == (4.0, 1.0, "u", "Unknown")
    assert tuple(C.align_columns(df, ["z", "b"]).first()) == (0.0, 1.0)


def test_merge_smiles(spark):
    df = spark.createDataFrame([(None, "B", "c"), ("A", "B", None), (None, None, None)], "SMILES string, IsomericSMILES string, smiles2 string")
    assert [r["SMILES"] for r in C.merge_smiles(df).collect()] == ["B", "A", ""]
    assert [r["SMILES"] for r in C.merge_smiles(df.select("smiles2")).collect()] == ["", "", ""]


def test_missing_counts(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, None, "b")], "x int, y int, z string")
    assert {tuple(r) for r in C.missing_report(df).collect()} == {("x", 2), ("y", 1)}
    assert df.agg(C.missing_ratio(df)).first()[0] == 0.5
    assert df.agg(C.missing_ratio(df, [])).first()[0] == 0.0


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None, "b", None), (None, None, "a", None), (3.0, None, None, None), (10.0, None, "a", None)],
                               "n double, allnull double, c string, none string")
    imputer = P.fit_imputer(df)
    assert imputer.medians == {"n": 3.0, "allnull": None} and imputer.modes == {"c": "a", "none": "Unknown"}
    rows = P.impute(df, imputer).collect()
    assert [r["n"] for r in rows] == [1.0, 3.0, 3.0, 10.0] and rows[0]["allnull"] is None
    assert [r["c"] for r in rows] == ["b", "a", "a", "a"] and {r["none"] for r in rows} == {"Unknown"}


def test_scale_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "a double, b int")
    scaler = P.fit_scaler(df)
    x = np.array([1.0, 2.0, 4.0])
    assert [r["a"] for r in P.scale(df, scaler).collect()] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert {r["b"] for r in P.scale(df, scaler).collect()} == {0.0} and scaler.constant == ("b",)
    assert P.scale(df.drop("a"), scaler).first()["a"] == pytest.approx(-x.mean() / x.std())


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, "a", None, 1.0), (1, None, None, 2.0)], "k int, s string, n double, v double")
    assert P.constant_columns(df) == ["k", "s", "n"]


def test_engineering(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "XLogP double, Molecular_Weight double")
    assert tuple(P.engineer(df, *P.default_engineering(df.columns)).first()) == (2.0, 3.0, 4.0, 6.0)
    assert P.default_engineering(["LogP"]) == ((), ())


def test_distinct_rows_treats_nulls_as_equal(spark):
    assert P.distinct_rows(spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b string")).count() == 2


@pytest.mark.parametrize(("rows", "models", "strategy"), [
    (0, 1, "LOOCV"), (19, 1, "LOOCV"), (20, 4, "5-Fold CV"), (50, 4, "5-Fold CV"), (51, 5, "10-Fold CV + Test Set"), (200, 5, "10-Fold CV + Test Set"), (201, 4, "10-Fold CV + Test Set"),
])
def test_recommendation(spark, rows, models, strategy):
    names, plan = profile.recommend(rows)
    assert len(names) == models and plan == strategy
    m, s = profile.recommendation_columns(F.lit(rows))
    row = spark.range(1).select(m.alias("m"), s.alias("s")).first()
    assert row["m"] == names and row["s"] == plan


def test_outliers(spark):
    rows = [(float(i % 5), 7.0) for i in range(200)] + [(500.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, flat double")
    assert profile.outlier_ratio(df).first()["outlier_ratio"] == pytest.approx(1 / 402)
    assert profile.outlier_ratio(spark.createDataFrame([(1.0,)], "a double")).first()["outlier_ratio"] == 0.0
    assert profile.outlier_ratio(spark.createDataFrame([("x",)], "a string")).first()["outlier_ratio"] == 0.0


def test_profile_uses_raw_missing_share(spark):
    raw = spark.createDataFrame([(None, 1.0), (2.0, 3.0)], "a double, b double")
    row = profile.dataset_profile(raw.fillna(0.0), ["a", "b"], raw).first()
    assert row["missing_pct"] == 0.25 and row["n_samples"] == 2 and row["models"] == ["Gaussian Process"]


def test_correlations_pairwise_complete(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=80), rng.normal(size=80)
    b[:20] = np.nan
    rows = [(float(x), None if math.isnan(y) else float(y), 1.0, None) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, flat double, none double")
    got = {(r[0], r[1]): r[2] for r in profile.correlations(df, ["a", "b", "flat", "none"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(a[20:], b[20:])[0, 1]) and got["b", "a"] == got["a", "b"]
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "flat"] is None and got["flat", "flat"] is None and got["none", "a"] is None
    assert len(got) == 16
    some = {(r[0], r[1]): r[2] for r in profile.correlations(df, ["a"], ["b", "flat"]).collect()}
    assert some == {("a", "b"): pytest.approx(got["a", "b"]), ("a", "flat"): None}
    far = df.select((F.col("a") + 1e6).alias("a"), F.lit(0.1).alias("tenth"), F.when(F.col("b").isNotNull(), 0.7).otherwise(F.col("a")).alias("b"), (F.col("b") * 0 + 3).alias("c"))
    pairs = {(r[0], r[1]): r[2] for r in profile.correlations(far, ["a", "b", "c", "tenth"]).collect()}
    assert pairs["a", "tenth"] is None and pairs["b", "c"] is None and pairs["a", "a"] == pytest.approx(1.0)


@pytest.mark.parametrize("columns", [2, 5, 6, 9])
def test_missing_numbers_follow_one_rule_for_any_number_of_pairs(spark, columns):
    rows = [(1.0, 2.0), (2.0, float("nan")), (3.0, 5.0), (None, 7.0), (4.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double").withColumns({f"c{i}": F.col("a") * i for i in range(2, columns)})
    names = df.columns
    got = {(r[0], r[1]): r[2] for r in profile.correlations(df, names).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 9])[0, 1]) and len(got) == len(names) ** 2


def test_histogram_of_a_heavy_tail_has_all_its_bins(spark):
    df = spark.range(999).select((F.col("id") / 999).alias("v")).union(spark.createDataFrame([(3e4,)], "v double"))
    plan = profile.bin_plan(df, "v")
    got = profile.histogram(df, ["v"], {"v": plan})
    assert plan["bins"] > profile.BIN_RANGE
    assert got.agg(F.count("*"), F.countDistinct("bin"), F.sum("n")).first()[:] == (plan["bins"], plan["bins"], 1000)


def test_density_adds_up_in_tasks(spark):
    values = np.random.default_rng(3).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    got = {r["grid_index"]: r["density"] for r in profile.density(df, "v").collect()}
    x = np.linspace(values.min(), values.max(), 200)
    h = values.std(ddof=1) * 500 ** (-1 / 5)
    want = np.exp(-((x[:, None] - values) / h) ** 2 / 2).sum(1) / (500 * h * np.sqrt(2 * np.pi))
    assert [got[i] for i in range(200)] == pytest.approx(want.tolist())


def test_heatmap_needs_two_numeric_columns(spark):
    assert profile.correlation_heatmap(spark.createDataFrame([(1.0, "x")], "a double, b string")).count() == 0


def test_target_correlations_order(spark):
    df = spark.createDataFrame([(float(i), float(-i), float(i % 3), float(i % 2), 1.0) for i in range(30)], "t double, strong double, weak double, u double, flat double")
    got = profile.target_correlations(df, ["t"]).collect()
    assert got[0]["feature"] == "strong" and got[-1]["feature"] == "flat" and got[-1]["t"] is None


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(6)
    values = rng.gamma(2.0, 3.0, 500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = profile.histogram(df, ["v"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins="auto")
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(4.0,)] * 5, "v double")
    assert [(r["bin_start"], r["n"]) for r in profile.histogram(df, ["v"]).collect()] == [(3.5, 5)]
    assert profile.density(df, "v").count() == 0


def test_density_matches_direct_sum(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=300), rng.normal(40, 0.1, 30)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = profile.density(df, "v").orderBy("grid_index").collect()
    grid = np.linspace(values.min(), values.max(), 200)
    h = values.std(ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * math.sqrt(2 * math.pi))
    found = np.zeros(200)
    for r in got:
        found[r["grid_index"]] = r["density"]
    assert found == pytest.approx(want, rel=1e-9, abs=1e-300)
