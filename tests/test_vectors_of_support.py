"""Support-vector regression: optimality, parts and rounds, experiments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.operators import spanned_vectors as V
from assaysieve.operators import support_vectors as S
from assaysieve.operators import validate

NAMES = ["a", "b"]


def data(rows, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 2))
    return x, np.sin(2 * x[:, 0]) + x[:, 1] / 2 + rng.normal(size=rows) / 10


def frame(spark, x, y, groups=1):
    rows = [(i, f"g{i % groups}", i // 2 % 2, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id bigint, g string, fold int, a double, b double, y double").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_no_feasible_move_raises_the_dual(seed):
    x, y = data(60, seed)
    k = S.kernel(x, x, 0.4)
    beta = S.solve(k, y, np.zeros(60), tolerance=1e-6)
    assert abs(beta.sum()) < 1e-9 and np.abs(beta).max() <= 1 + 1e-12

    def dual(b):
        return b @ y - 0.1 * np.abs(b).sum() - b @ k @ b / 2

    rng = np.random.default_rng(seed)
    for _ in range(300):
        other = np.clip(beta + rng.normal(size=60) * 10.0 ** rng.integers(-4, 1), -1, 1)
        other -= other.mean()
        if np.abs(other).max() <= 1:
            assert dual(other) <= dual(beta) + 1e-6
    residual = y - k @ beta
    gap, primal = S.gap_of(beta, residual, y, 1.0, 0.1)
    assert -1e-9 <= gap <= 1e-4 * primal
    error = np.abs(residual - S.bias_of(beta, residual, 1.0, 0.1))
    assert (error[np.abs(beta) < 1e-9] <= 0.1 + 1e-5).all() and (error[np.abs(beta) > 1 - 1e-9] >= 0.1 - 1e-5).all()


def test_a_move_is_the_best_on_its_line():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b, gain, curve = rng.uniform(-1, 1), rng.uniform(-1, 1), rng.normal(), rng.choice([0.0, 0.3, 2.0])
        low, high = max(-1 - a, b - 1), min(1 - a, 1 + b)
        t = S.best_move(low, high, gain, curve, a, b, 0.1)
        worth = lambda t: gain * t - curve * t * t / 2 - 0.1 * (abs(a + t) + abs(b - t))  # noqa: B023, E731
        assert worth(t) >= max(map(worth, np.linspace(low, high, 501))) - 1e-6


def test_rounds_over_parts_close_the_gap(spark):
    x, y = data(160)
    df = frame(spark, x, y)
    whole = S.fit_support_vectors(df, NAMES, ["y"], "id")
    parts = S.fit_support_vectors(df, NAMES, ["y"], "id", local_rows=100, part_rows=80, tolerance=1e-2)
    gap = parts.models.first()["gap"]
    assert 0 <= gap < 0.5
    want = {r["id"]: r["yhat_train"] for r in whole.predictions.collect()}
    for r in parts.predictions.collect():
        assert r["yhat_train"] == pytest.approx(want[r["id"]], abs=0.05) and r["yhat_cv"] is None
    scored = {r["id"]: r["p"] for r in S.score_vectors(df, parts.models, NAMES, "p").collect()}
    predict = S.predictor(parts.models)
    for r in parts.predictions.collect():
        assert scored[r["id"]] == pytest.approx(r["yhat_train"], abs=1e-9) and predict(x[r["id"]:r["id"] + 1])[0] == pytest.approx(scored[r["id"]], abs=1e-9)


def test_experiments_gaps_and_folds(spark):
    x, y = data(120)
    df = frame(spark, x, y, groups=2).withColumn("a", F.when(F.col("id") != 7, F.col("a"))).withColumn("g", F.when(F.col("g") == "g1", F.col("g")))
    fitted = S.fit_support_vectors(df, NAMES, ["y"], "id", "fold", ["g"])
    rows = fitted.predictions.collect()
    assert len(rows) == 119 and {r["g"] for r in rows} == {"g1", None}
    for g in ("g1", None):
        scores = validate.metrics(fitted.predictions.where(F.col("g").eqNullSafe(F.lit(g)))).first()
        assert scores["status"] == "ok" if g is None else scores["n"] == 59
    both = S.score_experiments(df, fitted.models, NAMES, ["id"], ["g"]).collect()
    assert len(both) == 120 and [r["id"] for r in both if r["prediction"] is None] == [7]
    known = {r["id"]: r["yhat_train"] for r in rows}
    assert all(r["prediction"] == pytest.approx(known[r["id"]]) for r in both if r["id"] != 7)
    alone = S.fit_support_vectors(df.where("g is null"), NAMES, ["y"], "id", "fold").predictions.collect()
    assert all(r["yhat_train"] == pytest.approx(known[r["id"]]) for r in alone)
    nothing = S.fit_support_vectors(df.where("false"), NAMES, ["y"], "id", "fold", ["g"])
    assert nothing.predictions.count() == nothing.models.count() == 0


def test_small_experiments_share_a_group(spark):
    from assaysieve.operators.histogram_trees import cell_tables
    from assaysieve.operators.kernels import bucketed

    rows = [(i, i // 2, float(i * 7 % 11), float(i * 5 % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, g bigint, a double, y double").repartition(3)
    held = bucketed(df, ["g"], 4).where("_bucket = 1").toArrow()
    own = cell_tables(held)
    assert len(own) > 1 and sorted(i for t in own.values() for i in t["id"].to_pylist()) == sorted(held["id"].to_pylist())
    assert all(len(set(t["g"].to_pylist())) == 1 and t.num_rows == 2 for t in own.values())
    models = S.fit_support_vectors(df, ["a"], ["y"], "id", by=["g"], tolerance=1e-9).models
    assert models.select("g").distinct().count() == 100
    got = {r["id"]: r["prediction"] for r in S.score_experiments(df, models, ["a"], ["id"], ["g"]).collect()}
    assert len(got) == 200
    for i in range(0, 200, 20):
        alone = S.fit_support_vectors(df.where(F.col("g") == rows[i][1]), ["a"], ["y"], "id", tolerance=1e-9).models if i in (0, 100) else None
        if alone is not None:
            assert abs(got[i] - S.predictor(alone)(np.array([[rows[i][2]]]))[0]) < 1e-9


def test_rows_that_few_span_are_solved_without_rounds(spark, monkeypatch):
    def rounds(*args):
        raise AssertionError("a fit of rows that few of them span went on in rounds")

    monkeypatch.setattr(S, "_fit_rounds", rounds)
    x, y = data(900)
    df = frame(spark, x, y, groups=2).withColumn("g", F.when(F.col("g") == "g1", F.col("g"))).withColumn("y", F.when(F.col("id") != 11, F.col("y")))
    whole = S.fit_support_vectors(df, ["a"], ["y"], "id", "fold", ["g"], tolerance=1e-6)
    fitted = S.fit_support_vectors(df, ["a"], ["y"], "id", "fold", ["g"], local_rows=100)
    want = {r["id"]: r for r in whole.predictions.collect()}
    got = fitted.predictions.collect()
    assert len(got) == len(want) == 899 and {r["g"] for r in got} == {"g1", None}
    for r in got:
        assert r["yhat_train"] == pytest.approx(want[r["id"]]["yhat_train"], abs=5e-3) and r["yhat_cv"] == pytest.approx(want[r["id"]]["yhat_cv"], abs=5e-3)
    known = {r["id"]: r["yhat_train"] for r in got}
    scored = S.score_experiments(df, fitted.models, ["a"], ["id"], ["g"]).collect()
    assert len(scored) == 900 and all(r["prediction"] == pytest.approx(known[r["id"]], abs=1e-7) for r in scored if r["id"] != 11)
    alone = S.fit_support_vectors(df.where("g is null"), ["a"], ["y"], "id", "fold", local_rows=100)
    assert all(r["yhat_cv"] == pytest.approx(want[r["id"]]["yhat_cv"], abs=5e-3) for r in alone.predictions.collect())


@pytest.mark.parametrize("scale", [0.1, 1.0, 30.0])
@pytest.mark.parametrize("repeated", [1, 4])
def test_the_spanned_solution_is_that_of_pairs(scale, repeated):
    x, y = data(1_600 // repeated, 3)
    x, y = np.tile(x, (repeated, 1)) / 2, scale * np.tile(y, repeated)
    points, beta, bias, gap = V.solve_spanned(x, y, 0.5, 1.0, 0.1, 1e-3)
    k = S.kernel(x, x, 0.5)
    pairs = S.solve(k, y, np.zeros(len(x)), tolerance=1e-5)
    residual = y - k @ pairs
    primal = S.gap_of(pairs, residual, y, 1.0, 0.1)[1]
    told = S.kernel(x, points, 0.5) @ beta + bias
    assert len(points) <= len(x) / V.SHARE and np.abs(told - (k @ pairs + S.bias_of(pairs, residual, 1.0, 0.1))).max() < 0.02 * scale
    # The primal of what is told lies above the optimum by no more than the gap says.
    weight = beta @ S.kernel(points, points, 0.5) @ beta
    mine = weight / 2 + np.maximum(np.abs(y - told) - 0.1, 0).sum()
    assert -1e-6 * primal <= mine - primal + S.gap_of(pairs, residual, y, 1.0, 0.1)[0] and mine - primal <= gap + 1e-9 * primal <= 1.1e-3 * primal


def test_passes_over_rows_that_are_not_kept(monkeypatch):
    x, y = data(1_500, 4)
    kept = V.solve_spanned(x / 3, y, 0.5, 1.0, 0.1, 1e-3)
    monkeypatch.setattr(V, "HELD", 0)
    monkeypatch.setattr(V, "PASS_ROWS", 97)
    anew = V.solve_spanned(x / 3, y, 0.5, 1.0, 0.1, 1e-3)
    one, other = (S.kernel(x / 3, f[0], 0.5) @ f[1] + f[2] for f in (kept, anew))
    assert np.abs(one - other).max() < 0.01


def test_rows_that_span_nothing_but_themselves_are_left_to_rounds():
    x, y = data(400)
    assert V.solve_spanned(20 * x, y, 0.5, 1.0, 0.1, 1e-3) is None
    points, beta, bias, gap = V.solve_spanned(np.zeros((400, 2)), np.full(400, 7.0), 1.0, 1.0, 0.1, 1e-3)
    assert len(points) == 1 and abs(beta[0] + bias - 7) <= 0.1 + 1e-9 and gap <= 1e-9
