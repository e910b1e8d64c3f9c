"""Trees from histograms: against brute force, between groups and tables, with folds, experiments and missing values."""

from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaysieve.operators import growing, target_statistics, tree_paths, validate
from assaysieve.operators import histogram_trees as T
from assaysieve.operators.growing import Style

NAMES = ["a", "b", "c"]


def table(spark, rows=160, seed=3, gaps=0.0, experiments=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, rows), rng.normal(size=rows).round(1), rng.integers(0, 3, rows)]).astype(float)
    y = x[:, 0] / 3 + np.sin(2 * x[:, 1]) + (x[:, 2] == 1) + rng.normal(size=rows) / 10
    x[rng.random(x.shape) < gaps] = np.nan
    data = [(i, f"g{i % experiments}", i % 4, *(None if np.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, "id bigint, g string, fold int, a double, b double, c double, y double").repartition(5), x, y


def split_by_force(bins, gradient, weight, style, nodes=None):
    """The best split of one node by trying all."""
    def score(which):
        w = weight[which].sum() + style.leaf_penalty
        return gradient[which].sum() ** 2 / w if w > 0 else 0.0

    best, found = 0.0, None
    for j in range(bins.shape[1]):
        lost = bins[:, j] == growing.MISSING
        for cut in range(growing.CUTS):
            for missing_left in (False, True):
                left = (~lost & (bins[:, j] <= cut)) | (lost & missing_left)
                if min(weight[left].sum(), weight[~left].sum()) < max(style.least_weight, 1e-9):
                    continue
                gain = score(left) + score(~left) - score(np.ones(len(bins), bool))
                if gain > best + 1e-9:
                    best, found = gain, (j, left)
    return best, found


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.0, 1.0]), st.sampled_from([0.0, 3.0]), st.booleans())
def test_best_split_is_the_best_of_all(seed, penalty, least, gaps):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 6, (40, 2)).astype(np.uint8)
    if gaps:
        bins[rng.random(bins.shape) < 0.2] = growing.MISSING
    gradient, weight = rng.normal(size=40), rng.integers(0, 3, 40).astype(float)
    gradient *= weight > 0
    style = Style(1, 1.0, penalty, least, depth=1)
    rows = growing.Rows(bins)
    rows.begin(gradient, weight)
    found = growing.best_splits(rows.sums([0]), style)
    want, split = split_by_force(bins, gradient, weight, style)
    assert found.gain[0] == pytest.approx(want, abs=1e-8)
    if split:
        own = bins[:, found.feature[0]]
        left = np.where(own == growing.MISSING, found.missing_left[0], own <= found.cut[0])
        assert (left[weight > 0] == split[1][weight > 0]).all() or growing._score(gradient[left].sum(), weight[left].sum(), penalty) + growing._score(
            gradient[~left].sum(), weight[~left].sum(), penalty) - growing._score(gradient.sum(), weight.sum(), penalty) == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("gaps", [False, True])
def test_a_full_tree_splits_every_node_at_its_best(gaps):
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 12, (120, 3)).astype(np.uint8)
    if gaps:
        bins[rng.random(bins.shape) < 0.15] = growing.MISSING
    y, weight = rng.normal(size=120), rng.integers(0, 3, 120).astype(float)
    tree = growing.grow_full(bins, y, weight)
    members = {0: np.flatnonzero(weight > 0)}
    for node in range(len(tree.feature)):
        own = members.pop(node)
        assert tree.weight[node] == weight[own].sum() and tree.value[node] == pytest.approx(np.average(y[own], weights=weight[own]))
        spread = ((y[own] - tree.value[node]) ** 2 * weight[own]).sum()
        if tree.feature[node] < 0:
            assert spread < 1e-9 or len(np.unique(bins[own], axis=0)) == 1
            continue
        mine = bins[own, tree.feature[node]]
        left = np.where(mine == growing.MISSING, tree.missing_left[node], mine <= tree.cut[node])
        members[tree.left[node]], members[tree.right[node]] = own[left], own[~left]
        gain, _ = split_by_force(bins[own], (y[own] - tree.value[node]) * weight[own], weight[own], Style(1, 1.0))
        parts = [((y[p] - np.average(y[p], weights=weight[p])) ** 2 * weight[p]).sum() for p in (own[left], own[~left])]
        assert spread - sum(parts) == pytest.approx(gain, abs=1e-8)
    assert not members


def test_best_first_sums_at_most_one_child(monkeypatch):
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 30, (500, 3)).astype(np.uint8), rng.normal(size=500)
    asked, old = [], growing.Rows.sums
    monkeypatch.setattr(growing.Rows, "sums", lambda self, nodes: asked.append(list(nodes)) or old(self, nodes))
    rows = growing.Rows(bins)
    rows.begin(-y, np.ones(500))
    tree = growing.grow(rows, Style(1, 1.0, least_weight=5, leaves=20))
    assert sum(f < 0 for f in tree.feature) == 20 and all(len(a) == 1 for a in asked) and len(asked) == 20
    pairs = [{tree.left[n], tree.right[n]} for n in range(len(tree.feature)) if tree.left[n] >= 0]
    assert all(len(p & {a[0] for a in asked}) == 1 for p in pairs)
    # The same tree as with every node summed anew: subtraction loses nothing that matters.
    leaf = tree.leaf_of(bins)
    for node in np.unique(leaf):
        assert tree.value[node] == pytest.approx(y[leaf == node].mean())
    assert min((leaf == n).sum() for n in np.unique(leaf)) >= 5


def test_symmetric_trees_have_one_split_per_level():
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 30, (400, 3)).astype(np.uint8), rng.normal(size=400)
    rows = growing.Rows(bins)
    rows.begin(-y, np.ones(400))
    tree = growing.grow(rows, Style(1, 1.0, 3.0, depth=4, symmetric=True))
    levels = {}
    for node, depth in enumerate(T._depths(tree)):
        if tree.feature[node] >= 0:
            levels.setdefault(depth, set()).add((tree.feature[node], tree.cut[node], tree.missing_left[node]))
    assert len(levels) == 4 and all(len(s) == 1 for s in levels.values()) and len(tree.feature) == 31


def test_sampling_by_gradient_keeps_the_sum():
    rng = np.random.default_rng(0)
    gradient, weight = rng.normal(size=200_000), np.ones(200_000)
    own = growing.one_sided_weights(gradient, weight, (0.2, 0.1), rng.random(200_000))
    assert (own[np.argsort(-np.abs(gradient))[:40_000]] == 1).all() and set(np.unique(own)) == {0.0, 1.0, 8.0}
    assert own.sum() == pytest.approx(200_000, rel=0.02) and (own > 0).mean() == pytest.approx(0.3, abs=0.01)


def test_resampling_draws_with_replacement():
    drawn = growing.resampled(np.random.default_rng(0).integers(0, 1 << 63, 100_000).astype(np.uint64), 5)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


KINDS = {
    "random_forest": {"trees": 4}, "second_order": {"trees": 3, "depth": 2}, "leaf_wise": {"trees": 2, "leaves": 4, "least_weight": 4.0}, "symmetric": {"trees": 2, "depth": 2},
}


def test_a_table_gives_what_a_group_gives(spark):
    df, x, y = table(spark, gaps=0.15)
    df = df.withColumn("fold", F.col("fold") % 2).persist()
    a, b = (T.fit_trees(df, NAMES, ["y"], list(KINDS), "id", "fold", options=KINDS, local_rows=n) for n in (1000, 40))
    got = {(r["model"], r["id"]): r for r in b.predictions.collect()}
    rows = a.predictions.collect()
    assert len(rows) == len(got) == 4 * 160
    for r in rows:
        other = got[r["model"], r["id"]]
        assert r["fold"] == other["fold"] == r["id"] % 4 % 2 and r["y"] == other["y"]
        assert r["yhat_train"] == pytest.approx(other["yhat_train"], abs=1e-9) and r["yhat_cv"] == pytest.approx(other["yhat_cv"], abs=1e-9)
    assert a.models.where(f"piece <> {T.ROOT}").isEmpty() and not b.models.where(f"piece <> {T.ROOT}").isEmpty()
    for kind in KINDS:
        for fitted in (a, b) if kind == "random_forest" else (a,):
            model = fitted.models.where(F.col("model") == kind)
            whole = {r["id"]: r["p"] for r in T.score_trees(df, model, NAMES, "p").collect()}
            shares = {r["id"]: r["p"] for r in T.score_trees(df, model, NAMES, "p", limit=300).collect()}
            for i, p in whole.items():
                assert p == pytest.approx(got[kind, i]["yhat_train"], abs=1e-9) and shares[i] == pytest.approx(p, abs=1e-9)


def test_sampling_by_gradient_over_a_table(spark):
    df, x, y = table(spark, rows=600)
    options = {"leaf_wise": {"trees": 5, "rate": 0.4, "leaves": 5, "least_weight": 4.0, "one_sided": (0.3, 0.2)}}
    for local_rows in (1000, 100):
        fitted = T.fit_trees(df.withColumn("fold", F.col("fold") % 2), NAMES, ["y"], ["leaf_wise"], "id", "fold", options=options, local_rows=local_rows)
        scores = validate.metrics(fitted.predictions).first()
        assert scores["status"] == "ok" and scores["cv_r2"] > 0.5


def test_every_kind_learns(spark):
    df, x, y = table(spark, rows=600)
    scores = {r["model"]: r for r in validate.metrics(T.fit_trees(df, NAMES, ["y"], list(T.STYLES), "id", "fold").predictions).collect()}
    assert set(scores) == set(T.STYLES) and all(r["n"] == 600 and r["status"] == "ok" and r["cv_r2"] > 0.9 for r in scores.values())


def test_experiments_are_fitted_as_if_alone(spark):
    df, x, y = table(spark, rows=240, experiments=3)
    df = df.withColumn("g", F.when(F.col("g") != "g2", F.col("g"))).withColumn("z", F.when(F.col("id") > 50, F.col("y") * 2))
    options = {"second_order": {"trees": 2, "depth": 2}, "random_forest": {"trees": 3}}
    df = df.withColumn("fold", F.col("fold") % 2).persist()
    together = T.fit_trees(df, NAMES, ["y", "z"], list(options), "id", "fold", by=["g"], options=options, local_rows=1000)
    mixed = T.fit_trees(df.where("id % 3 <> 0 or id < 60"), NAMES, ["y", "z"], list(options), "id", "fold", by=["g"], options=options, local_rows=70)
    got = {(r["g"], r["target"], r["model"], r["id"]): r for r in together.predictions.collect()}
    assert len(got) == 2 * (240 + 189)
    also = {(r["g"], r["target"], r["model"], r["id"]): r for r in mixed.predictions.collect()}
    for g in ("g0", "g1", None):
        own = df.where(F.col("g").eqNullSafe(F.lit(g)))
        alone = T.fit_trees(own, NAMES, ["y", "z"], list(options), "id", "fold", options=options)
        for r in alone.predictions.collect():
            other = got[g, r["target"], r["model"], r["id"]]
            assert (r["yhat_train"], r["yhat_cv"]) == pytest.approx((other["yhat_train"], other["yhat_cv"]))
            if g != "g0":
                other = also[g, r["target"], r["model"], r["id"]]
                assert (r["yhat_train"], r["yhat_cv"]) == pytest.approx((other["yhat_train"], other["yhat_cv"]))
    scored = {(r["g"], r["target"], r["model"], r["id"]): r["prediction"] for r in T.score_experiments(df, together.models, NAMES, ["id"], ["g"], rows_each=30).collect()}
    assert len(scored) == 4 * 240
    for key, r in got.items():
        assert scored[key] == pytest.approx(r["yhat_train"])


def test_missing_values_find_their_side(spark):
    rows = [(i, float(i % 2) if i % 3 else None, 5.0 if not i % 3 else float(i % 2), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, a double, y double, fold int")
    fitted = T.fit_trees(df, ["a"], ["y"], ["second_order"], "id", options={"second_order": {"trees": 30, "leaf_penalty": 0.0}})
    for r in T.score_trees(df, fitted.models, ["a"]).collect():
        assert r["yhat"] == pytest.approx(r["y"], abs=0.01)


def test_little_data_and_bad_options(spark):
    df, _, _ = table(spark, rows=3)
    for kind in T.STYLES:
        fitted = T.fit_trees(df, NAMES, ["y"], [kind], "id", "fold", options={kind: {"trees": 2}})
        assert fitted.predictions.count() == 3 and T.score_trees(df, fitted.models, NAMES).where("yhat is null").count() == 0
    nothing = T.fit_trees(df.withColumn("y", F.lit(None).cast("double")), NAMES, ["y"], ["random_forest"], "id")
    assert nothing.predictions.count() == 0 and nothing.models.count() == 0
    with pytest.raises(ValueError):
        T.style_of("random_forest", trees=0)
    with pytest.raises(KeyError):
        T.style_of("unknown")


def values_by_force(nodes, row):
    """Shapley values over all orders, where an unknown feature follows both branches in the shares of the training rows."""
    def value(known):
        def at(node):
            j = nodes.feature[node]
            if j < 0:
                return nodes.value[node]
            left, right = nodes.left[node], nodes.right[node]
            if j in known:
                return at(left if (nodes.missing_left[node] if np.isnan(row[j]) else row[j] <= nodes.at[node]) else right)
            whole = nodes.weight[left] + nodes.weight[right]
            return (at(left) * nodes.weight[left] + at(right) * nodes.weight[right]) / whole
        return nodes.start + sum(at(r) for r in nodes.roots)

    phi, orders = np.zeros(len(row)), list(permutations(range(len(row))))
    for order in orders:
        for i, j in enumerate(order):
            phi[j] += (value(set(order[:i + 1])) - value(set(order[:i]))) / len(orders)
    return phi, value(set())


@pytest.mark.parametrize("kind", list(T.STYLES))
@pytest.mark.parametrize("cells", [tree_paths.CELLS, 40])
def test_paths_give_shapley_values(spark, kind, cells, monkeypatch):
    """With and without the table of patterns."""
    monkeypatch.setattr(tree_paths, "CELLS", cells)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (70, 4)).astype(float)
    y = x[:, 0] * x[:, 1] / 5 + x[:, 2] + rng.normal(size=70)
    x[rng.random(x.shape) < 0.1] = np.nan
    cuts = [growing.cut_points(x[:, j]) for j in range(4)]
    bins, hashes = growing.binned(x, cuts), rng.integers(0, 1 << 62, 70).astype(np.uint64)
    style = T.style_of(kind, trees=3, **({"depth": 3} if kind in ("second_order", "symmetric") else {"least_weight": 3.0, "leaves": 8} if kind == "leaf_wise" else {}))
    scale, start = (1 / 3, 0.0) if style.bagged else (1.0, None)
    if style.bagged:
        trees, total = growing.forest(bins, y, np.ones(70), style, hashes, range(3))
        want = total / 3
    else:
        start, trees, want = growing.boost(bins, y, np.ones(70), style, hashes)
    import pyarrow as pa
    columns = T._tree_columns(trees, cuts, scale)
    nodes = T.joined_nodes(pa.table({"tree": pa.array(range(3), pa.int32()), "piece": pa.array([T.ROOT] * 3, pa.int32()), "start": [float(start or 0)] * 3, **columns}))
    assert nodes.predict(x) == pytest.approx(want)
    phi, base = tree_paths.tree_values(x, nodes)
    assert base + phi.sum(1) == pytest.approx(want, abs=1e-8)
    for i in range(6):
        own, mean = values_by_force(nodes, x[i])
        assert phi[i] == pytest.approx(own, abs=1e-8) and base == pytest.approx(mean)


def test_large_models_are_explained_in_shares(spark):
    df, x, y = table(spark, gaps=0.1)
    model = T.fit_trees(df, NAMES, ["y"], ["random_forest"], "id", options={"random_forest": {"trees": 6}}, local_rows=30).models
    whole = {r["id"]: r for r in tree_paths.explain_trees(df, NAMES, model, ["id"]).collect()}
    shares = tree_paths.explain_trees(df, NAMES, model, ["id"], limit=200).collect()
    scores = {r["id"]: r["yhat"] for r in T.score_trees(df, model, NAMES).collect()}
    assert len(shares) == len(whole) == 160 and len(T.tree_shares(model, 200)[0]) == 6 and T.tree_shares(model, 200)[1] == 6
    for r in shares:
        a, b = ([q[f"phi_{c}"] for c in NAMES] + [q["base"]] for q in (r, whole[r["id"]]))
        assert a == pytest.approx(b, abs=1e-9) and sum(a) == pytest.approx(scores[r["id"]], abs=1e-8)


@pytest.mark.parametrize("ranges", [1, 3, 4096])
def test_ordered_statistics_see_only_rows_before(spark, ranges):
    rng = np.random.default_rng(ranges)
    data = [(i, str(rng.integers(4)) if i % 7 else None, int(rng.integers(-50, 50)), float(i % 5) if i % 6 else None) for i in range(120)]
    df = spark.createDataFrame(data, "id bigint, t string, place bigint, y double").repartition(5)
    mean = np.mean([r[3] for r in data if r[3] is not None])
    got = {r["id"]: r["t_mean"] for r in target_statistics.ordered_statistics(df, ["t"], "y", "id", F.col("place"), 2.0, ranges).collect()}
    for i, t, place, _ in data:
        before = [r[3] for r in data if r[1] == t and (r[2], r[0]) < (place, i) and r[3] is not None]
        assert got[i] == pytest.approx((sum(before) + 2 * mean) / (len(before) + 2))
    hashed = target_statistics.ordered_statistics(df, ["t"], "y", "id")
    assert hashed.count() == 120 and hashed.columns == [*df.columns, "t_mean"]
    final = target_statistics.final_statistics(df, "t", "y", 2.0)
    new = target_statistics.apply_statistics(spark.createDataFrame([("1",), ("new",), (None,)], "t string"), final, "t", float(mean)).collect()
    for r in new:
        own = [q[3] for q in data if q[1] == r["t"] and q[3] is not None]
        assert r["t_mean"] == pytest.approx((sum(own) + 2 * mean) / (len(own) + 2))
    assert target_statistics.ordered_statistics(df.limit(0), ["t"], "y", "id").count() == 0


def test_statistics_of_a_column_do_not_run_those_of_the_columns_before(spark):
    from assaysieve.operators import target_statistics

    df = spark.range(40).selectExpr("id", "cast(id % 3 AS string) AS a", "cast(id % 4 AS string) AS b", "cast(id % 5 AS string) AS c", "cast(id AS double) AS y")
    found = target_statistics.ordered_statistics(df, ["a", "b", "c"], "y", "id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 3 and found.count() == 40


def test_best_first_trees_ask_for_all_open_leaves_together():
    rng = np.random.default_rng(2)
    bins, gradient = rng.integers(0, 40, (3000, 3)).astype(np.uint8), rng.normal(size=3000)
    gradient += bins[:, 0] / 9.0 - (bins[:, 1] > 25) * (bins[:, 2] / 7.0)

    class Asked(growing.Rows):
        """Rows that answer ahead, as a table does, and count the questions."""

        questions = 0

        def sums(self, nodes):
            self.questions += 1
            return super().sums(nodes)

        def ahead(self, splits):
            self.questions += 1
            out = []
            for node, feature, cut, missing_left, child in splits:
                places = self.members[node]
                left = np.where(bins[places, feature] == growing.MISSING, missing_left, bins[places, feature] <= cut)
                own = growing.Rows(bins)
                own.begin(gradient, np.ones(3000))
                own.members = {0: places[left != bool(child)]}
                out.append(own.sums([0])[0])
            return np.array(out)

    style = Style(1, 0.1, least_weight=20.0, leaves=31)
    asked, plain = Asked(bins), growing.Rows(bins)
    for rows in (asked, plain):
        rows.begin(gradient, np.ones(3000))
    assert growing.grow(asked, style) == growing.grow(plain, style)
    assert asked.questions <= 16  # one for each leaf without looking ahead: 31


@pytest.mark.parametrize("values", ["spread", "equal", "few"])
def test_the_border_of_a_rank_is_exact_whatever_the_tasks_hold(spark, values):
    rng = np.random.default_rng(4)
    y = {"spread": rng.normal(size=30_000), "equal": rng.integers(0, 3, 30_000).astype(float), "few": rng.normal(size=3)}[values]
    blocks = [(np.zeros((len(p), 1), np.uint8), p[:, None], np.zeros(len(p), np.int32), np.zeros(len(p), np.uint64), np.zeros((len(p), 1))) for p in np.split(y, [len(y) // 5, len(y) // 2])]
    state = T._State(spark.sparkContext.parallelize(blocks, 3))
    fit = T._Fit(0, 0, "leaf_wise", T.style_of("leaf_wise", one_sided=(0.2, 0.1)), T.FULL)
    wanted = np.sort(np.abs(y))[int(np.ceil(0.8 * len(y))) - 1]
    assert T._gradient_borders(spark, state, [fit]) == [wanted]


def test_a_forest_over_a_table_in_many_pieces_and_boxes(spark, monkeypatch):
    """Split by jobs at the top, and rows predicted by large models, out of fold too: as in groups."""
    df, x, y = table(spark)
    df = df.withColumn("fold", F.col("fold") % 2).persist()
    options = {"random_forest": {"trees": 3}}
    want = {r["id"]: r for r in T.fit_trees(df, NAMES, ["y"], ["random_forest"], "id", "fold", options=options).predictions.collect()}
    monkeypatch.setattr(T, "MODEL_BYTES", 5000)
    fitted = T.fit_trees(df, NAMES, ["y"], ["random_forest"], "id", "fold", options=options, local_rows=4)
    assert fitted.models.where(f"piece <> {T.ROOT}").count() > 3 * 8 and T.model_bytes(fitted.models) > 5000
    got = fitted.predictions.collect()
    assert len(got) == len(want) == 160
    for r in got:
        assert (r["fold"], r["y"]) == (want[r["id"]]["fold"], want[r["id"]]["y"])
        assert (r["yhat_train"], r["yhat_cv"]) == pytest.approx((want[r["id"]]["yhat_train"], want[r["id"]]["yhat_cv"]), abs=1e-9)


def test_rows_of_a_forest_travel_as_few_bytes(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, *(float(v) for v in rng.normal(size=3)), float(rng.normal())) for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, fold int, a double, b double, c double, y double")
    path = T.scratch_path(spark, "test")
    cuts = [growing.cut_points(np.array([r[2 + j] for r in rows])) for j in range(3)]
    df.select(F.col("id").alias("row"), F.xxhash64("id").alias("hash"), "fold", F.array("y").alias("ys"), T._binner(cuts)(F.array("a", "b", "c")).alias("bins")).coalesce(1).write.parquet(path)
    found = spark.read.parquet(path).mapInArrow(T._to_pieces(3, 0, T.FULL, T.style_of("random_forest"), {n: growing.Tree() for n in range(4)}), "tree int, piece int, rows int, block binary").collect()
    assert 0.6 < sum(r["rows"] for r in found) / (4 * 4000) < 0.66  # rows that are not drawn stay where they are
    assert sum(len(r["block"]) for r in found) < 13 * sum(r["rows"] for r in found)
    twice = df.withColumn("id", F.col("id") * 10).union(df.withColumn("id", F.col("id") * 10 + 1)).withColumn("y", F.lit(1.0)).withColumns({c: F.lit(2.0) for c in NAMES})
    path = T.scratch_path(spark, "test")
    twice.select(F.col("id").alias("row"), F.xxhash64("id").alias("hash"), "fold", F.array("y").alias("ys"), T._binner(cuts)(F.array("a", "b", "c")).alias("bins")).coalesce(1).write.parquet(path)
    same = spark.read.parquet(path).mapInArrow(T._to_pieces(3, 0, T.FULL, T.style_of("random_forest"), {0: growing.Tree()}), "tree int, piece int, rows int, block binary").collect()
    assert [r["rows"] for r in same] == [1]
    weight = T._split_bytes(same[0]["block"], (np.uint8, 3), (np.float64, 1), (np.uint32, 1))[2]
    assert weight[0] == growing.resampled(np.array([r[0] for r in twice.select(F.xxhash64("id")).collect()]).view(np.uint64), 0).sum()


def test_a_table_of_a_forest_holds_trees_only(spark, monkeypatch):
    """No row per row and tree is written where predictions are not asked for."""
    df, x, y = table(spark)
    written, old = [], T._forest_table
    monkeypatch.setattr(T, "_forest_table", lambda *a: written.extend(old(*a)) or written)
    fitted = T.fit_trees(df, NAMES, ["y"], ["random_forest"], "id", options={"random_forest": {"trees": 3}}, local_rows=10)
    assert fitted.models.count() > 3 and all(t.where("tree is null").isEmpty() for t in written)


@pytest.mark.parametrize("rows_each", [7, 100_000])
def test_large_models_meet_rows_in_boxes(spark, monkeypatch, rows_each):
    """Missing and endless numbers, rows far from those fitted on, and many equal rows included; a box gets the nodes that its rows may reach."""
    df, x, y = table(spark, rows=400, gaps=0.1)
    model = T.fit_trees(df, NAMES, ["y"], ["random_forest"], "id", options={"random_forest": {"trees": 5}}, local_rows=10).models
    rng = np.random.default_rng(8)
    values = [None, float("nan"), float("inf"), float("-inf"), -1e300, 0.0, 0.05, 1.0, 2.0, 3.5, 8.0, 99.0]
    library = [(i, *(values[k] for k in rng.integers(0, len(values), 3))) for i in range(300)] + [(1000 + i, 1.0, 0.5, 2.0) for i in range(100)]
    library = spark.createDataFrame(library, "id bigint, a double, b double, c double").persist()
    want = {r["id"]: r["yhat"] for r in T.score_trees(library, model, NAMES).collect()}
    monkeypatch.setattr(T, "LOCAL_ROWS", rows_each)
    for limit in (4000, 20_000):
        got = T.score_trees(library, model, NAMES, limit=limit).collect()
        assert len(got) == 400
        for r in got:
            assert r["yhat"] == pytest.approx(want[r["id"]], abs=1e-9)
    assert T.score_trees(library.limit(0), model, NAMES, limit=4000).count() == 0


def test_boxes_share_out_the_nodes_of_a_tree():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(20_000, 3))
    cuts = [growing.cut_points(x[:, j]) for j in range(3)]
    tree = growing.grow_full(growing.binned(x, cuts), rng.normal(size=20_000), np.ones(20_000))
    import pyarrow as pa
    nodes = T.joined_nodes(pa.table({"tree": pa.array([0], pa.int32()), "piece": pa.array([T.ROOT], pa.int32()), "start": [0.0], **T._tree_columns([tree], cuts, 1.0)}))
    boxes = T._boxes(x, 20_000 // 16)
    box, node, both = T._cut_to_boxes(nodes, boxes)
    assert len(boxes.low) == 16 and np.bincount(boxes.of(x)).max() <= 20_000 // 16
    assert len(tree.feature) <= node.size < 2 * len(tree.feature)  # whole trees for each box would be 16 times as many
    assert set(zip(boxes.of(x).tolist(), nodes.leaf_of(x, 0).tolist(), strict=True)) <= set(zip(box.tolist(), node.tolist(), strict=True))


def test_tables_that_fit_pieces_are_not_split_by_jobs(spark, monkeypatch):
    calls = []
    split = T._split_large
    monkeypatch.setattr(T, "_split_large", lambda *a: calls.append(1) or split(*a))
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(900, 2)), 1)
    rows = [(i, float(a), float(b), float(round(a * b + e, 3))) for i, ((a, b), e) in enumerate(zip(x, rng.normal(size=900), strict=True))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, y double").repartition(3)

    def told():
        model = T.fit_trees(df, ["a", "b"], ["y"], ["random_forest"], "id", options={"random_forest": {"trees": 3}}, local_rows=50).models
        return {r["id"]: r["p"] for r in T.score_trees(df, model, ["a", "b"], "p").collect()}

    monkeypatch.setattr(T, "LOCAL_ROWS", 50)
    monkeypatch.setattr(T, "PIECE_ROWS", 2_000, raising=False)
    whole = told()
    assert len(calls) == 1  # the one that finds every tree's root small enough
    monkeypatch.setattr(T, "PIECE_ROWS", 0)
    parts = told()
    assert len(calls) > 3 and all(whole[k] == pytest.approx(parts[k]) for k in parts)


@pytest.mark.parametrize("number", [0, 5, 99])
def test_draws_follow_the_steps_of_the_poisson_numbers(number):
    hashes = np.random.default_rng(number).integers(0, 2**64, 200_000, dtype=np.uint64)
    steps = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))
    assert (growing.resampled(hashes, number) == np.searchsorted(steps, growing.uniform(hashes, number), "right")).all()


def test_columns_of_trees():
    trees = [growing.Tree([1, -1, -1], [2, -1, -1], [True, False, False], [1, -1, -1], [2, -1, -1], [0.5, 1.0, 3.0], [3.0, 2.0, 1.0]), growing.Tree()]
    found = T._tree_columns(trees, [np.array([0.5]), np.array([1.0, 2.0])], 0.5)
    assert found["at"].to_pylist() == [[np.inf, None, None], [None]] and found["value"].to_pylist() == [[0.25, 0.5, 1.5], [0.0]]
    assert found["feature"].to_pylist() == [[1, -1, -1], [-1]] and all(len(c) == 0 for c in T._tree_columns([], [], 1.0).values())
