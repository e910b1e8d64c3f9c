"""Operators on embeddings against brute force: near copies, whitening, hard negatives."""

import math
import random

import awkward
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.llm import gnat, hard_negatives, vector_links, whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def clustered(seed, rows=300, size=12, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, size))
    out = []
    for i in range(rows):
        v = centres[rng.integers(20)] + rng.standard_normal(size) * rng.choice([0.0, 0.02, 0.15, 0.5])
        out.append((int(rng.integers(0, rows)) if i % 17 == 0 else i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(rng.integers(labels))))
    return out


def awkward_vectors():
    inf, nan = float("inf"), float("nan")
    base = clustered(5, 120, 6)
    return [*base, (500, None, 1), (501, [], 1), (502, [0.0] * 6, 1), (503, [-0.0] * 6, 1), (504, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (505, [inf] * 6, 0), (506, [nan, 1.0, 0.0, 0.0, 0.0, 0.0], 0),
            (507, base[0][1], None), (None, base[0][1], base[0][2]), (None, None, None), (508, [1.0, 2.0], 1), (509, [2.0, 4.0], 1), base[0], base[0], (510, [1e30] * 6, 2), (511, [1e-30] * 6, 2),
            (512, [0.0, 1.0, -0.0, 0.0, 0.0, 0.0], 1), (513, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 1), (514, [1.0] * 7, 2)]


def frame(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    return df.withColumns({c: F.lit("x") for c in [*awkward.CLASHES, "vector", "copies", "place", "cell", "row", "x", "size", "rank", "turn", "score", "usable", "home", "slice", "anchor"] if c not in VECTORS.names}) if clashes else df


def good(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def links_by_force(rows, threshold=0.93):
    n = len(rows)
    near = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if x is None or x != y or not good(a) or not good(b) or len(a) != len(b) or not any(a) or not any(b):
                continue
            a, b = (np.array(v) / max(map(abs, v)) for v in (a, b))
            if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, least is not None and least == rows[i][0]))
    return awkward.counted(out)


@pytest.mark.parametrize("options", [{}, {"cell_rows": 12, "slice_rows": 25, "sample": 40}, {"cell_rows": 5, "slice_rows": 1000, "sample": 60}])
def test_near_copies_of_awkward_rows(spark, options):
    rows = awkward_vectors()
    got = vector_links.near_copies(frame(spark, rows, clashes=True), **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert awkward.counted(tuple(r) for r in got.collect()) == links_by_force(rows)


@pytest.mark.parametrize(("seed", "threshold", "cell_rows"), [(1, 0.93, 20), (2, 0.6, 30), (3, 0.999, 10), (4, 0.05, 25)])
def test_near_copies_in_cells(spark, seed, threshold, cell_rows):
    rows = clustered(seed)
    got = vector_links.near_copies(frame(spark, rows), threshold=threshold, cell_rows=cell_rows, slice_rows=60, sample=100)
    assert awkward.counted(tuple(r) for r in got.collect()) == links_by_force(rows, threshold)


def test_near_copies_of_an_empty_table_and_doubles(spark):
    assert vector_links.near_copies(frame(spark, [])).count() == 0
    rows = [(1, [1.0, 1e-200], "a"), (2, [1e200, 0.0], "a"), (3, [1.0, 0.0], "b")]
    got = vector_links.near_copies(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")).orderBy("vec_id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    with pytest.raises(ValueError):
        vector_links.near_copies(frame(spark, rows[:0]), threshold=0)


def test_one_vector_of_each_component_stays(spark):
    rows = [(3, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (4, None, 1)]
    left = vector_links.deduplicate(frame(spark, rows))
    assert sorted(str(r["vec_id"]) for r in left.collect()) == ["1", "2", "4", "None"]


def test_bounds_hold_for_long_and_lopsided_vectors():
    rng = np.random.default_rng(0)
    for size in (1, 3, 64, 1041, 3000):
        a = vector_links.units_of(rng.standard_normal((40, size)) ** 5)
        codes, step, error = vector_links.quantised(a)
        exact = codes.astype(np.int64) @ codes.astype(np.int64).T
        assert (vector_links.code_products(codes, codes) == exact).all()
        most = exact * step[:, None] * step + error[:, None] * (1 + error) + error + vector_links.SLACK
        assert (a @ a.T <= most).all()
        for threshold in (0.1, 0.9):
            assert (vector_links.linked_pairs(a, a, threshold) == (a @ a.T >= threshold)).all()


def whitened_by_force(rows):
    fit = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows if good(v)]
    lengths = [len(x) for _, x in fit]
    size = max(set(lengths), key=lambda k: (lengths.count(k), k))
    kept = [(i, x) for i, x in fit if len(x) == size]
    distinct = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(distinct), distinct.sum(0)
    centred = (distinct - sums / n).astype(float)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    out = {}
    for c in range(min(4, size)):
        if values[c] > size * np.finfo(float).eps * values.sum():
            out[c + 1] = sorted((str(i), n, sum((n * a - b) ** 2 for a, b in zip(x, sums, strict=True)), values[c] / values.sum(),
                                 float((np.array(x, float) - (sums / n).astype(float)) @ directions[:, c] / math.sqrt(values[c]))) for i, x in kept)
    return out


def check_whitened(spark, rows):
    want = whitened_by_force(rows)
    got = whitening.whiten(frame(spark, rows, clashes=True)).collect()
    assert len(got) == sum(map(len, want.values()))
    assert all(r["identity_error"] <= 1e-9 for r in got)
    for component, expected in want.items():
        mine = [r for r in got if r["component"] == component]
        assert sorted((str(r["vec_id"]), r["n"], r["deviation"]) for r in mine) == sorted(e[:3] for e in expected)
        a, b = (sorted(x) for x in ([r["whitened"] for r in mine], [e[4] for e in expected]))
        sign = 1 if np.allclose(a, b, atol=1e-8) else -1
        for e, r in zip(sorted(expected, key=lambda e: (e[0], sign * e[4])), sorted(mine, key=lambda r: (str(r["vec_id"]), r["whitened"])), strict=True):
            assert abs(sign * e[4] - r["whitened"]) < 1e-8 and abs(e[3] - r["explained"]) < 1e-10


@pytest.mark.parametrize("size", [1, 2, 3, 6, 50])
def test_whitening_against_a_full_decomposition(spark, size):
    check_whitened(spark, clustered(size, 150, size))


def test_whitening_of_awkward_rows(spark):
    rows = [r for r in awkward_vectors() if r[0] not in (510, 511)]
    check_whitened(spark, rows)
    assert whitening.whiten(frame(spark, [])).count() == 0
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]))
    assert same.count() == 0 and same.columns == whitening.whiten(frame(spark, [])).columns
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, -float(i)], 0) for i in range(5)])).collect()
    assert {r["component"] for r in flat} == {1}


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(i, [float(2.0 ** 40 * (i % 3)), float(i)], 0) for i in range(9)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    steps = [(int(256 * a), int(256 * b)) for _, (a, b), _ in rows]
    sums = [sum(s[k] for s in steps) for k in (0, 1)]
    exact = [sum((9 * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in steps]
    assert got == {i: e if e < 1 << 63 else None for i, e in enumerate(exact)} and None in got.values() and set(got.values()) != {None}


def test_leading_pairs_of_close_and_repeated_eigenvalues():
    rng = np.random.default_rng(0)
    for spectrum in ([5, 5, 5, 5, 5, 1, 1], [1.0, 1 - 1e-6, 1 - 2e-6, 1 - 3e-6, 1 - 4e-6, *np.linspace(0.9, 0, 60)], [3, 2, 1, 0, 0, 0], [1e12, 1, 0.9, 0.8, *[0.1] * 40], [0] * 5):
        q = np.linalg.qr(rng.standard_normal((len(spectrum),) * 2))[0]
        matrix = (q * np.array(spectrum, float)) @ q.T
        values, vectors = whitening.leading_pairs(lambda u, m=matrix: m @ u, len(spectrum), 4)
        assert np.allclose(values, sorted(spectrum, reverse=True)[:4], atol=1e-11 * max(1, *spectrum), rtol=0)
        assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)


def negatives_by_force(rows, positives=5, negatives=10):
    known = [(i, [math.floor(256 * c) for c in v], x) for i, v, x in rows if good(v) and x is not None]
    lengths = [len(v) for _, v, _ in known]
    size = max(set(lengths), key=lambda k: (lengths.count(k), k))
    known = [r for r in known if len(r[1]) == size and sum(c * c for c in r[1]) <= 1 << 55]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for n, (anchor, v, label) in enumerate(known):
        if anchor is None or anchor % 10:
            continue
        scored = [(i, dot(v, w), x) for m, (i, w, x) in enumerate(known) if m != n]
        for p, ps, _ in sorted((r for r in scored if r[2] == label), key=order)[:positives]:
            inside = [r for r in scored if r[2] != label and 30 * ps <= 100 * r[1] <= 90 * ps]
            out += [(anchor, p, rank + 1, i, ps, s) for rank, (i, s, _) in enumerate(sorted(inside, key=order)[:negatives])]
    return awkward.counted(out)


@pytest.mark.parametrize("options", [{}, {"cell_rows": 15, "slice_rows": 20, "sample": 30, "block_anchors": 4}])
def test_hard_negatives_of_awkward_rows(spark, options):
    rows = awkward_vectors()
    got = hard_negatives.mine(frame(spark, rows, clashes=True), F.col("vec_id") % 10 == 0, **options)
    want = negatives_by_force(rows)
    assert want and awkward.counted(tuple(r) for r in got.collect()) == want
    assert hard_negatives.mine(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hard_negatives_with_ties(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [float(rng.choice([0, 0.25, 0.5, 1])) for _ in range(4)], rng.randrange(2)) for i in range(400)]
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, cell_rows=60, slice_rows=50, sample=50, block_anchors=9)
    assert awkward.counted(tuple(r) for r in got.collect()) == negatives_by_force(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tree_search_alone(seed):
    rng = np.random.default_rng(seed)
    size, count = [(2, 3000), (8, 2000), (3, 1), (5, 700), (4, 1500), (16, 900)][seed]
    rows = np.floor(rng.standard_normal((count, size)) * [40, 3, 40, 1000, 2, 50][seed]).astype(np.int64)
    if seed == 4:
        rows[:1200] = rows[0]
    if seed == 5:
        rows[0] *= 1 << 20
    ids = rng.permutation(count)
    queries = rows[rng.integers(0, count, 60)]
    of = np.sort(rng.integers(0, 60, 150))
    least = rng.integers(-2000, 4000, 150)
    most = least + rng.integers(-10, 5000, 150)
    kinds = rng.integers(0, 2, count)
    window, score, row = gnat.search(gnat.grow(rows, np.arange(count), 5, 20), rows, ids, queries, of, least, most, 7, lambda q, r: (q[:, None] + kinds[r]) % 2 == 0)
    got = sorted(zip(window.tolist(), (-score).tolist(), ids[row].tolist(), strict=True))
    want = []
    for w in range(150):
        table = rows @ queries[of[w]]
        fits = np.flatnonzero((table >= least[w]) & (table <= most[w]) & ((of[w] + kinds) % 2 == 0))
        want += sorted((w, -int(table[r]), int(ids[r])) for r in fits)[:7]
    assert got == sorted(want)


def test_tree_passes_over_what_cannot_hold_a_result():
    rng = np.random.default_rng(0)
    rows = np.floor((rng.standard_normal((40, 16)) * 300)[rng.integers(0, 40, 20_000)] + rng.standard_normal((20_000, 16)) * 5).astype(np.int64)
    compared, old = [], gnat.scores
    try:
        gnat.scores = lambda q, r: compared.append(q.shape[0] * r.shape[0]) or old(q, r)
        queries = rows[:50]
        own = (queries * queries).sum(1)
        gnat.search(gnat.grow(rows, np.arange(20_000)), rows, np.arange(20_000), queries, np.arange(50), own * 8 // 10, own, 10, lambda q, r: np.ones((q.size, r.size), bool))
    finally:
        gnat.scores = old
    assert sum(compared) < 0.35 * 50 * 20_000
