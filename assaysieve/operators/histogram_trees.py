"""Forests and three kinds of boosted trees for every experiment, target and fold, in the same few jobs.

An experiment of up to `LOCAL_ROWS` rows is dealt as one group per fit: target, model, left-out fold and, for forests, a share of the trees. A larger one stays a table
of binned rows: all its fits go in step, and each step, a level or a leaf of all of them, is one job that adds up gradients and weights by
(fit, node, feature, bin). Forests are grown so until a node fits a task, which then grows all below it. The rules are those of `growing`, whichever way the sums come about.
Such a forest's rows are predicted by its trees when they are asked for: large models and rows meet in boxes of the features, each with the part of every tree that it reaches.

A fitted model is a table with one row per tree (or piece of one): nodes in arrays, borders as numbers of the features.
"""

from __future__ import annotations

import math
import pickle
import threading
from collections.abc import Callable, Iterator, Sequence
from copy import deepcopy
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.functions.exprs import col
from assaysieve.operators import growing, kernels
from assaysieve.operators.growing import BINS, Style, Tree
from assaysieve.operators.skew import lookup_join
from assaysieve.session import checkpointable, delete_paths, scratch_path

# How the trees of each model name grow: numbers of trees, steps, depths, leaves and penalties as the packages of these kinds have by default,
# but for `symmetric`, which takes fewer and longer steps than a thousand.
STYLES = {
    "random_forest": Style(100, 1.0, bagged=True),
    "second_order": Style(100, 0.3, leaf_penalty=1.0, least_weight=1.0, depth=6),
    "leaf_wise": Style(100, 0.1, least_weight=20.0, leaves=31),
    "symmetric": Style(300, 0.1, leaf_penalty=3.0, depth=6, symmetric=True),
}
LOCAL_ROWS = 100_000  # rows that one group may hold
BUNDLES = 16  # shares in which a forest's trees are dealt
PIECE_ROWS = 2_000_000  # that one piece of a large forest's tree may weigh: its rows come as bytes
PIECE = 5  # times `local_rows`, where a caller sets that below `LOCAL_ROWS`, and at least
MODEL_BYTES = 64 * 1024 * 1024  # nodes that are copied to the executors; larger models are joined to the rows
NODE_BYTES = 37
REWRITE = 10  # rounds of boosting after which the predictions so far are written down
BLOCK_ROWS = 500_000  # rows of a large experiment that one task holds in its steps
DRIVER_ANSWERS = 32  # tasks whose sums are added up by the driver itself
SAMPLED = 1000  # sizes of gradients that a task tells of to find the border of a rank
FULL = -1  # left-out fold of the fit on all rows
ARRAYS = "feature array<int>, at array<double>, missing_left array<boolean>, left array<int>, right array<int>, value array<double>, weight array<double>"
ARRAY_NAMES = [a.split()[0] for a in ARRAYS.split(", ")]
NODE_KINDS = {"feature": np.int32, "cut": np.int16, "missing_left": bool, "left": np.int32, "right": np.int32, "value": float, "weight": float}
ROOT = -1  # piece that holds a tree's root
BOX_ROWS = 100_000  # sampled rows at most from which the borders of boxes are chosen


def style_of(kind: str, **options) -> Style:
    style = replace(STYLES[kind], **options)
    if style.trees < 1:
        raise ValueError("a model needs at least one tree")
    if style.leaves is None and style.depth is None and not style.bagged:
        raise ValueError("boosted trees need a depth or a number of leaves")
    return style


@dataclass
class Fitted:
    """Models by experiment, target and model: `start` plus the sum of the trees' values. And the predictions of the rows they were fitted on."""

    by: list[str]
    features: list[str]
    models: DataFrame
    predicted: Callable[[], DataFrame]

    @cached_property
    def predictions(self) -> DataFrame:
        return self.predicted()


def _tree_columns(trees: list[Tree], cuts: Sequence[np.ndarray], scale: float) -> dict[str, pa.Array]:
    # A cut after the last value tells known values from missing ones.
    borders = np.full((len(cuts) + 1, BINS), np.inf)
    for own, known in zip(borders, cuts, strict=False):
        own[:known.size] = known
    offsets = np.cumsum([0, *(len(t.feature) for t in trees)]).astype(np.int32)
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.array(getattr(t, name), kind) for t in trees)])
    lists = lambda values, mask=None: pa.ListArray.from_arrays(offsets, pa.array(values, mask=mask))
    feature = flat("feature", np.int32)
    return {
        "feature": lists(feature), "at": lists(borders[feature, flat("cut", np.int64)], feature < 0), "missing_left": lists(flat("missing_left", bool)),
        "left": lists(flat("left", np.int32)), "right": lists(flat("right", np.int32)), "value": lists(flat("value", float) * scale), "weight": lists(flat("weight", float)),
    }


def _features(table: pa.Table, count: int) -> np.ndarray:
    return np.column_stack([table[f"f{j}"].to_numpy() for j in range(count)]).astype(float) if count else np.zeros((table.num_rows, 0))


def _local_fit(by: list[str], features: int, styles: dict[str, Style]):
    """One fit, or a share of a forest: predictions of the rows it is asked for and, if no fold is left out, its trees."""

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        model, share, left_out = (k.as_py() for k in key[-3:])
        style = styles[model]
        x, y, fold = _features(table, features), table["y"].to_numpy(), table["fold"].to_numpy()
        row_hash = table["hash"].to_numpy().view(np.uint64)
        cuts = [growing.cut_points(x[:, j]) for j in range(features)]
        bins, weight = growing.binned(x, cuts), (fold != left_out).astype(float)
        scale, start = 1.0, 0.0
        if not weight.any():
            trees, numbers, values = [], [], np.full(len(y), np.nan)
        elif style.bagged:
            numbers, scale = list(range(share, style.trees, BUNDLES)), 1.0 / style.trees
            trees, total = growing.forest(bins, y, weight, style, row_hash, numbers)
            values = total * scale
        else:
            start, trees, values = growing.boost(bins, y, weight, style, row_hash)
            numbers = list(range(style.trees))
        asked = np.arange(len(y)) if left_out == FULL else np.flatnonzero(fold == left_out)
        n, t = asked.size, len(trees) if left_out == FULL else 0
        known = lambda found, missing, kind: pa.concat_arrays([found, pa.nulls(missing, kind)])
        out = {name: pa.array([key[i].as_py()] * (n + t), key[i].type) for i, name in enumerate([*by, "target", "model"])}
        out["left_out"] = pa.array(np.full(n + t, left_out), pa.int32())
        out["row"] = known(table["row"].combine_chunks().take(pa.array(asked)), t, table["row"].type)
        out["fold"] = known(pa.array(fold[asked], pa.int32()), t, pa.int32())
        out["y"], out["yhat"] = (known(pa.array(v[asked], pa.float64()), t, pa.float64()) for v in (y, values))
        nothing = lambda kind: pa.nulls(n, kind)
        out["tree"] = pa.concat_arrays([nothing(pa.int32()), pa.array(numbers[:t], pa.int32())])
        out["piece"] = pa.concat_arrays([nothing(pa.int32()), pa.array([ROOT] * t, pa.int32())])
        out["start"] = pa.concat_arrays([nothing(pa.float64()), pa.array([start] * t, pa.float64())])
        for name, column in _tree_columns(trees[:t], cuts, scale).items():
            out[name] = pa.concat_arrays([nothing(column.type), column])
        return pa.table(out)

    return fit


def fit_trees(
    rows: DataFrame, features: Sequence[str], targets: Sequence[str], kinds: Sequence[str], row_id: str, fold: str | None = None,
    by: Sequence[str] = (), options: dict[str, dict] | None = None, local_rows: int = LOCAL_ROWS,
) -> Fitted:
    """Fit every kind of tree model for every experiment and target: on all rows and, if there is a fold, without each fold.

    Rows without a target value take no part in its models. A missing feature is a value of its own: each split learns to which side it goes, and
    sends it with the smaller numbers' complement if there was none to learn from. Row ids are unique within an experiment. Cut points lie between
    neighbouring values of the experiment's rows; beyond 255 values, between quantiles.
    """
    by, features, targets = list(by), list(features), list(targets)
    styles = {k: style_of(k, **(options or {}).get(k, {})) for k in dict.fromkeys(kinds)}
    spark = rows.sparkSession
    numbers = {f"f{j}": F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for j, c in enumerate(features)}
    values = F.array(*[F.struct(F.lit(t).alias("target"), col(t).cast("double").alias("y")) for t in targets])
    base = rows.select(
        *[col(k) for k in by], col(row_id).alias("row"), F.xxhash64(col(row_id).cast("string")).alias("hash"),
        (col(fold).cast("int") if fold else F.lit(0)).alias("fold"), *[v.alias(n) for n, v in numbers.items()], values.alias("_targets"))
    large = base.groupBy(*by).count().where(F.col("count") > local_rows).drop("count") if by else None
    whole = base.count() if not by else 0
    outputs, unseen = [], []
    if by or whole <= local_rows:
        small = _without(base, large, by) if by else base
        outputs.append(_fit_groups(small, by, len(features), styles, fold is not None))
    if by:
        for key in large.collect():  # experiments too large for a task: fewer than rows / local_rows
            own = base.where(_is(key, by)).drop(*by)
            found, forests = _fit_table(own, len(features), targets, styles, fold is not None, local_rows)
            kinds_of = dict(base.dtypes)
            outputs += [f.withColumns({k: F.lit(key[k]).cast(kinds_of[k]) for k in by}).select(*[col(k) for k in by], *f.columns) for f in found]
            unseen += [(key, f) for f in forests]
    elif whole > local_rows:
        found, forests = _fit_table(base, len(features), targets, styles, fold is not None, local_rows)
        outputs += found
        unseen += [(None, f) for f in forests]
    path = scratch_path(spark, "tree-fits")
    for n, found in enumerate(outputs):
        found.write.option("compression", "zstd").parquet(f"{path}/{n}")
    fits = spark.read.schema(outputs[0].schema).parquet(*[f"{path}/{n}" for n in range(len(outputs))])
    keys = [*by, "target", "model"]
    full = F.col("left_out") == FULL
    models = fits.where(F.col("tree").isNotNull() & full).select(*[col(k) for k in keys], "tree", "piece", "start", *ARRAY_NAMES)

    def predicted() -> DataFrame:
        columns = ["left_out", "row", "fold", "y", "yhat"]
        told = [fits.where("row is not null").select(*[col(k) for k in keys], *columns)]
        kinds_of = dict(base.dtypes)
        for key, forest in unseen:
            found = forest.predictions(fits if key is None else fits.where(_is(key, by)))
            own = {k: F.lit(key[k]).cast(kinds_of[k]) for k in by} if key is not None else {}
            told.append(found.select(*[v.alias(k) for k, v in own.items()], "target", "model", *columns))
        # A forest in shares has several rows per row and fit, each with the sum over its trees.
        out = reduce(DataFrame.unionByName, told).groupBy(*[col(k) for k in keys], "row").agg(
            F.max("fold").alias("fold"), F.max("y").alias("y"), F.sum(F.when(full, F.col("yhat"))).alias("yhat_train"),
            F.sum(F.when(~full, F.col("yhat"))).alias("yhat_cv"))
        nan_to_null = {c: F.when(~F.isnan(c), F.col(c)) for c in ("yhat_train", "yhat_cv")}
        return out.withColumns(nan_to_null).withColumnRenamed("row", row_id)

    return Fitted(by, features, models, predicted)


def _is(key, by: list[str]) -> Column:
    same = F.lit(True)
    for k in by:
        same = same & col(k).eqNullSafe(F.lit(key[k]))
    return same


def _without(base: DataFrame, large: DataFrame, by: list[str]) -> DataFrame:
    same = F.lit(True)
    for k in by:
        same = same & base[k].eqNullSafe(large[k])
    return base.join(F.broadcast(large), same, "left_anti")  # one row per experiment beyond local_rows


def exploded_fits(base: DataFrame, by: list[str], features: int, folds: bool) -> DataFrame:
    """Each row once for every target it has and every fit of its experiment: that on all rows (`left_out` is FULL), and those without a fold.

    Every fit sees all rows of its experiment: those of the left-out fold are only predicted.
    """
    dealt = base.select("*", F.explode("_targets").alias("_t")).where("_t.y is not null").select(
        *[col(k) for k in by], "_t.target", "_t.y", "row", "hash", "fold", *[f"f{j}" for j in range(features)])
    if not folds:
        return dealt.withColumn("left_out", F.lit(FULL))
    packed = base.groupBy(*[col(k) for k in by]).agg(F.collect_set("fold").alias("_left"))
    return _attach(dealt, packed, by).withColumn("left_out", F.explode(F.array_union(F.array(F.lit(FULL)), F.col("_left")))).drop("_left")


def _fit_groups(base: DataFrame, by: list[str], features: int, styles: dict[str, Style], folds: bool) -> DataFrame:
    jobs = F.array(*[F.struct(F.lit(k).alias("model"), F.lit(b).alias("share")) for k, s in styles.items() for b in (range(min(BUNDLES, s.trees)) if s.bagged else [0])])
    dealt = exploded_fits(base, by, features, folds).withColumn("_j", F.explode(jobs)).select("*", "_j.*").drop("_j")
    kinds = dict(base.dtypes)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in by], "target string, model string, left_out int", f"row {kinds['row']}",
                        "fold int, y double, yhat double, tree int, piece int, start double", ARRAYS])
    keys = [*[col(k) for k in by], F.col("target"), F.col("model"), F.col("share"), F.col("left_out")]
    return spread_fits(dealt, base, keys).groupBy(*keys).applyInArrow(_local_fit(by, features, styles), schema)


def spread_fits(dealt: DataFrame, base: DataFrame, keys: list[Column]) -> DataFrame:
    """Fits dealt to several tasks per core, however few their bytes: they are bound by computing."""
    tasks = max(4 * base.sparkSession.sparkContext.defaultParallelism, base.count() // LOCAL_ROWS)
    return dealt.repartition(tasks, *keys)


def _attach(rows: DataFrame, packed: DataFrame, by: list[str]) -> DataFrame:
    """The folds of each row's experiment, null keys included."""
    if not by:
        return rows.crossJoin(F.broadcast(packed))  # one row
    # A text per experiment makes a missing part of a key equal to another.
    key = F.to_json(F.struct(*[col(k) for k in by]))
    return lookup_join(rows.withColumn("_key", key), packed.select(key.alias("_key"), "_left"), ["_key"], "inner").drop("_key")


# Experiments of any size

class _Steps:
    """Fits that go in step: each asks for sums in its own thread, and all that wait are answered by one job."""

    def __init__(self, fits: int, answer: Callable[[dict[int, object]], dict[int, object]]) -> None:
        self.lock, self.alive, self.asked, self.answers = threading.Condition(), fits, {}, {}
        self.answer, self.failed = answer, None

    def ask(self, fit: int, request: object):
        with self.lock:
            self.asked[fit] = request
            self.lock.notify_all()
            self.lock.wait_for(lambda: fit in self.answers or self.failed is not None)
            if self.failed is not None:
                raise RuntimeError("a step of another fit failed") from self.failed
            return self.answers.pop(fit)

    def leave(self) -> None:
        with self.lock:
            self.alive -= 1
            self.lock.notify_all()

    def run(self) -> None:
        """Answer until all fits have left."""
        while True:
            with self.lock:
                self.lock.wait_for(lambda: len(self.asked) == self.alive)
                if not self.alive:
                    return
                requests, self.asked = self.asked, {}
            try:
                found = self.answer(requests)
            except Exception as problem:
                with self.lock:
                    self.failed = problem
                    self.lock.notify_all()
                raise
            with self.lock:
                self.answers.update(found)
                self.lock.notify_all()


def _table_cuts(base: DataFrame, features: int) -> list[np.ndarray]:
    """Cut points of a table of any size: between all values of a feature, or between quantiles of one with many."""
    long = base.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"f{j}").alias("v")) for j in range(features)])).alias("e")).select("e.*").where("v is not null")
    kinds = long.groupBy("j", "v").count().drop("count").checkpoint()
    many = {r["j"] for r in kinds.groupBy("j").count().where(F.col("count") > growing.CUTS + 1).collect()}
    few = kinds.where(~F.col("j").isin(*many)) if many else kinds
    cuts = [np.zeros(0)] * features
    for r in few.groupBy("j").agg(F.array_sort(F.collect_set("v")).alias("v")).collect():
        cuts[r["j"]] = growing.cut_points(np.array(r["v"], float))
    if many:
        shares = [float(s) for s in np.linspace(0, 1, growing.CUTS + 1)]
        found = base.agg(*[F.percentile_approx(f"f{j}", shares, 100 * growing.CUTS).alias(f"f{j}") for j in sorted(many)]).first()
        for j in many:
            cuts[j] = growing.cut_points(np.array(found[f"f{j}"], float))
    return cuts


def _binner(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            x = pc.list_flatten(rows).to_numpy(zero_copy_only=False).reshape(len(rows), len(cuts)).astype(float)
            yield pa.array([b.tobytes() for b in growing.binned(x, cuts)], pa.binary())

    return arrow_udf(run, returnType="binary")


def _bins(column: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class _Fit:
    """One fit over a table: its target, style and left-out fold."""

    number: int
    target: int
    model: str
    style: Style
    left_out: int
    border: float = 0.0  # size of gradient from which rows stay, under sampling by gradient

    def known(self, block: _Block) -> np.ndarray:
        return (block.fold != self.left_out) & ~np.isnan(block.ys[:, self.target])

    def gradients(self, block: _Block, round_: int) -> tuple[np.ndarray, np.ndarray]:
        weight = self.known(block).astype(float)
        slope = np.where(weight > 0, block.margins[:, self.number] - np.nan_to_num(block.ys[:, self.target]), 0.0)
        if self.style.one_sided:
            top, other = self.style.one_sided
            drawn = growing.uniform(block.row_hash, round_) < other / (1 - top)
            weight = np.where(np.abs(slope) >= self.border, weight, np.where(drawn, weight * (1 - top) / other, 0.0))
        return slope * weight, weight


class _Block(NamedTuple):
    """Some rows of a table as arrays, and per row and fit the prediction so far. Blocks stay in the executors' memory between steps, as plain tuples."""

    bins: np.ndarray
    ys: np.ndarray
    fold: np.ndarray
    row_hash: np.ndarray
    margins: np.ndarray

    def moved(self, trees: dict[int, Tree]) -> _Block:
        """The block with one more tree of some fits added."""
        margins = self.margins.copy()
        for number, tree in trees.items():
            margins[:, number] += np.array(tree.value)[tree.leaf_of(self.bins)]
        return self._replace(margins=margins)


def _blocks(frame: DataFrame, features: int, starts: list[float]) -> RDD:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ys = np.array(batch["ys"].to_pylist(), float)
                block = _bins(batch["bins"], features), ys, batch["fold"].to_numpy(), batch["hash"].to_numpy().view(np.uint64), np.tile(np.array(starts), (len(ys), 1))
                yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(block)]})

    return frame.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r[0]))


class _State:
    """The blocks after each round: kept in memory, written down every `REWRITE` rounds so that a lost one is not made from the start."""

    def __init__(self, blocks: RDD) -> None:
        self.blocks, self.rounds, self.before, self.written = blocks.persist(StorageLevel.MEMORY_AND_DISK), 0, None, []

    def move(self, trees: dict[int, Tree]) -> None:
        self.before, self.blocks, self.rounds = self.blocks, self.blocks.map(lambda block: tuple(_Block(*block).moved(trees))).persist(StorageLevel.MEMORY_AND_DISK), self.rounds + 1
        if self.rounds % REWRITE == 0:
            self.blocks.checkpoint()

    def ask(self, spark: SparkSession, run: Callable[[Iterator[_Block]], list], merge: Callable[[list, list], list]) -> list:
        """What `run` makes of each task's blocks, merged; few answers meet on the driver, many in tasks before."""
        found = self.blocks.mapPartitions(lambda blocks: [run(_Block(*b) for b in blocks)])
        out = found.treeReduce(merge) if found.getNumPartitions() > DRIVER_ANSWERS else reduce(merge, found.collect())
        if self.before is not None:  # the job above has made the blocks anew
            self.before.unpersist()
            self.before = None
            if (path := self.blocks.getCheckpointFile()) is not None:
                delete_paths(spark, self.written)
                self.written = [path]
        return out

    def close(self, spark: SparkSession) -> None:
        self.blocks.unpersist()
        delete_paths(spark, self.written)


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b, strict=True)]


class _Table(growing.Summing):
    """The rows of a fit in a table: sums come from the job of its step."""

    def __init__(self, fit: _Fit, steps: _Steps, round_: int) -> None:
        self.fit, self.steps, self.round, self.tree = fit, steps, round_, Tree()

    def sums(self, nodes: list[int]) -> np.ndarray:
        return self.steps.ask(self.fit.number, (self.tree, nodes, self.round))

    def ahead(self, splits: list[tuple[int, int, int, bool, int]]) -> np.ndarray:
        tried = deepcopy(self.tree)
        nodes = [tried.split(node, feature, cut, missing_left)[child] for node, feature, cut, missing_left, child in splits]
        return self.steps.ask(self.fit.number, (tried, nodes, self.round))

    def split(self, node: int, feature: int, cut: int, missing_left: bool, left: int, right: int) -> None:
        self.tree.split(node, feature, cut, missing_left)


def _summed(spark: SparkSession, state: _State, features: int, fits: list[_Fit], requests: dict[int, tuple]) -> dict[int, np.ndarray]:
    """Sums of all nodes asked for, of all fits, in one job."""

    def run(blocks: Iterator[_Block]) -> list[np.ndarray]:
        cells = [np.zeros((len(nodes), features, BINS, 2)) for _, nodes, _ in requests.values()]
        for block in blocks:
            for out, (number, (tree, nodes, round_)) in zip(cells, requests.items(), strict=True):
                gradient, weight = fits[number].gradients(block, round_)
                place = np.full(len(tree.feature), -1)
                place[nodes] = np.arange(len(nodes))
                own = place[tree.leaf_of(block.bins)]
                which = np.flatnonzero((own >= 0) & (weight > 0))
                shift, gradient, weight = own[which] * BINS, gradient[which], weight[which]
                for j in range(features):
                    code = shift + block.bins[which, j]
                    out[:, j, :, 0] += np.bincount(code, gradient, len(nodes) * BINS).reshape(-1, BINS)
                    out[:, j, :, 1] += np.bincount(code, weight, len(nodes) * BINS).reshape(-1, BINS)
        return cells

    return dict(zip(requests, state.ask(spark, run, _added), strict=True))


def _with_margins(frame: DataFrame, features: int, starts: list[float], grown: dict[int, list[Tree]]) -> DataFrame:
    """The table with the predictions of all trees of each fit."""
    schema = frame.withColumn("margins", F.array(*[F.lit(s) for s in starts])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margin = _bins(batch["bins"], features), np.tile(np.array(starts), (batch.num_rows, 1))
            for number, trees in grown.items():
                for tree in trees:
                    margin[:, number] += np.array(tree.value)[tree.leaf_of(bins)]
            lists = pa.ListArray.from_arrays(np.arange(len(margin) + 1, dtype=np.int32) * margin.shape[1], margin.ravel())
            yield batch.append_column("margins", lists)

    return frame.mapInArrow(run, schema)


def _fit_table(base: DataFrame, features: int, targets: list[str], styles: dict[str, Style], folds: bool, local_rows: int) -> tuple[list[DataFrame], list[_Forest]]:
    """All fits of one experiment of any size; forests have trees only, and tell the rows' predictions when asked."""
    spark = base.sparkSession
    checkpointable(spark)
    cuts = _table_cuts(base, features)
    ys = F.transform("_targets", lambda t: F.coalesce(t["y"], F.lit(float("nan"))))
    binned = _binner(cuts)(F.array(*[f"f{j}" for j in range(features)]))
    path = scratch_path(spark, "tree-rows")
    # Few bytes, but each step goes through them: they are dealt over all cores.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(base.count() / BLOCK_ROWS))
    base.repartition(tasks).select("row", "hash", "fold", ys.alias("ys"), binned.alias("bins")).write.parquet(path)
    frame = spark.read.parquet(path)
    left = [FULL, *(sorted(r[0] for r in frame.select("fold").distinct().collect()) if folds else [])]
    boosted = {k: s for k, s in styles.items() if not s.bagged}
    found, forests = [], []
    if boosted:
        found += _boost_table(frame, features, targets, boosted, left, cuts)
    for kind, style in styles.items():
        if style.bagged:
            found += _forest_table(frame, features, targets, kind, style, left, cuts, local_rows)
            forests.append(_Forest(frame, features, targets, kind, left, cuts))
    return found, forests


def _boost_table(frame: DataFrame, features: int, targets: list[str], styles: dict[str, Style], left: list[int], cuts: list[np.ndarray]) -> list[DataFrame]:
    spark = frame.sparkSession
    fits = [_Fit(i, t, k, s, f) for i, (t, k, s, f) in enumerate((t, k, s, f) for t in range(len(targets)) for k, s in styles.items() for f in left)]
    mean = lambda f: F.avg(F.when((F.col("fold") != f.left_out) & ~F.isnan(F.col("ys")[f.target]), F.col("ys")[f.target]))
    starts = [r or 0.0 for r in frame.agg(*[mean(f).alias(f"s{f.number}") for f in fits]).first()]
    state = _State(_blocks(frame, features, starts))
    grown: dict[int, list[Tree]] = {f.number: [] for f in fits}
    rounds = max(s.trees for s in styles.values())
    for round_ in range(rounds):
        now = [f for f in fits if round_ < f.style.trees]
        sampled = [f for f in now if f.style.one_sided]
        for f, border in zip(sampled, _gradient_borders(spark, state, sampled), strict=True):
            f.border = border
        steps = _Steps(len(now), lambda requests: _summed(spark, state, features, fits, requests))
        fresh: dict[int, Tree] = {}

        def one(f: _Fit, steps=steps, fresh=fresh, round_=round_) -> None:
            try:
                fresh[f.number] = growing.grow(_Table(f, steps, round_), f.style)
            finally:
                steps.leave()

        threads = [threading.Thread(target=one, args=(f,)) for f in now]
        for t in threads:
            t.start()
        steps.run()
        for t in threads:
            t.join()
        for f in now:
            grown[f.number].append(fresh[f.number])
        state.move(fresh)
    state.close(spark)
    path = scratch_path(spark, "tree-margins")
    _with_margins(frame, features, starts, grown).write.parquet(path)
    final = spark.read.parquet(path)
    out = []
    for f in fits:
        asked = F.lit(True) if f.left_out == FULL else F.col("fold") == f.left_out
        y = F.col("ys")[f.target]
        rows = final.where(asked & ~F.isnan(y)).select(
            F.lit(targets[f.target]).alias("target"), F.lit(f.model).alias("model"), F.lit(f.left_out).alias("left_out"), "row", "fold", y.alias("y"), F.col("margins")[f.number].alias("yhat"))
        out.append(_with_nothing(rows, ["tree int", "piece int", "start double", *ARRAYS.split(", ")]))
        if f.left_out == FULL:
            columns = _tree_columns(grown[f.number], cuts, 1.0)
            n = len(grown[f.number])
            table = pa.table({"target": [targets[f.target]] * n, "model": [f.model] * n, "left_out": pa.array([FULL] * n, pa.int32()), "tree": pa.array(range(n), pa.int32()),
                              "piece": pa.array([ROOT] * n, pa.int32()), "start": [starts[f.number]] * n, **columns})
            out.append(_shaped(spark.createDataFrame(table), frame))
    return out


def _gradient_borders(spark: SparkSession, state: _State, fits: list[_Fit]) -> list[float]:
    """Per fit the gradient size that the wanted share of its rows reaches: exact, from samples whose ranks are known and the sizes between two of them."""
    if not fits:
        return []

    def sizes(blocks: Iterator[_Block]) -> list[np.ndarray]:
        held = [[] for _ in fits]
        for block in blocks:
            for own, f in zip(held, fits, strict=True):
                own.append(np.abs(block.margins[:, f.number] - block.ys[:, f.target])[f.known(block)])
        return [np.sort(np.concatenate([np.zeros(0), *own])) for own in held]

    def sample(blocks: Iterator[_Block]) -> list[list[tuple]]:
        steps = [(s, max(1, s.size // SAMPLED)) for s in sizes(blocks)]
        return [[(s.size, step, s[::step])] for s, step in steps]

    brackets = [_bracket(own, 1.0 - f.style.one_sided[0]) for own, f in zip(state.ask(spark, sample, _added_lists), fits, strict=True)]

    def inside(blocks: Iterator[_Block]) -> list[list[tuple]]:
        out = []
        for s, (_, low, high) in zip(sizes(blocks), brackets, strict=True):
            begin, end = np.searchsorted(s, [low, high], "right")
            out.append([(int(begin), *np.unique(s[begin:end], return_counts=True))])
        return out

    borders = []
    for own, (rank, _, _) in zip(state.ask(spark, inside, _added_lists), brackets, strict=True):
        values, counts = (np.concatenate([o[i] for o in own]) for i in (1, 2))
        order = np.argsort(values)
        ahead = sum(o[0] for o in own) + np.cumsum(counts[order])
        borders.append(float(values[order][np.searchsorted(ahead, rank, "right")]) if values.size else 0.0)
    return borders


def _added_lists(a: list[list], b: list[list]) -> list[list]:
    return [x + y for x, y in zip(a, b, strict=True)]


def _bracket(samples: list[tuple], share: float) -> tuple[int, float, float]:
    """The rank (from 0) that a share of all values has, a value below the one of that rank, and one that it does not exceed.

    Of each task there is every `step`-th of its sorted values.
    """
    rank = max(math.ceil(share * sum(n for n, _, _ in samples)) - 1, 0)
    values = np.unique(np.concatenate([s for _, _, s in samples]))
    least, most = np.zeros(values.size, np.int64), np.zeros(values.size, np.int64)  # how many of all values a value is not below
    for n, step, s in samples:
        found = np.searchsorted(s, values, "right")
        least += np.where(found > 0, (found - 1) * step + 1, 0)
        most += np.minimum(found * step, n)
    below, above = np.flatnonzero(most <= rank), np.flatnonzero(least > rank)
    return rank, float(values[below[-1]]) if below.size else -math.inf, float(values[above[0]]) if above.size else math.inf


def _with_nothing(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select("*", *[F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in columns])


def _shaped(trees: DataFrame, frame: DataFrame) -> DataFrame:
    """Trees in the columns that predictions have too."""
    row = dict(frame.dtypes)["row"]
    nothing = {"row": row, "fold": "int", "y": "double", "yhat": "double"}
    full = trees.select("*", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    return full.select("target", "model", "left_out", "row", "fold", "y", "yhat", "tree", "piece", "start", *ARRAY_NAMES)


class _Forest(NamedTuple):
    """A forest over a table, and whose rows it predicts."""

    frame: DataFrame
    features: int
    targets: list[str]
    kind: str
    left: list[int]
    cuts: list[np.ndarray]

    def predictions(self, fits: DataFrame) -> DataFrame:
        """Of each row by the trees of all rows and those grown without its fold."""
        found, x = [], _numbers(self.cuts)(F.col("bins"))
        for t, target in enumerate(self.targets):
            y = F.col("ys")[t]
            for left_out in self.left:
                asked = ~F.isnan(y) if left_out == FULL else ~F.isnan(y) & (F.col("fold") == left_out)
                rows = self.frame.where(asked).select(F.lit(target).alias("target"), F.lit(self.kind).alias("model"), F.lit(left_out).alias("left_out"), "row", "fold", y.alias("y"), "bins")
                model = fits.where((F.col("target") == target) & (F.col("model") == self.kind) & (F.col("left_out") == left_out) & F.col("tree").isNotNull())
                found.append(_scored(rows, model, x, self.features, "yhat", MODEL_BYTES).drop("bins"))
        return reduce(DataFrame.unionByName, found)


def _numbers(cuts: list[np.ndarray]):
    """Numbers that lie in the bins: every split tells them apart as it does the bins."""
    of = [np.concatenate([own, np.full(BINS - own.size, np.inf)]) for own in cuts]
    for own in of:
        own[growing.MISSING] = np.nan

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            bins = _bins(rows, len(of))
            x = np.column_stack([own[bins[:, j]] for j, own in enumerate(of)]) if of else np.zeros((len(rows), 0))
            flat = pa.array(x.ravel(), mask=np.isnan(x.ravel()))
            yield pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(of), flat)

    return arrow_udf(run, returnType="array<double>")


def _forest_table(frame: DataFrame, features: int, targets: list[str], kind: str, style: Style, left: list[int], cuts: list[np.ndarray], local_rows: int) -> list[DataFrame]:
    """A forest's trees over a table: large nodes split by jobs, for all trees of a pass together; then one group per node that is left."""
    spark, out = frame.sparkSession, []
    count, most = frame.count(), max(PIECE * local_rows, PIECE_ROWS if local_rows >= LOCAL_ROWS else 0)
    nodes = 2 * math.ceil(count / most) * 4
    per_pass = max(1, min(style.trees, MODEL_BYTES // 2 // (nodes * NODE_BYTES)))
    tasks = max(4 * spark.sparkContext.defaultParallelism, 4 * count * style.trees // most)
    for t, target in enumerate(targets):
        for fold in left:
            for begin in range(0, style.trees, per_pass):
                numbers = list(range(begin, min(begin + per_pass, style.trees)))
                tops, large = {n: Tree() for n in numbers}, {(n, 0) for n in numbers}
                level = 0
                while large and (style.depth is None or level < style.depth):
                    large = _split_large(frame, features, t, fold, style, tops, large, most)
                    level += 1
                pieces = frame.mapInArrow(_to_pieces(features, t, fold, style, tops), "tree int, piece int, rows int, block binary").repartition(tasks, "tree", "piece")
                grown = pieces.groupBy("tree", "piece").applyInArrow(_finished(features, target, kind, fold, style, cuts, tops, local_rows), f"target string, model string, left_out int, tree int, piece int, start double, {ARRAYS}")
                out.append(_shaped(grown, frame))
                columns = _tree_columns(list(tops.values()), cuts, 0.0)
                n = len(numbers)
                table = pa.table({"target": [target] * n, "model": [kind] * n, "left_out": pa.array([fold] * n, pa.int32()), "tree": pa.array(numbers, pa.int32()),
                                  "piece": pa.array([ROOT] * n, pa.int32()), "start": [0.0] * n, **columns})
                out.append(_shaped(spark.createDataFrame(table), frame))
    return out


def _drawn(batch: pa.RecordBatch, target: int, left_out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    y = np.array(batch["ys"].to_pylist(), float)[:, target] if batch.num_rows else np.zeros(0)
    fold = batch["fold"].to_numpy()
    return y, fold, ((fold != left_out) & ~np.isnan(y)).astype(float), batch["hash"].to_numpy().view(np.uint64)


def _best_split(sums: np.ndarray, style: Style) -> tuple[tuple[int, int, bool], float, float, np.ndarray]:
    """Feature, cut and side of missing values of a node's best split; its gain, the weight to its left and the node's totals."""
    total = sums[0, 0].sum(0)
    sums[..., 0] -= sums[..., 1] * (total[0] / total[1])  # around the node's mean, against rounding
    found = growing.best_splits(sums, style)
    f, c, lost = int(found.feature[0]), int(found.cut[0]), bool(found.missing_left[0])
    left = sums[0, f, :c + 1, 1].sum() + lost * sums[0, f, growing.MISSING, 1] if found.gain[0] > 0 else 0.0
    return (f, c, lost), float(found.gain[0]), float(left), total


def _split_large(frame: DataFrame, features: int, target: int, left_out: int, style: Style, tops: dict[int, Tree], large: set[tuple[int, int]], local_rows: int) -> set[tuple[int, int]]:
    """Split the large nodes of all trees in one job, and return those of their children that are still large."""
    asked = {n: sorted(node for m, node in large if m == n) for n in tops}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {n: np.zeros((len(nodes) * features * BINS, 2)) for n, nodes in asked.items() if nodes}
        rows = {n: np.zeros(len(nodes), np.int64) for n, nodes in asked.items()}
        for batch in batches:
            bins = _bins(batch["bins"], features)
            y, _, weight, row_hash = _drawn(batch, target, left_out)
            for n, held in cells.items():
                own = weight * growing.resampled(row_hash, n) if style.resampled else weight
                place = np.full(len(tops[n].feature), -1)
                place[asked[n]] = np.arange(len(asked[n]))
                at = place[tops[n].leaf_of(bins)]
                which = np.flatnonzero((at >= 0) & (own > 0))
                rows[n] += np.bincount(at[which], minlength=len(asked[n]))
                for j in range(features):
                    code = (at[which] * features + j) * BINS + bins[which, j]
                    held[:, 0] -= np.bincount(code, own[which] * y[which], len(held))
                    held[:, 1] += np.bincount(code, own[which], len(held))
        for n, held in cells.items():
            held = held.reshape(len(asked[n]), -1)
            some = np.flatnonzero(held.any(1))
            yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(some.size, n), pa.int32()), "node": pa.array(np.array(asked[n])[some], pa.int32()), "sums": pa.array([_packed(held[i]) for i in some], pa.binary())})

    def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sums = sum(np.sort([_unpacked(b, np.float64, features * BINS * 2) for b in table["sums"].to_pylist()], axis=0))  # in one order, whichever task is the first
        (f, c, lost), gain, lighter, total = _best_split(sums.reshape(1, features, BINS, 2), style)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([key[1].as_py()], pa.int32()), "feature": pa.array([f], pa.int32()), "cut": pa.array([c], pa.int32()),
                         "missing_left": [lost], "gain": [gain], "left_weight": [lighter], "weight": [float(total[1])], "gradient": [float(total[0])]})

    found = frame.mapInArrow(run, "tree int, node int, sums binary").groupBy("tree", "node").applyInArrow(
        choose, "tree int, node int, feature int, cut int, missing_left boolean, gain double, left_weight double, weight double, gradient double").collect()
    still = set()
    for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
        tree = tops[r["tree"]]
        tree.weight[r["node"]], tree.value[r["node"]] = r["weight"], -r["gradient"] / r["weight"]
        if r["gain"] <= 0 or r["weight"] <= local_rows:
            continue
        pair = tree.split(r["node"], r["feature"], r["cut"], r["missing_left"])
        for child, weight in zip(pair, (r["left_weight"], r["weight"] - r["left_weight"]), strict=True):
            tree.weight[child] = weight
            if weight > local_rows:
                still.add((r["tree"], child))
    return still


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes before all second ones."""
    return pa.compress(np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(block: bytes, kind, count: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(block, count * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, count).T).view(kind).ravel()


def _joined_bytes(*parts: np.ndarray) -> bytes:
    """Some arrays as one text of bytes, each after its length."""
    return b"".join(len(b).to_bytes(4, "little") + b for b in map(_packed, parts))


def _split_bytes(block: bytes, *parts: tuple) -> list[np.ndarray]:
    out, at = [], 0
    for kind, count in parts:
        size = int.from_bytes(block[at:at + 4], "little")
        out.append(_unpacked(block[at + 4:at + 4 + size], kind, count))
        at += 4 + size
    return out


def _alike(codes: np.ndarray) -> list[np.ndarray]:
    """The places of each code."""
    order = np.argsort(codes, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if codes.size else []


def _to_pieces(features: int, target: int, left_out: int, style: Style, tops: dict[int, Tree]):
    """Per task the rows each tree is grown on, as bytes for the leaf of its top that they reach. Rows of the same bins and value become one of their summed weight."""

    def dealt(bins: np.ndarray, y: np.ndarray, row_hash: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = np.ascontiguousarray(np.column_stack([bins, y.reshape(-1, 1).view(np.uint8)]))
        _, first, place = np.unique(texts.view(f"V{texts.shape[1]}").ravel(), return_index=True, return_inverse=True)
        bins, y = bins[first], y[first]
        for n, top in tops.items():
            drawn = growing.resampled(row_hash, n) if style.resampled else np.ones(len(row_hash))
            weight = np.bincount(place, drawn, len(y))
            which = np.flatnonzero(weight > 0)
            piece = top.leaf_of(bins[which])
            held = [(int(piece[own[0]]), which[own]) for own in _alike(piece)]
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([n] * len(held), pa.int32()), "piece": pa.array([p for p, _ in held], pa.int32()), "rows": pa.array([w.size for _, w in held], pa.int32()),
                "block": pa.array([_joined_bytes(bins[w].ravel("F"), y[w], weight[w].astype(np.uint32)) for _, w in held], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            y, _, weight, row_hash = _drawn(batch, target, left_out)
            own = weight > 0
            held.append((_bins(batch["bins"], features)[own], y[own], row_hash[own]))
            count += int(own.sum())
            if count >= BLOCK_ROWS:
                yield from dealt(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, count = [], 0
        if count:
            yield from dealt(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return run


def _grown(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, style: Style, depth: int | None, local_rows: int) -> Tree:
    """A piece grown whole: nodes beyond `local_rows` as by the jobs, then the rest."""
    columns, slope = [np.ascontiguousarray(bins[:, j]) for j in range(bins.shape[1])], weight * y
    top, open_, parts = Tree(), [(0, np.arange(len(y)), 0)], []
    while open_:
        node, own, level = open_.pop()
        pair, own_weight = None, weight[own]
        if own_weight.sum() > local_rows and (depth is None or level < depth):
            sums, own_slope = np.zeros((1, len(columns), BINS, 2)), slope[own]
            for j, column in enumerate(columns):
                codes = column[own].astype(np.intp)
                sums[0, j, :, 0] = -np.bincount(codes, own_slope, BINS)
                sums[0, j, :, 1] = np.bincount(codes, own_weight, BINS)
            split, gain, _, total = _best_split(sums, style)
            top.weight[node], top.value[node] = float(total[1]), float(-total[0] / total[1])
            if gain > 0:
                pair = top.split(node, *split)
        if pair is None:
            parts.append((node, _flat(growing.grow_full(bins[own], y[own], own_weight, None if depth is None else depth - level))))
            continue
        mine = columns[split[0]][own]
        goes_left = np.where(mine == growing.MISSING, split[2], mine <= split[1])
        open_ += [(pair[0], own[goes_left], level + 1), (pair[1], own[~goes_left], level + 1)]
    out = {name: [own] for name, own in _flat(top).items()}
    shift = len(top.feature) - 1
    for node, part in parts:
        # The part's root takes the leaf's place, its other nodes follow.
        for name, own in part.items():
            if name in ("left", "right"):
                own = np.where(own >= 0, own + shift, -1)
            out[name][0][node] = own[0]
            out[name].append(own[1:].astype(NODE_KINDS[name]))
        shift += len(part["feature"]) - 1
    return Tree(**{name: np.concatenate(own) for name, own in out.items()})


def _flat(tree: Tree) -> dict[str, np.ndarray]:
    """A tree's nodes as arrays: lists of millions of nodes would take several times their memory."""
    return {name: np.array(getattr(tree, name), kind) for name, kind in NODE_KINDS.items()}


def _finished(features: int, target: str, kind: str, left_out: int, style: Style, cuts: list[np.ndarray], tops: dict[int, Tree], local_rows: int):
    """All of a tree below one leaf of its top."""
    depths = {n: _depths(t) for n, t in tops.items()}

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number, piece = (k.as_py() for k in key)
        blocks = [_split_bytes(b, (np.uint8, n * features), (np.float64, n), (np.uint32, n)) for n, b in zip(table["rows"].to_pylist(), table["block"].to_pylist(), strict=True)]
        bins = np.concatenate([b.reshape(features, -1).T for b, _, _ in blocks])
        y, weight = (np.concatenate([b[i] for b in blocks]) for i in (1, 2))
        left = None if style.depth is None else style.depth - depths[number][piece]
        tree = _grown(bins, y, weight.astype(float), style, left, local_rows)
        return pa.table({"target": [target], "model": [kind], "left_out": pa.array([left_out], pa.int32()), "tree": pa.array([number], pa.int32()), "piece": pa.array([piece], pa.int32()),
                         "start": [0.0], **_tree_columns([tree], cuts, 1.0 / style.trees)})

    return finish


def _depths(tree: Tree) -> list[int]:
    depth = [0] * len(tree.feature)
    for node, (left, right) in enumerate(zip(tree.left, tree.right, strict=True)):
        if left >= 0:
            depth[left] = depth[right] = depth[node] + 1
    return depth


# Scoring

@dataclass
class Nodes:
    """Trees as arrays over all nodes, with pieces put in their places."""

    feature: np.ndarray
    at: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    roots: np.ndarray
    start: float

    def leaf_of(self, x: np.ndarray, root: int) -> np.ndarray:
        node = np.full(len(x), root)
        moving = np.flatnonzero(self.feature[node] >= 0)
        while moving.size:
            at = node[moving]
            own = x[moving, self.feature[at]]
            goes_left = np.where(np.isnan(own), self.missing_left[at], own <= self.at[at])
            node[moving] = np.where(goes_left, self.left[at], self.right[at])
            moving = moving[self.feature[node[moving]] >= 0]
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for root in self.roots.tolist():
            total += self.value[self.leaf_of(x, root)]
        return total


def joined_nodes(table: pa.Table) -> Nodes:
    """The arrays of a model's rows, in the order of its trees. A piece takes the place of the leaf it was grown at."""
    table = table.sort_by([("tree", "ascending"), ("piece", "ascending")])
    flat = {c: pc.list_flatten(table[c]).to_numpy() for c in ARRAY_NAMES}
    size = pc.list_value_length(table["feature"]).to_numpy()
    begin = np.cumsum(size) - size
    shift = np.repeat(begin, size)
    left, right = (np.where(flat[c] >= 0, flat[c] + shift, -1) for c in ("left", "right"))
    tree, piece = table["tree"].to_numpy(), table["piece"].to_numpy()
    root = {int(t): int(b) for t, p, b in zip(tree, piece, begin, strict=True) if p == ROOT}
    goes = np.arange(shift.size)
    for t, p, b in zip(tree.tolist(), piece.tolist(), begin.tolist(), strict=True):
        if p != ROOT:
            goes[(root[t] if t in root else 0) + p] = b
    left, right = (np.where(c >= 0, goes[c], -1) for c in (left, right))
    roots = np.array([goes[root[t]] for t in sorted(root)], np.int64)
    return Nodes(flat["feature"], np.nan_to_num(flat["at"].astype(float), posinf=np.inf), flat["missing_left"].astype(bool), left, right, flat["value"], flat["weight"], roots,
                 float(table["start"][0].as_py()) if table.num_rows else 0.0)


def _vectors(features: Sequence[str]) -> Column:
    return F.array(*[F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in features])


def cell_tables(table: pa.Table) -> dict[str, pa.Table]:
    """The rows of each cell of a bucket."""
    if not table.num_rows:
        return {}
    coded = table["_cell"].combine_chunks().dictionary_encode()
    place = coded.indices.to_numpy()
    order = np.argsort(place, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], np.diff(place[order]) > 0)))
    rows = table.take(pa.array(order)).combine_chunks()
    cells = coded.dictionary.to_pylist()
    return {cells[place[order[b]]]: rows.slice(b, e - b) for b, e in zip(begins.tolist(), [*begins[1:].tolist(), table.num_rows], strict=True)}


def _as_matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), width).astype(float)


def model_bytes(model: DataFrame) -> int:
    return int(model.agg(F.sum(F.size("feature"))).first()[0] or 0) * NODE_BYTES


def score_trees(df: DataFrame, model: DataFrame, features: Sequence[str], to: str = "yhat", limit: int = MODEL_BYTES) -> DataFrame:
    """All rows with the prediction of one model, given by its rows of the table of models.

    A model of up to `limit` bytes is copied to the executors and scoring is a projection. The trees of a larger one are cut to boxes of the features: each
    box gets its rows once and the nodes they may reach, in shares of up to that size, and the rows get the sum of what the shares say.
    """
    return _scored(df, model, _vectors(features), len(features), to, limit)


def _scored(df: DataFrame, model: DataFrame, x: Column, width: int, to: str, limit: int) -> DataFrame:
    if (size := model_bytes(model)) <= limit:
        shared = df.sparkSession.sparkContext.broadcast(joined_nodes(model.select("tree", "piece", "start", *ARRAY_NAMES).toArrow()))

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for rows in batches:
                yield pa.array(shared.value.predict(_as_matrix(rows, width)))

        return df.withColumn(to, arrow_udf(run, returnType="double")(x))
    return _score_boxes(df, model, x, width, to, size, limit)


def tree_shares(model: DataFrame, limit: int) -> tuple[dict[int, int], int]:
    """Trees dealt to shares of about `limit` bytes, a single larger tree alone; sizes of trees, not nodes, reach the driver."""
    sizes = model.groupBy("tree").agg(F.sum(F.size("feature")).alias("n")).orderBy("tree").collect()
    share, held, number = {}, 0, 0
    for r in sizes:
        if held and held + r["n"] * NODE_BYTES > limit:
            number, held = number + 1, 0
        share[r["tree"]] = number
        held += r["n"] * NODE_BYTES
    return share, number + 1


def by_shares(df: DataFrame, model: DataFrame, features: Sequence[str], limit: int, schema: str, work: Callable[[np.ndarray, Nodes], dict[str, np.ndarray]], rows_each: int = LOCAL_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows, written down with a number `_row`, and per row and share of the model what `work` finds for them."""
    spark, width = df.sparkSession, len(features)
    path = scratch_path(spark, "tree-scored")
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    slices, tasks = max(1, math.ceil(rows.count() / rows_each)), spark.sparkContext.defaultParallelism
    # Few rows meet more and smaller shares, so that every core has some.
    share, shares = tree_shares(model, min(limit, max(1, model_bytes(model) * slices // tasks)))
    number = F.create_map(*[F.lit(v).cast("int") for item in share.items() for v in item])
    held = model.select("tree", "piece", "start", *ARRAY_NAMES).withColumns({"share": F.try_element_at(number, F.col("tree")), "slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))})
    dealt = rows.select("_row", _vectors(features).alias("_x"), F.pmod(F.xxhash64("_row"), F.lit(slices)).cast("int").alias("slice"),
                        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))

    def meet(key: tuple[pa.Scalar, ...], own: pa.Table, trees: pa.Table) -> pa.Table:
        found = work(_as_matrix(own["_x"].combine_chunks(), width), joined_nodes(trees)) if own.num_rows else {}
        return pa.table({"_row": own["_row"], **found}) if own.num_rows else pa.Table.from_pylist([], pa.schema([]))

    found = dealt.groupBy("share", "slice").cogroup(held.groupBy("share", "slice")).applyInArrow(meet, f"_row bigint, {schema}")
    return rows, found


class _Boxes(NamedTuple):
    """Boxes that share out the space of the features, by a tree of borders. Known values of a box lie in (low, high]; missing ones belong to boxes without an upper border."""

    tree: Nodes
    low: np.ndarray
    high: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.tree.value[self.tree.leaf_of(x, 0)].astype(np.int64)


def _boxes(x: np.ndarray, most: int) -> _Boxes:
    """Boxes with at most so many of some rows, as far as these differ. Each is halved along the feature on which its rows have the most of all rows between them."""
    x = np.where(np.isnan(x), np.inf, x)
    width, ordered = x.shape[1], np.sort(x, axis=0)
    tree, borders, lows, highs = Tree(), [0.0], {0: np.full(width, -np.inf)}, {0: np.full(width, np.inf)}
    open_, leaves = [(0, np.arange(len(x)))], []
    while open_:
        node, own = open_.pop()
        least, top = (x[own].min(0), x[own].max(0)) if own.size else (np.zeros(width), np.zeros(width))
        spread = [np.searchsorted(ordered[:, j], top[j], "right") - np.searchsorted(ordered[:, j], least[j]) if least[j] < top[j] else 0 for j in range(width)]
        j = int(np.argmax(spread)) if width else 0
        if own.size <= most or not width or not spread[j]:
            leaves.append(node)
            continue
        values = np.sort(x[own, j])
        border = values[(values.size - 1) // 2]
        if border == values[-1]:
            border = values[np.searchsorted(values, border) - 1]
        if border == -np.inf:  # no known value can be told from it by a box that is open below
            leaves.append(node)
            continue
        left, right = tree.split(node, j, 0, False)
        borders += [0.0, 0.0]
        borders[node] = float(border)
        low, high = lows.pop(node), highs.pop(node)
        lows[left], highs[left], lows[right], highs[right] = low, high.copy(), low.copy(), high
        highs[left][j] = lows[right][j] = border
        goes_left = x[own, j] <= border
        open_ += [(left, own[goes_left]), (right, own[~goes_left])]
    number = np.zeros(len(borders))
    number[leaves] = np.arange(len(leaves))
    nodes = Nodes(np.array(tree.feature), np.array(borders), np.zeros(len(borders), bool), np.array(tree.left), np.array(tree.right), number, np.zeros(len(borders)), np.zeros(1, np.int64), 0.0)
    return _Boxes(nodes, np.array([lows[n] for n in leaves]).reshape(-1, width), np.array([highs[n] for n in leaves]).reshape(-1, width))


def _cut_to_boxes(nodes: Nodes, boxes: _Boxes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one tree the nodes that rows of each box tell apart: box, node and whether it is split there. Those of a box follow level by level, the sides of a split side by side."""
    box, node = np.arange(len(boxes.low)), np.zeros(len(boxes.low), np.int64)
    out = []
    while box.size:
        both = np.zeros(box.size, bool)
        moving = np.flatnonzero(nodes.feature[node] >= 0)
        while moving.size:
            at, own = node[moving], box[moving]
            feature = nodes.feature[at]
            open_above = np.isinf(boxes.high[own, feature])
            goes_left = (boxes.low[own, feature] < nodes.at[at]) | (open_above & nodes.missing_left[at])
            goes_right = (boxes.high[own, feature] > nodes.at[at]) | (open_above & ~nodes.missing_left[at])
            both[moving] = goes_left & goes_right
            one = ~both[moving]
            moving, at = moving[one], at[one]
            node[moving] = np.where(goes_left[one], nodes.left[at], nodes.right[at])
            moving = moving[nodes.feature[node[moving]] >= 0]
        out.append((box, node, both))
        box, node = np.repeat(box[both], 2), np.column_stack([nodes.left[node[both]], nodes.right[node[both]]]).ravel()
    box, node, both = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.argsort(box, kind="stable")
    return box[order], node[order], both[order]


def _below(nodes: Nodes, top: Nodes | None, leaf: int) -> Nodes:
    """A piece as a tree of its own: below the path to its leaf of the top, with nothing to the sides of that path."""
    path, at = [], leaf
    if top is not None:
        parent = np.full(len(top.feature), -1)
        for side in (top.left, top.right):
            parent[side[side >= 0]] = np.flatnonzero(side >= 0)
        while parent[at] >= 0:
            path.append((parent[at], top.left[parent[at]] == at))
            at = parent[at]
    path, n, size = path[::-1], len(path), len(nodes.feature)
    if not n:
        return nodes
    on, turns = np.array([p for p, _ in path]), np.array([left for _, left in path])
    follows, aside = np.arange(1, n + 1), np.arange(n + size, n + size + n)
    shifted = [np.where(c >= 0, c + n, -1) for c in (nodes.left, nodes.right)]
    none = np.full(n, -1)
    joined = lambda ahead, own, after: np.concatenate([ahead, own, after])
    return Nodes(joined(top.feature[on], nodes.feature, none), joined(top.at[on], nodes.at, np.zeros(n)), joined(top.missing_left[on], nodes.missing_left, np.zeros(n, bool)),
                 joined(np.where(turns, follows, aside), shifted[0], none), joined(np.where(turns, aside, follows), shifted[1], none),
                 joined(np.zeros(n), nodes.value, np.zeros(n)), joined(np.zeros(n), nodes.weight, np.zeros(n)), np.zeros(1, np.int64), 0.0)


def _nodes_of(batch: pa.RecordBatch, i: int) -> Nodes:
    flat = {c: batch[c][i].values for c in ARRAY_NAMES}
    own = {c: v.to_numpy(zero_copy_only=False) for c, v in flat.items()}
    return Nodes(own["feature"], np.nan_to_num(own["at"].astype(float), posinf=np.inf), own["missing_left"].astype(bool), own["left"], own["right"], own["value"], own["weight"], np.zeros(1, np.int64), 0.0)


def _box_pieces(boxes: _Boxes, tops: dict[int, Nodes], shares: np.ndarray | None, slices: np.ndarray | None):
    """The model's rows cut to the boxes: how many nodes each box gets or, once shares and slices are known, the nodes as bytes for each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, piece = batch["tree"][i].as_py(), batch["piece"][i].as_py()
                if piece == ROOT and tree in tops:
                    continue  # its leaves are those of the pieces
                nodes = _below(_nodes_of(batch, i), tops.get(tree), piece)
                box, node, both = _cut_to_boxes(nodes, boxes)
                sizes = np.bincount(box, minlength=len(boxes.low))
                if shares is None:
                    yield pa.RecordBatch.from_pydict({"box": pa.array(np.arange(sizes.size), pa.int32()), "nodes": pa.array(sizes, pa.int64())})
                    continue
                out, begin = [], np.cumsum(sizes) - sizes
                for b, size in enumerate(sizes.tolist()):
                    own, split = node[begin[b]:begin[b] + size], both[begin[b]:begin[b] + size]
                    if size == 1 and nodes.value[own[0]] == 0:
                        continue
                    inner = own[split]
                    block = _joined_bytes(np.where(split, nodes.feature[own], -1).astype(np.int16), nodes.at[inner], nodes.missing_left[inner].astype(np.uint8), nodes.value[own[~split]])
                    out += [(b, s, tree % int(shares[b]), 0, size, block) for s in range(slices[b])]
                yield _dealt_blocks(out)

    return run


def _dealt_blocks(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 5 else pa.int32()) for i, c in enumerate(columns)], ["box", "slice", "share", "rows", "nodes", "block"])


def _box_rows(boxes: _Boxes, width: int, shares: np.ndarray, slices: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, row = _as_matrix(batch["_x"], width), batch["_row"].to_numpy()
            box, out = boxes.of(x), []
            part = row % slices[box]
            for own in _alike(box * slices.max() + part):
                b, s = int(box[own[0]]), int(part[own[0]])
                block = _joined_bytes(row[own], x[own].ravel("F"))
                out += [(b, s, share, own.size, 0, block) for share in range(shares[b])]
            yield _dealt_blocks(out)

    return run


def _met_in_box(width: int):
    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows, parts, begin = [], [], 0
        for n, nodes, block in zip(table["rows"].to_pylist(), table["nodes"].to_pylist(), table["block"].to_pylist(), strict=True):
            if n:
                rows.append(_split_bytes(block, (np.int64, n), (np.float64, n * width)))
                continue
            inner = (nodes - 1) // 2
            feature, at, missing, value = _split_bytes(block, (np.int16, nodes), (np.float64, inner), (np.uint8, inner), (np.float64, nodes - inner))
            split = feature >= 0
            own = np.zeros(nodes), np.zeros(nodes, bool), np.full(nodes, -1), np.zeros(nodes)
            own[0][split], own[1][split], own[2][split], own[3][~split] = at, missing > 0, begin + 1 + 2 * np.arange(inner), value
            parts.append((feature.astype(np.int64), *own))
            begin += nodes
        if not rows:
            return pa.Table.from_pylist([], pa.schema([("_row", pa.int64()), ("value", pa.float64())]))
        row, x = np.concatenate([r for r, _ in rows]), np.concatenate([v.reshape(width, -1).T for _, v in rows])
        if not parts:
            return pa.table({"_row": row, "value": np.zeros(len(row))})
        roots = np.cumsum([0, *[len(p[0]) for p in parts[:-1]]])
        feature, at, missing, left, value = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table({"_row": row, "value": Nodes(feature, at, missing, left, np.where(left >= 0, left + 1, -1), value, np.zeros(0), roots, 0.0).predict(x)})

    return meet


def _score_boxes(df: DataFrame, model: DataFrame, x: Column, width: int, to: str, size: int, limit: int) -> DataFrame:
    spark, tasks = df.sparkSession, df.sparkSession.sparkContext.defaultParallelism
    start = float(model.agg(F.max("start")).first()[0])
    path = scratch_path(spark, "tree-scored")
    df.withColumn("_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    model = model.select("tree", "piece", *ARRAY_NAMES)
    topped = [r[0] for r in model.where(F.col("piece") != ROOT).select("tree").distinct().collect()]
    held = model.where((F.col("piece") == ROOT) & F.col("tree").isin(*topped)).toArrow() if topped else None
    tops = {t: _nodes_of(held, i) for i, t in enumerate(held["tree"].to_pylist())} if topped else {}
    count, vectors = rows.count(), rows.select("_row", x.alias("_x"))
    wanted = max(math.ceil(count / LOCAL_ROWS), math.ceil(2 * size / limit), tasks)
    sampled = vectors.select("_x").sample(min(1.0, BOX_ROWS / max(count, 1)), seed=1).limit(BOX_ROWS).toArrow()["_x"].combine_chunks()
    boxes = _boxes(_as_matrix(sampled, width), max(1, math.ceil(len(sampled) / wanted)))

    def numbered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for own in batches:
            yield pa.array(boxes.of(_as_matrix(own, width)), pa.int32())

    number = arrow_udf(numbered, returnType="int")
    rows_of, bytes_of = np.zeros(len(boxes.low)), np.zeros(len(boxes.low))
    for r in vectors.groupBy(number("_x").alias("box")).count().collect():
        rows_of[r["box"]] = r["count"]
    for r in model.mapInArrow(_box_pieces(boxes, tops, None, None), "box int, nodes bigint").groupBy("box").agg(F.sum("nodes").alias("n")).collect():
        bytes_of[r["box"]] = r["n"] * NODE_BYTES
    # Rows that no border tells apart are dealt in slices.
    slices, shares = np.maximum(np.ceil(rows_of / (2 * LOCAL_ROWS)), 1).astype(int), np.maximum(np.ceil(bytes_of / limit), 1).astype(int)
    schema = "box int, slice int, share int, rows int, nodes int, block binary"
    dealt = vectors.mapInArrow(_box_rows(boxes, width, shares, slices), schema).union(model.mapInArrow(_box_pieces(boxes, tops, shares, slices), schema))
    keys = ["box", "slice", "share"]
    found = dealt.repartition(max(4 * tasks, int((slices * shares).sum())), *keys).groupBy(*keys).applyInArrow(_met_in_box(width), "_row bigint, value double")
    total = found.groupBy("_row").agg((F.sum("value") + F.lit(start)).alias("_total"))
    return rows.drop(to).join(total, "_row").withColumnRenamed("_total", to).drop("_row")


def met_by_experiment(library: DataFrame, models: DataFrame, features: Sequence[str], keep: Sequence[str], by: Sequence[str], parts: Sequence[str],
                      work: Callable[[np.ndarray, pa.Table], np.ndarray], rows_each: int = LOCAL_ROWS, bucket_rows: int = 0) -> DataFrame:
    """Rows with what `work` makes of the models of their experiment, long: by, keep, target, model, prediction. Rows without a model are left out.

    An experiment's rows are dealt in slices, and its models, of which `parts` are the columns, go to each of them. With `bucket_rows`, slices of small
    models are dealt to groups of about so many rows; otherwise each is a group.
    """
    by, keep, width = list(by), list(keep), len(features)
    kinds = dict(library.dtypes)
    names = list(dict.fromkeys([*by, *keep]))
    vectors = library.select(*[col(c) for c in names], _vectors(features).alias("_x"))
    if by:
        key = F.to_json(F.struct(*[col(k) for k in by]))
        sizes = library.groupBy(*[col(k) for k in by]).count().select(key.alias("_key"), F.ceil(F.col("count") / rows_each).cast("int").alias("_slices"))
        rows, held = (lookup_join(df.withColumn("_key", key), sizes, ["_key"], "inner") for df in (vectors, models))
    else:
        slices = max(1, math.ceil(library.count() / rows_each))
        rows, held = (df.withColumns({"_key": F.lit(""), "_slices": F.lit(slices)}) for df in (vectors, models))
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(*[col(c) for c in names], "_x"), F.col("_slices")).cast("int"))
    held = held.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    held = held.select(F.col("_key").alias("_owner"), F.col("_slice").alias("_part"), "target", "model", *parts)

    def score(group: tuple[pa.Scalar, ...], own: pa.Table, held: pa.Table) -> pa.Table:
        out = told(own, held)
        return pa.concat_tables(out) if out else pa.Table.from_pylist([], pa.schema([]))

    def told(own: pa.Table, held: pa.Table) -> list[pa.Table]:
        out = []
        if own.num_rows and held.num_rows:
            x = _as_matrix(own["_x"].combine_chunks(), width)
            for target, model in sorted({(r["target"], r["model"]) for r in held.select(["target", "model"]).to_pylist()}):
                mine = held.filter(pc.and_(pc.equal(held["target"], target), pc.equal(held["model"], model)))
                values = work(x, mine)
                out.append(pa.table({**{c: own[c] for c in names}, "target": [target] * len(x), "model": [model] * len(x), "prediction": pa.array(values, mask=np.isnan(values))}))
        return out

    def score_all(group: tuple[pa.Scalar, ...], own: pa.Table, held: pa.Table) -> pa.Table:
        models_of = cell_tables(held)
        out = [t for cell, rows_of in cell_tables(own).items() if cell in models_of for t in told(rows_of, models_of[cell])]
        return pa.concat_tables(out).combine_chunks() if out else pa.Table.from_pylist([], pa.schema([]))

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in names], "target string, model string, prediction double"])
    if bucket_rows:
        tasks = max(4 * rows.sparkSession.sparkContext.defaultParallelism, library.count() // bucket_rows)
        left, right = kernels.bucketed(rows, ["_key", "_slice"], tasks), kernels.bucketed(held.withColumnsRenamed({"_owner": "_key", "_part": "_slice"}), ["_key", "_slice"], tasks)
        right = right.select(*[F.col(c).alias(c) for c in right.columns])
        return left.groupBy("_bucket").cogroup(right.groupBy("_bucket")).applyInArrow(score_all, schema)
    return rows.groupBy("_key", "_slice").cogroup(held.groupBy("_owner", "_part")).applyInArrow(score, schema)


def score_experiments(library: DataFrame, models: DataFrame, features: Sequence[str], keep: Sequence[str], by: Sequence[str], rows_each: int = LOCAL_ROWS) -> DataFrame:
    """Rows with the predictions of all tree models of their experiment, long form. Rows without a model are left out."""
    return met_by_experiment(library, models, features, keep, by, ["tree", "piece", "start", *ARRAY_NAMES], lambda x, trees: joined_nodes(trees).predict(x), rows_each)
