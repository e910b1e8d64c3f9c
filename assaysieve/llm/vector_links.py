"""Near copies of embeddings: pairs of one label with a large cosine, by products of int8 tiles with error bounds.

Equal vectors become one node with a number of copies. A label's nodes lie in cells around pivots. A node also visits a later cell if it is within
the linking distance of the plane between the two pivots, so that every link is met in exactly one cell. There, tiles of int8 codes
are multiplied; a pair whose product plus both vectors' quantisation errors cannot reach the threshold is done, all others are multiplied in double precision.
A task returns one row per node, never its pairs.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from assaysieve.llm.components import components
from assaysieve.llm.trie import Linked
from assaysieve.llm.vectors import double_bytes, float_bytes, matrix, spread_out
from assaysieve.operators.skew import SALT, hot_hashes, lookup_join, salted
from assaysieve.session import scratch_path

THRESHOLD = 0.93
CELL_ROWS = 4096  # nodes of a label for each of its pivots
PACKS = 8  # places for every so many rows that small labels share
PIVOTS = 1024  # pivots of a label at most; cells beyond SLICE_ROWS are dealt in slices
PIVOT_SAMPLE = 8192  # nodes from which the pivots are chosen; any choice gives the same links
SLICE_ROWS = 32_768
TILE = 2048
EXACT_TERMS = (1 << 24) // (127 * 127)  # products of int8 codes whose sum float32 holds exactly
SLACK = 1e-6  # more than all rounding of the bounds


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, the step of each vector, and the exact length of what rounding took from it."""
    step = np.abs(units).max(1, initial=0) / 127
    codes = np.rint(units / step[:, None])
    error = np.sqrt(((units - codes * step[:, None]) ** 2).sum(1))
    return codes.astype(np.int8), step, error


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 codes."""
    total: np.ndarray | None = None
    for at in range(0, a.shape[1], EXACT_TERMS):
        part = a[:, at:at + EXACT_TERMS].astype(np.float32) @ b[:, at:at + EXACT_TERMS].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def units_of(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length one, whatever their scale."""
    vectors = vectors.astype(np.float64, copy=False)
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit vectors have at least this product: int8 codes decide what cannot, double precision the rest."""
    (ca, sa, ea), (cb, sb, eb) = quantised(a), quantised(b)
    most = code_products(ca, cb) * sa[:, None].astype(np.float64) * sb + ea[:, None] * (1 + eb) + eb + SLACK
    maybe = most >= threshold
    rows, columns = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    found = np.zeros_like(maybe)
    if rows.size:
        pairs = np.nonzero(maybe)
        if pairs[0].size * 8 > rows.size * columns.size:
            found[np.ix_(rows, columns)] = a[rows] @ b[columns].T >= threshold
            found &= maybe
        else:
            for at in range(0, pairs[0].size, 1 << 16):
                i, j = pairs[0][at:at + (1 << 16)], pairs[1][at:at + (1 << 16)]
                found[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
    return found


def _connect(found: np.ndarray, first: np.ndarray, second: np.ndarray, linked: Linked) -> None:
    """Connect the rows and columns of a table of links; dense tables by one link per row and column first."""
    rows, columns = np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0))
    linked.add(first[rows], second[found[rows].argmax(1)])
    linked.add(first[found[:, columns].argmax(0)], second[columns])
    i, j = np.nonzero(found)
    linked.add(first[i], second[j])


def _cell_links(threshold: float, dtype: str):
    """Links of one cell, or of a pair of its slices: per node the linked rows and one node it is connected to."""

    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        one, two = key[1].as_py(), key[2].as_py()
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        home, sliced = table["home"].to_numpy(zero_copy_only=False), table["own_slice"].to_numpy()
        label = pc.dictionary_encode(table["label"].combine_chunks()).indices.to_numpy(zero_copy_only=False)
        size = pc.binary_length(table["vector"]).to_numpy()
        counts, linked = np.zeros(node.size, np.int64), Linked(node.size)
        order = np.lexsort((size, label))
        borders = np.flatnonzero((np.diff(label[order]) != 0) | (np.diff(size[order]) != 0)) + 1
        for places in np.split(order, borders):
            if places.size < 2:
                continue
            units = units_of(matrix(table["vector"].take(pa.array(places)), dtype))
            sets = {(s, h): np.flatnonzero((sliced[places] == s) & (home[places] == h)) for s in {one, two} for h in (True, False)}
            pairs = [((one, True), (two, True)), ((one, True), (two, False))] + ([((two, True), (one, False))] if one != two else [])
            for left, right in pairs:
                for a in range(0, sets[left].size, TILE):
                    i = sets[left][a:a + TILE]
                    for b in range(a if left == right else 0, sets[right].size, TILE):
                        j = sets[right][b:b + TILE]
                        found = linked_pairs(units[i], units[j], threshold)
                        if left == right and a == b:
                            np.fill_diagonal(found, False)
                        elif left == right or found.any():
                            np.add.at(counts, places[j], copies[places[i]] @ found)
                        if not found.any():
                            continue
                        np.add.at(counts, places[i], found @ copies[places[j]])
                        _connect(found, places[i], places[j], linked)
        met = np.flatnonzero((counts > 0) | (linked.label != np.arange(node.size)))
        return pa.table({"a": node[met], "b": node[linked.label[met]], "links": counts[met]})

    return links


def _homes(pivots: np.ndarray, threshold: float, dtype: str):
    """Of a vector and its label's number of pivots: the cell it lies in, and the later cells a link can lead to."""
    # Two unit vectors with this cosine are so far apart; a little more, for rounding.
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    apart = np.array([np.sqrt(((pivots - p) ** 2).sum(1)) for p in pivots])
    if len(pivots):
        np.fill_diagonal(apart, 1)
    numbers = np.arange(len(pivots))

    def homes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for vectors, counts in batches:
            count = counts.to_numpy(zero_copy_only=False)
            cells: list[list[int]] = [[0]] * len(count)
            fits = (count > 1) & (pc.binary_length(vectors).to_numpy(zero_copy_only=False) == pivots.shape[1] * np.dtype(dtype).itemsize)
            for places in np.array_split(np.flatnonzero(fits), 1 + fits.sum() // TILE):
                if not places.size:
                    continue
                near = units_of(matrix(vectors.take(pa.array(places)), dtype)) @ pivots.T
                near[numbers >= count[places][:, None]] = -np.inf
                own = near.argmax(1)
                margin = (near.max(1)[:, None] - near) / apart[own]
                visits = (margin <= reach) & (numbers > own[:, None])
                for place, at, later in zip(places.tolist(), own.tolist(), visits, strict=True):
                    cells[place] = [at, *np.flatnonzero(later).tolist()]
            yield pa.array(cells, pa.list_(pa.int32()))

    return arrow_udf(homes, returnType="array<int>")


def _chosen_pivots(nodes: DataFrame, size: int, count: int, sample: int, dtype: str) -> np.ndarray:
    """Up to `count` unit vectors far from each other, out of a sample of fixed size."""
    rows = nodes.where(F.octet_length("vector") == size).orderBy(F.xxhash64("vector"), "node").limit(sample).select("vector").toArrow()
    units = units_of(matrix(rows["vector"], dtype))
    return units[spread_out(units, count)]


def _members(nodes: DataFrame, threshold: float, cell_rows: int, sample: int, dtype: str) -> DataFrame:
    """Nodes in their own cell and as visitors of others. Small labels share places; a task tells them apart."""
    spark = nodes.sparkSession
    kinds = nodes.groupBy("label", F.octet_length("vector").alias("size")).agg(F.count("*").alias("rows")).checkpoint()
    total, largest, most = kinds.agg(F.sum("rows"), F.max("rows"), F.max_by("size", F.struct("rows", "size"))).first()
    packs = max(1, math.ceil((total or 0) / cell_rows * PACKS))
    kind = F.xxhash64("label", F.octet_length("vector"))
    shared = F.pmod(kind, F.lit(packs))
    if (largest or 0) <= cell_rows:
        return nodes.select("node", "copies", "label", "vector", F.lit(True).alias("home"), shared.alias("place"))
    pivots = _chosen_pivots(nodes, most, min(PIVOTS, math.ceil(largest / cell_rows)), sample, dtype)
    large = kinds.where(F.col("rows") > cell_rows).select(
        "label", "size", F.least(F.lit(PIVOTS), F.ceil(F.col("rows") / cell_rows)).cast("int").alias("pivots"))
    sized = lookup_join(nodes.withColumn("size", F.octet_length("vector")), large, ["label", "size"])
    cells = F.when(F.col("pivots").isNotNull(), _homes(pivots, threshold, dtype)(F.col("vector"), F.coalesce("pivots", F.lit(1))))
    path = scratch_path(spark, "vector-cells")
    sized.select("node", "copies", "label", "vector", cells.alias("cells")).write.parquet(path)
    housed = spark.read.parquet(path)  # so that counting members does not find their cells once more
    spread = housed.select("node", "copies", "label", "vector", F.col("cells").isNotNull().alias("large"),
                           F.posexplode(F.coalesce("cells", F.array(F.lit(0)))).alias("turn", "cell"))
    return spread.select("node", "copies", "label", "vector", (F.col("turn") == 0).alias("home"),
                         F.when(F.col("large"), F.xxhash64(kind, "cell")).otherwise(shared).alias("place"))


def _sliced(members: DataFrame, slice_rows: int) -> DataFrame:
    """Members of crowded places as pairs of slices, each a group of its own; of others as one group."""
    crowded = members.groupBy("place").count().where(F.col("count") > slice_rows).select(
        "place", F.ceil(F.col("count") / slice_rows).cast("int").alias("slices")).checkpoint()
    if crowded.isEmpty():
        return members.withColumns({"own_slice": F.lit(0), "one": F.lit(0), "two": F.lit(0)})
    slices = F.coalesce("slices", F.lit(1))
    dealt = lookup_join(members, crowded, ["place"]).withColumn("own_slice", F.pmod(F.xxhash64("node"), slices).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), slices - 1)))
    return dealt.withColumns({"one": F.least("own_slice", "with"), "two": F.greatest("own_slice", "with")}).drop("slices", "with")


def near_copies(vectors: DataFrame, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id", threshold: float = THRESHOLD,
                cell_rows: int = CELL_ROWS, slice_rows: int = SLICE_ROWS, sample: int = PIVOT_SAMPLE) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (the smallest vec_id reachable) and kept (whether that is its own).

    Rows link if their labels are equal and not null, their vectors as long, and the cosine in double precision is at least `threshold`, which is above 0. Vectors that are
    null, empty, all zero, or hold null or non-finite entries link with nothing: they are their own component. Repeated rows are rows: equal vectors link, equal ids alone
    do not. A null id is never the smallest while its component has others, and is never kept. Other columns of the frame take no part.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    spark = vectors.sparkSession
    single = vectors.select(F.col(vector)).schema[0].dataType.elementType == T.FloatType()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    held = F.when(F.col("label").isNotNull(), (float_bytes if single else double_bytes)(F.col("vector")))
    path, dtype = scratch_path(spark, "vector-rows"), "<f4" if single else "<f8"
    rows.select("vec_id", "label", held.alias("vector")).write.parquet(path)
    rows = spark.read.parquet(path)
    good = rows.where("vector is not null")
    path = scratch_path(spark, "vector-nodes")
    good.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()).write.parquet(path)
    nodes = spark.read.parquet(path)
    members = _sliced(_members(nodes, threshold, cell_rows, sample, dtype), slice_rows)
    links = members.groupBy("place", "one", "two").applyInArrow(_cell_links(threshold, dtype), "a bigint, b bigint, links bigint").checkpoint()
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = nodes.select("node", "first", "copies").join(counts, "node", "left").join(components(links.select("a", "b")), "node", "left").select(
        "node", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")).checkpoint()
    least = known.groupBy("component").agg(F.min("first").alias("component_id")).checkpoint()
    found = lookup_join(known, least, ["component"]).select("node", "n_links", "component_id")
    dealt, table = salted(good, nodes.select("label", "vector", "node").join(found, "node"), ["label", "vector"], hot_hashes(good, ["label", "vector"]))
    merged = dealt.join(table, ["label", "vector", SALT]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return merged.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def deduplicate(vectors: DataFrame, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id", threshold: float = THRESHOLD) -> DataFrame:
    """One vector of each component: the one of smallest id. Rows with a null id stay; of repeated ids every row of a kept one stays."""
    found = near_copies(vectors, vector, label, vec_id, threshold)
    gone = found.groupBy("vec_id").agg(F.max("kept").alias("any")).where("not any and vec_id is not null").select(F.col("vec_id").alias("_gone_id"))
    return vectors.join(gone, vectors[vec_id] == gone["_gone_id"], "left_anti")
