"""Hard negatives: for an anchor and each of its positives, the rows of other labels that score next below the positive.

All rows are dealt to cells around split points, whose distance ranges to all cells are gathered once. Anchors visit the cells that their windows can reach; there a
tree of the same kind (`gnat`) is grown over a slice of the cell and searched. Each task returns the best rows it has for each window, and ranks are taken over these.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.llm import gnat
from assaysieve.llm.vectors import spread_out, step_matrix, steps
from assaysieve.session import scratch_path

POSITIVES, NEGATIVES = 5, 10
LEAST_SHARE, MOST_SHARE = 30, 90  # window of a negative's score, in hundredths of the positive's
CELL_ROWS = 4096  # rows for each split point
POINTS = 128  # split points at most; cells then grow, and are dealt in slices
POINT_SAMPLE = 2048  # rows from which the split points come, and which give the first thresholds
SLICE_ROWS = 32_768
BLOCK_ANCHORS = 16_384
LONGEST = float(1 << 55)  # squared length beyond which scores times 100 would not fit in 64 bits
NO_ID = (1 << 63) - 1
NEVER = -(1 << 62)


def _short_enough(size: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array((step_matrix(column, size).astype(np.float64) ** 2).sum(1) <= LONGEST)

    return arrow_udf(run, returnType="boolean")


def _cell_of(points: np.ndarray):
    size = points.shape[1]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = step_matrix(column, size).astype(np.float64)
            yield pa.array(gnat.distances(rows, points).argmin(1), pa.int32())

    return arrow_udf(run, returnType="int")


def _cell_ranges(points: np.ndarray):
    """Per task and cell: rows, shortest and longest squared length, and the least and largest distance to every split point."""
    size, count = points.shape[1], len(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(count, np.int64), None
        for batch in batches:
            rows, child = step_matrix(batch["x"], size).astype(np.float64), batch["cell"].to_numpy()
            new = gnat.ranges_of(points, rows, child, count, gnat.distances(rows, points))
            counts += np.bincount(child, minlength=count)
            total = new if total is None else _merged(total, new)
        held = np.flatnonzero(counts).tolist()
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array(held, pa.int32()), "n": counts[held],
            "ranges": pa.array([np.concatenate([[total.shortest[c], total.longest[c]], total.low[:, c], total.high[:, c]]).tobytes() for c in held], pa.binary())})

    return run


def _merged(a: gnat.Ranges, b: gnat.Ranges) -> gnat.Ranges:
    return gnat.Ranges(a.points, np.minimum(a.low, b.low), np.maximum(a.high, b.high), np.minimum(a.shortest, b.shortest), np.maximum(a.longest, b.longest))


def _one_cell(table: pa.Table) -> pa.Table:
    values = np.array([np.frombuffer(r, np.float64) for r in table["ranges"].to_pylist()])
    count = (values.shape[1] - 2) // 2
    low = np.concatenate([[0], np.arange(2, 2 + count)])
    merged = values.max(0)
    merged[low] = values[:, low].min(0)
    return pa.table({"cell": table["cell"].slice(0, 1), "n": [pc.sum(table["n"]).as_py()], "ranges": pa.array([merged.tobytes()], pa.binary())})


def _top_ranges(housed: DataFrame, points: np.ndarray) -> tuple[gnat.Ranges, list[int]]:
    """What is known of the cells, and their numbers of rows."""
    schema = "cell int, n bigint, ranges binary"
    found = housed.select("x", "cell").mapInArrow(_cell_ranges(points), schema).groupBy("cell").applyInArrow(_one_cell, schema).collect()
    count = len(points)
    low, high = np.full((count, count), np.inf), np.full((count, count), -np.inf)
    shortest, longest, rows = np.full(count, np.inf), np.full(count, -np.inf), [0] * count
    for r in found:
        values = np.frombuffer(r["ranges"], np.float64)
        shortest[r["cell"]], longest[r["cell"]] = values[:2]
        low[:, r["cell"]], high[:, r["cell"]], rows[r["cell"]] = values[2:2 + count], values[2 + count:], r["n"]
    return gnat.Ranges(points, low, high, shortest, longest), rows


def _codes(*labels: pa.ChunkedArray) -> list[np.ndarray]:
    """Equal numbers for equal labels, over all the columns."""
    joined = pa.chunked_array([c for column in labels for c in column.chunks], type=labels[0].type)
    numbers = pc.dictionary_encode(joined).combine_chunks().indices.to_numpy(zero_copy_only=False) if len(joined) else np.zeros(0, np.int32)
    return np.split(numbers, np.cumsum([len(c) for c in labels])[:-1])


def _visits(ranges: gnat.Ranges, sample: pa.Table, same: bool, wanted: int):
    """Of an anchor and its windows: the thresholds that the sample gives, and the cells its windows reach."""
    size = ranges.points.shape[1]

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known, known_ids = step_matrix(sample["x"], size), sample["vec_id"].to_numpy()
        for x, ids, label, least, most in batches:
            queries = step_matrix(x, size)
            mine, theirs = _codes(pa.chunked_array([label]), sample["label"])
            counts = pc.list_value_length(least).to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(queries)), counts)
            low, high = (pc.list_flatten(c).to_numpy(zero_copy_only=False).copy() for c in (least, most))
            for at in range(0, of.size, 1024):
                part = slice(at, at + 1024)
                table = gnat.scores(queries[of[part]], known)
                fits = (mine[of[part], None] == theirs) == same
                fits &= (ids.to_numpy()[of[part], None] != known_ids) & (table <= high[part, None])
                if len(known) >= wanted:
                    reached = np.partition(np.where(fits, table, NEVER), len(known) - wanted, axis=1)[:, len(known) - wanted]
                    low[part] = np.maximum(low[part], reached)
            cells = [set() for _ in range(len(queries))]
            for at in range(0, of.size, 1024):
                part = slice(at, at + 1024)
                open_ = ranges.open(queries[of[part]].astype(np.float64), low[part].astype(np.float64), high[part].astype(np.float64))
                for place, cell in zip(*np.nonzero(open_ & (low[part] <= high[part])[:, None]), strict=True):
                    cells[of[at + place]].add(int(cell))
            borders = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(borders, low), pa.array([sorted(c) for c in cells], pa.list_(pa.int32()))], ["least", "cells"])

    return arrow_udf(run, returnType="least array<bigint>, cells array<int>")


def _searcher(size: int, same: bool, wanted: int):
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("anchor")
        vectors, queries = step_matrix(rows["x"], size), step_matrix(asked["asked_x"], size)
        theirs, mine = _codes(rows["label"], asked["asked_label"])
        row, anchor = rows["row"].to_numpy(), asked["anchor"].to_numpy()
        ids = rows["vec_id"].to_numpy()
        counts = pc.list_value_length(asked["least"]).to_numpy()
        of = np.repeat(np.arange(len(queries)), counts)
        turn = np.arange(of.size) - np.repeat(np.cumsum(counts) - counts, counts)
        least, most = (pc.list_flatten(asked[c]).to_numpy() for c in ("least", "most"))
        if not len(vectors) or not of.size:
            window, score, place = (np.zeros(0, np.int64) for _ in range(3))
        else:
            def allowed(queries_at: np.ndarray, rows_at: np.ndarray) -> np.ndarray:
                equal = mine[queries_at, None] == theirs[rows_at]
                return equal & (anchor[queries_at, None] != row[rows_at]) if same else ~equal

            window, score, place = gnat.search(gnat.grow(vectors, np.arange(len(vectors))), vectors, ids, queries, of, least, most, wanted, allowed)
        return pa.table({"anchor": anchor[of[window]] if of.size else window, "turn": pa.array(turn[window] if of.size else window, pa.int32()), "score": score, "vec_id": ids[place]})

    return search


def _best(asked: DataFrame, housed: DataFrame, ranges: gnat.Ranges, cell_rows: list[int], sample: pa.Table, same: bool, wanted: int, slice_rows: int, block_anchors: int) -> DataFrame:
    """Per anchor and window (`turn`) the `wanted` best rows: anchor, turn, rank, score, vec_id. Anchors have `least` and `most` of their windows in arrays."""
    size = ranges.points.shape[1]
    blocks = max(1, math.ceil(asked.count() / block_anchors))
    slices = F.array(*[F.lit(max(1, math.ceil(n / slice_rows))) for n in cell_rows])
    visit = _visits(ranges, sample, same, wanted)(F.col("x"), F.col("vec_id"), F.col("label"), F.col("least"), F.col("most"))
    visiting = asked.withColumn("v", visit).select("anchor", F.col("label").alias("asked_label"), F.col("x").alias("asked_x"), F.col("v.least").alias("least"), "most", F.explode("v.cells").alias("cell"))
    visiting = visiting.withColumns({"slice": F.explode(F.sequence(F.lit(0), F.get(slices, F.col("cell")) - 1)), "block": F.pmod(F.xxhash64("anchor"), F.lit(blocks))})
    dealt = housed.select("row", "vec_id", "label", "x", "cell", F.pmod(F.xxhash64("row"), F.get(slices, F.col("cell"))).cast("int").alias("slice"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    keys = ["cell", "slice", "block"]
    found = dealt.groupBy(*keys).cogroup(visiting.groupBy(*keys)).applyInArrow(
        _searcher(size, same, wanted), "anchor bigint, turn int, score bigint, vec_id bigint")
    order = Window.partitionBy("anchor", "turn").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def mine(vectors: DataFrame, anchors: Column, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id", positives: int = POSITIVES, negatives: int = NEGATIVES,
         shares: tuple[int, int] = (LEAST_SHARE, MOST_SHARE), cell_rows: int = CELL_ROWS, sample: int = POINT_SAMPLE, slice_rows: int = SLICE_ROWS,
         block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of the whole numbers floor(256 * c); larger ones come first, of equal ones the smaller vec_id. An anchor's positives are its first
    `positives` other rows of the same label; their negatives the first `negatives` rows of other labels whose score lies within `shares` hundredths of the positive's.
    A positive with a negative score, or without rows in its window, gives no rows. `anchors` is a condition on the columns of the frame (null: no).

    Rows with a null label or vector, an empty vector or a null or non-finite entry take no part, nor such with another length than most rows (of equally common ones the longest
    counts) or a squared length beyond 2^55. Repeated rows are rows of their own, as anchors too. A null vec_id comes after all others. Vec_ids are whole numbers.
    """
    if min(shares) < 0:
        raise ValueError("shares must not be negative")
    spark = vectors.sparkSession
    plain = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    plain = plain.where("label is not null and size(vector) > 0")
    rows, size = plain.groupBy(F.size("vector").alias("size")).count().agg(F.sum("count"), F.max_by("size", F.struct("count", "size"))).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not rows:
        return spark.createDataFrame([], schema)

    def usable(frame: DataFrame) -> DataFrame:
        x = frame.select(F.coalesce("id", F.lit(NO_ID)).alias("vec_id"), "label", "asks", steps(F.col("vector")).alias("s"))
        x = x.where(F.col("s.size") == size).select("vec_id", "label", "asks", F.col("s.x").alias("x"))
        return x.where(_short_enough(size)(F.col("x")))

    some = usable(plain.orderBy(F.xxhash64("vector", "id")).limit(sample)).select("vec_id", "label", "x").toArrow()
    known = step_matrix(some["x"], size).astype(np.float64)
    places = spread_out(known, min(POINTS, math.ceil(rows / cell_rows)), 0.5)
    points = known[places] if places.size else np.zeros((1, size))
    path = scratch_path(spark, "negatives-rows")
    usable(plain).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "asks", "x", _cell_of(points)(F.col("x")).alias("cell")).write.parquet(path)
    housed = spark.read.parquet(path)
    ranges, counts = _top_ranges(housed, points)
    anchored = housed.where("asks").select(F.col("row").alias("anchor"), "vec_id", "label", "x")
    everything = F.array(F.lit(NEVER).cast("bigint")), F.array(F.lit(-NEVER).cast("bigint"))
    asked = anchored.withColumns({"least": everything[0], "most": everything[1]})
    first = _best(asked, housed, ranges, counts, some, True, positives, slice_rows, block_anchors)
    path = scratch_path(spark, "negatives-positives")
    first.where("score >= 0").select("anchor", (F.col("rank") - 1).alias("turn"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(path)
    first = spark.read.parquet(path)
    low, high = F.expr(f"({shares[0]} * positive_score + 99) div 100"), F.expr(f"({shares[1]} * positive_score) div 100")
    windows = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("turn", low.alias("least"), high.alias("most")))).alias("w"))
    asked = anchored.join(windows, "anchor").select("anchor", "vec_id", "label", "x", F.col("w.least").alias("least"), F.col("w.most").alias("most"))
    found = _best(asked, housed, ranges, counts, some, False, negatives, slice_rows, block_anchors)
    named = found.withColumnRenamed("vec_id", "negative_id").join(first, ["anchor", "turn"]).join(anchored.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    known_id = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return named.select(known_id("anchor_id"), known_id("positive_id"), "rank", known_id("negative_id"), "positive_score", F.col("score").alias("negative_score"))
