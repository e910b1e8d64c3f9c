"""Joins and quantiles whose cost stays bounded when one key or one value holds much of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.functions.exprs import col

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1 / 400
SALT = "_salt"


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(0)
    for field in df.schema.fields:
        c = col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + (F.coalesce(F.size(c), F.lit(0)) * 8 if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType)
                             else F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            total = total + 8
    return total


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether a frame is small enough to copy to every executor. Only two partial sums per task are exchanged."""
    measured = df.agg(F.count("*"), F.sum(_row_bytes(df))).first()
    return measured[0] <= max_rows and (measured[1] or 0) <= max_bytes


def hot_hashes(df: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """Hashes of keys that hold more than HOT_SHARE of the rows, and into how many parts each is to be split.

    One mergeable sketch per task; there are fewer than 1 / HOT_SHARE such keys whatever the data.
    """
    sketch = df.select(F.xxhash64(*[col(k) for k in keys]).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {int(1 / HOT_SHARE)}, {int(20 / HOT_SHARE)})").alias("top")
    ).first()
    share = sketch["n"] * HOT_SHARE
    return {t["item"]: math.ceil(t["count"] / share) for t in sketch["top"] or [] if t["count"] > share}


def salted(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column: left rows of a hot key are dealt over its parts, its right row is in every part."""
    parts = F.create_map(*[F.lit(v).cast("bigint") for item in hot.items() for v in item])
    count = F.coalesce(F.try_element_at(parts, F.xxhash64(*[col(k) for k in keys])), F.lit(1).cast("bigint"))
    dealt = left.withColumn(SALT, F.when(count > 1, F.pmod(F.monotonically_increasing_id(), count)).otherwise(0).cast("int"))
    repeated = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    return dealt, repeated


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a large left side to a right side that is unique on the keys.

    A right side measured to be small is copied to the executors. Otherwise both sides are shuffled on the keys and,
    for hot keys, a salt. The left side is read once; of the right side only the rows of hot keys multiply. A missing
    key counts as a key here, so that rows without one are spread too.
    """
    keys = list(keys)
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), keys, how)
    hot = hot_hashes(left, keys)
    if not hot:
        return left.join(right, keys, how)
    dealt, repeated = salted(left, right, keys, hot)
    return dealt.join(repeated, [*keys, SALT], how).drop(SALT)


class _Search:
    """One order statistic being narrowed: the 0-based rank lies strictly between two values."""

    def __init__(self, column: str, rank: int, rows: int):
        self.column, self.rank, self.rows = column, rank, rows
        self.low: float | None = None
        self.high: float | None = None
        self.below = 0
        self.inside = rows
        self.value: float | None = None

    def held(self) -> Column:
        c = col(self.column).cast("double")
        keep = c.isNotNull()
        if self.low is not None:
            keep = keep & (c > self.low)
        if self.high is not None:
            keep = keep & (c < self.high)
        return F.when(keep, c)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], buffer_rows: int = 100_000
) -> dict[str, list[float | None]]:
    """Exact quantiles (linear between neighbouring ranks) of many columns.

    Spark's own exact percentile keeps every distinct value of a column in one buffer. That is used only up to
    buffer_rows values, shared by all columns. Beyond, each rank is bracketed by an approximate sketch, counted, and narrowed until
    the bracket fits the buffer; hot values become bracket ends and are answered by their counts.
    """
    if not columns:
        return {}
    buffer_rows = max(buffer_rows // len(columns), 2)
    counts = df.agg(*[F.count(col(c)).alias(str(i)) for i, c in enumerate(columns)]).first()
    rows = {c: counts[str(i)] for i, c in enumerate(columns)}
    if max(rows.values()) <= buffer_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        found = df.agg(*[F.percentile(col(c).cast("double"), wanted).alias(str(i)) for i, c in enumerate(columns)]).first()
        return {c: list(found[str(i)]) if found[str(i)] else [None] * len(probs) for i, c in enumerate(columns)}

    spots = {c: [p * (rows[c] - 1) for p in probs] for c in columns if rows[c]}
    searches = {(c, r): _Search(c, r, rows[c]) for c, at in spots.items() for r in {math.floor(s) for s in at}}
    _narrow(df, list(searches.values()), buffer_rows)
    following = _next_values(df, [s for s in searches.values() if s.rank + 1 < s.rows])

    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = [None] * len(probs)
        for i, spot in enumerate(spots.get(c, [])):
            found = searches[c, math.floor(spot)]
            part = spot - found.rank
            out[c][i] = found.value if part == 0 else found.value + (following[c, found.rank] - found.value) * part
    return out


def _next_values(df: DataFrame, found: list[_Search]) -> dict[tuple[str, int], float]:
    """The value of the rank after each found one: the same value where it repeats, else the next larger."""
    if not found:
        return {}
    aggs = []
    for i, s in enumerate(found):
        c = col(s.column).cast("double")
        aggs += [F.count_if(c <= s.value).alias(f"n{i}"), F.min(F.when(c > s.value, c)).alias(f"v{i}")]
    row = df.agg(*aggs).first()
    return {(s.column, s.rank): s.value if row[f"n{i}"] > s.rank + 1 else row[f"v{i}"] for i, s in enumerate(found)}


def _narrow(df: DataFrame, searches: list[_Search], buffer_rows: int) -> None:
    accuracy = 10_000
    while open_ := [s for s in searches if s.value is None and s.inside > buffer_rows]:
        brackets = []
        for i, s in enumerate(open_):
            share = (s.rank - s.below + 0.5) / s.inside
            ends = [max(0.0, share - 2 / accuracy), min(1.0, share + 2 / accuracy)]
            brackets.append(F.percentile_approx(s.held(), ends, accuracy).alias(str(i)))
        ends = df.agg(*brackets).first()
        counts = []
        for i, s in enumerate(open_):
            c, (a, b) = col(s.column).cast("double"), ends[str(i)]
            counts += [
                F.count_if(c < a).alias(f"{i}_lt_a"), F.count_if(c <= a).alias(f"{i}_le_a"),
                F.count_if(c < b).alias(f"{i}_lt_b"), F.count_if(c <= b).alias(f"{i}_le_b"),
            ]
        seen = df.agg(*counts).first()
        for i, s in enumerate(open_):
            a, b = ends[str(i)]
            lt_a, le_a, lt_b, le_b = (seen[f"{i}_{k}"] for k in ("lt_a", "le_a", "lt_b", "le_b"))
            if s.rank < lt_a:
                s.high, s.inside = a, lt_a - s.below
            elif s.rank < le_a:
                s.value = a
            elif s.rank < lt_b:
                s.low, s.high, s.below, s.inside = a, b, le_a, lt_b - le_a
            elif s.rank < le_b:
                s.value = b
            else:
                s.inside -= le_b - s.below
                s.low, s.below = b, le_b
    last = [s for s in searches if s.value is None]
    if last:
        picks = [
            F.element_at(F.array_sort(F.collect_list(s.held())), s.rank - s.below + 1).alias(str(i))
            for i, s in enumerate(last)
        ]
        values = df.agg(*picks).first()
        for i, s in enumerate(last):
            s.value = values[str(i)]


def exact_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column, smallest on a tie. Values are counted before they are compared."""
    if not columns:
        return {}
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("value")) for i, c in enumerate(columns)
    ]))
    counted = df.select(entries.alias("e")).select("e.i", "e.value").where("value is not null").groupBy("i", "value").count()
    best = counted.groupBy("i").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value")).collect()
    found = {r["i"]: r["value"] for r in best}
    return {c: found.get(i) for i, c in enumerate(columns)}
