"""Text features as numbers: for each row the mean target of the rows before it with the same text.

Rows are taken in an order that does not depend on the target, so that no row sees its own value. A running sum over all rows of a text would be one
task's work for a frequent text; the order is cut into ranges, whose sums are added up first, and only rows of one text and range are sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col
from assaysieve.operators.skew import lookup_join

RANGES = 4096
PRIOR_ROWS = 1.0  # rows that the overall mean counts for


def _group(column: str) -> Column:
    return F.to_json(F.struct(col(column).cast("string").alias("t")))  # a missing text is a text of its own


def ordered_statistics(df: DataFrame, columns: Sequence[str], target: str, key: str, order: Column | None = None, prior_rows: float = PRIOR_ROWS, ranges: int = RANGES) -> DataFrame:
    """The rows with a column `<column>_mean` for each text column: (sum of the target before + prior_rows * overall mean) / (rows before + prior_rows).

    `order` is a whole number, by default a hash of the key; equal numbers are ordered by the key, which is unique. Rows without a target value have a
    statistic but do not count for others. A missing text is a text of its own.
    """
    place = (F.xxhash64(col(key).cast("string")) if order is None else order).cast("bigint")
    rows = df.withColumns({"_place": place, "_y": col(target).cast("double")})
    low, high, mean = rows.agg(F.min("_place"), F.max("_place"), F.avg("_y")).first()
    if low is None:
        return df.withColumns({f"{c}_mean": F.lit(None).cast("double") for c in columns})
    width = max(1, -(-(high - low + 1) // ranges))
    # Division first: the distance of two hashes need not fit in 64 bits.
    rows = rows.withColumn("_range", (F.floor(F.col("_place") / F.lit(float(width)))).cast("bigint"))
    known, value = F.col("_y").isNotNull().cast("double"), F.coalesce("_y", F.lit(0.0))
    base = rows
    for c in columns:
        texted = rows.withColumn("_text", _group(c))
        # From the rows as they came: the sums need no statistic of an earlier column, whose joins and windows would be run once more for each column.
        sums = base.withColumn("_text", _group(c)).groupBy("_text", "_range").agg(F.sum(value).alias("_s"), F.sum(known).alias("_n"))
        before = Window.partitionBy("_text").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        begins = sums.select("_text", "_range", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0.0)).alias("_n"))
        inside = Window.partitionBy("_text", "_range").orderBy("_place", col(key)).rowsBetween(Window.unboundedPreceding, -1)
        joined = lookup_join(texted, begins, ["_text", "_range"], "inner")
        total = F.col("_s") + F.coalesce(F.sum(value).over(inside), F.lit(0.0))
        count = F.col("_n") + F.coalesce(F.sum(known).over(inside), F.lit(0.0))
        statistic = (total + F.lit(prior_rows * (mean or 0.0))) / (count + F.lit(prior_rows))
        rows = joined.withColumn(f"{c}_mean", statistic).drop("_text", "_s", "_n")
    return rows.drop("_place", "_y", "_range")


def final_statistics(df: DataFrame, column: str, target: str, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """Per text its statistic over all rows, for rows that were not trained on: `_text` and `<column>_mean`. A text that is not there has the overall mean."""
    mean = df.agg(F.avg(col(target).cast("double"))).first()[0] or 0.0
    y = col(target).cast("double")
    return df.groupBy(_group(column).alias("_text")).agg(
        ((F.coalesce(F.sum(y), F.lit(0.0)) + F.lit(prior_rows * mean)) / (F.count(y) + F.lit(prior_rows))).alias(f"{column}_mean"))


def apply_statistics(library: DataFrame, statistics: DataFrame, column: str, mean: float) -> DataFrame:
    """Library rows with the statistic of their text, or the overall mean where the text was not trained on."""
    joined = lookup_join(library.withColumn("_text", _group(column)), statistics, ["_text"], "left")
    return joined.withColumn(f"{column}_mean", F.coalesce(F.col(f"{column}_mean"), F.lit(mean))).drop("_text")
