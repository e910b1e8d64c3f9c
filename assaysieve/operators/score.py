"""Intervals, measured values, the desirability score and the ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.functions.exprs import clip, col, half_even, lookup_key, row_geometric_mean, three_classes, unit_scale
from assaysieve.operators.roles import prediction_columns
from assaysieve.operators.skew import lookup_join
from assaysieve.session import scratch_path

Z95 = 1.96


def interval(prediction: Column, half_width: Column, target: str, bounds: tuple[float, float] | None = None) -> list[Column]:
    """Rounded output columns of one target: prediction and half-width, or bounded prediction with both limits."""
    if bounds is None:
        return [half_even(prediction, 1).alias(f"{target}_Prediction"), half_even(half_width, 1).alias(f"{target}_Uncertainty")]
    named = {"Prediction": prediction, "CI_Lower": prediction - half_width, "CI_Upper": prediction + half_width}
    return [half_even(clip(v, *bounds), 1).alias(f"{target}_{k}") for k, v in named.items()]


def constant_half_width(cv_rmse: float | None) -> Column:
    return F.lit(Z95) * F.lit(cv_rmse).cast("double")


def carried_feature(df: DataFrame, names: Sequence[str] = ("LogP", "XLogP")) -> Column:
    """The first of these columns the frame has, else 0."""
    return next((col(c) for c in names if c in df.columns), F.lit(0))


def classify(df: DataFrame, targets: Sequence[str], high: float = 50.0, low: float = 20.0) -> DataFrame:
    """Three-class compatibility, added only if every named target was predicted."""
    columns = [f"{t}_Prediction" for t in targets]
    if not set(columns) <= set(df.columns):
        return df
    return df.withColumn("Compatibility", three_classes([col(c) for c in columns], high, low))


def measured_values(
    experiment: DataFrame, targets: Sequence[str], row_id: str, name: str = "solvent_name", controls: str | None = "control"
) -> DataFrame:
    """Measured values per normalised name, wide; the last row wins when a name repeats.

    Control rows are left out whole, so that they override neither prediction nor uncertainty.
    """
    kept = experiment
    if controls:
        kept = kept.where(~F.coalesce(F.contains(F.lower(col(name)), F.lit(controls)), F.lit(False)))
    row = F.struct(*[col(t).cast("double").alias(f"m_{i}") for i, t in enumerate(targets)])
    return kept.groupBy(lookup_key(name).alias("name_key")).agg(F.max_by(row, col(row_id)).alias("_measured"))


def attach_measured(df: DataFrame, measured: DataFrame, targets: Sequence[str], name: str = "solvent_name") -> DataFrame:
    """Add the measured value of each target and whether the entity was measured, by normalised name."""
    joined = lookup_join(df.withColumn("name_key", lookup_key(name)), measured, ["name_key"])
    values = {_measured_name(i): F.col("_measured")[f"m_{i}"] for i in range(len(targets))}
    return joined.withColumns({"measured": F.col("_measured").isNotNull(), **values}).drop("name_key", "_measured")


def _measured_name(i: int) -> str:
    return f"_measured_{i}"


def measured_columns(targets: Sequence[str]) -> list[str]:
    return ["measured", *[_measured_name(i) for i in range(len(targets))]]


def use_measured(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Put attached measurements in place of predictions, with uncertainty 0."""
    changed = {}
    for i, t in enumerate(targets):
        value = col(_measured_name(i))
        if f"{t}_Prediction" in df.columns:
            changed[f"{t}_Prediction"] = F.coalesce(half_even(value, 1), col(f"{t}_Prediction"))
        if f"{t}_Uncertainty" in df.columns:
            changed[f"{t}_Uncertainty"] = F.when(value.isNotNull(), 0.0).otherwise(col(f"{t}_Uncertainty"))
    return df.withColumns(changed).drop(*measured_columns(targets)[1:])


def override_measured(df: DataFrame, measured: DataFrame, targets: Sequence[str], name: str = "solvent_name") -> DataFrame:
    """Replace predictions of measured entities by the measurement and set their uncertainty to 0."""
    return use_measured(attach_measured(df, measured, targets, name), targets)


def target_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Lowest and highest value per column, in one pass."""
    if not columns:
        return {}
    row = df.agg(*[f(col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("l", F.min), ("h", F.max))]).first()
    return {c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(columns)}


def desirability(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Overall score 0-100: geometric mean over targets of the min-max scaled predictions.

    A projection over the prediction columns, without a shuffle. Targets without given bounds use the range of
    their predictions; without any target the score is 0.
    """
    columns = prediction_columns(df)
    if not columns:
        return df.withColumn("score", F.lit(0.0))
    open_ = [c for c in columns if c.removesuffix("_Prediction") not in bounds]
    own = target_bounds(df, open_)
    scaled = [unit_scale(c, *(own[c] if c in own else bounds[c.removesuffix("_Prediction")])) for c in columns]
    return df.withColumn("score", half_even(row_geometric_mean(scaled) * 100, 1))


def top_ranked(df: DataFrame, k: int, entity: str = "solvent_name", score: str = "score") -> DataFrame:
    """The k best rows with their rank. Sorting keeps k rows per task; only k rows are numbered."""
    order = [col(score).desc_nulls_last(), col(entity)]
    return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rank_all(df: DataFrame, entity: str = "solvent_name", score: str = "score", written: list[str] | None = None) -> DataFrame:
    """Every row with its rank by score, ties by entity.

    The rows are written to the checkpoint folder once, so that whatever scores them runs once. The written rows are range-partitioned by
    (score, entity), sorted and written with their place, so that partitions are fixed; each partition's numbers start after the rows of the
    partitions before it. `written` collects the folders, for the caller to delete when the ranking is no longer needed.
    """
    order = [col(score).desc_nulls_last(), col(entity)]
    spark = df.sparkSession
    scored, path = scratch_path(spark, "scored"), scratch_path(spark, "ranked")
    df.write.parquet(scored)
    if written is not None:
        written += [scored, path]
    spark.read.schema(df.schema).parquet(scored).orderBy(*order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).write.parquet(path)
    places = [T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())]
    placed = spark.read.schema(T.StructType([*df.schema.fields, *places])).parquet(path)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"), F.min("_at").alias("_start"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", "_start", before.alias("_before"))  # a row per sorted partition
    numbered = placed.join(F.broadcast(offsets), "_part")
    rank = (F.col("_before") + F.col("_at") - F.col("_start") + 1).cast("bigint")
    return numbered.select(*[col(c) for c in df.columns], rank.alias("rank"))


def best_entity(df: DataFrame, entity: str = "solvent_name", score: str = "score") -> DataFrame:
    return df.orderBy(col(score).desc_nulls_last(), col(entity)).limit(1).select(col(entity), col(score))
