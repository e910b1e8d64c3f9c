"""Folds, metrics, and the choice of the best model per target."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, safe_ratio
from assaysieve.operators.skew import lookup_join

BUCKET_BITS = 12  # rows of an experiment are sorted in 2**BUCKET_BITS ranges of their hash


class ModelChoice(NamedTuple):
    asked: str
    fitted_as: str
    family: str


# What is fitted for each model name; every unknown name falls back to least squares.
MODEL_FAMILIES = {
    "Linear Regression": ("Linear Regression", "linear"),
    "Polynomial Regression": ("Polynomial Regression", "linear"),
    "Ridge": ("Ridge", "linear"),
    "Lasso": ("Lasso", "linear"),
    "Random Forest": ("random_forest", "trees"),
    "XGBoost": ("second_order", "trees"),
    "CatBoost": ("symmetric", "trees"),
    "LightGBM": ("leaf_wise", "trees"),
    "SVR": ("support_vectors", "vectors"),
    "Kernel Ridge": ("kernel_ridge", "kernel"),
    "Gaussian Process": ("gaussian_process", "kernel"),
}


def resolve_model(name: str, boosting: str | None = None) -> ModelChoice:
    """What a model name is fitted as. boosting="random_forest" is the choice made without a boosting package."""
    fitted, family = MODEL_FAMILIES.get(name, ("Linear Regression", "linear"))
    return ModelChoice(name, boosting if boosting and family == "trees" and fitted != "random_forest" else fitted, family)


def fold_count(strategy: str) -> int | None:
    """Number of folds of a validation strategy; None means leave one out, also for unknown names."""
    if strategy == "5-Fold CV":
        return 5
    return 10 if "10-Fold CV" in strategy else None


def hashed_fold(key: str | Column, folds: int, seed: int = 42) -> Column:
    """Fold number from a hash of the row key: reproducible, no sort and no shuffle."""
    return F.pmod(F.xxhash64(col(key), F.lit(seed)), F.lit(folds)).cast("int")


def number_rows(df: DataFrame, key: str, seed: int = 42, by: Sequence[str] = (), name: str = "number", total: str | None = None) -> DataFrame:
    """Shuffled row numbers from 0 within each experiment, in the order of the key's hash and then the key; `total` names their count.

    The range of hashes is cut into buckets. Counts of the buckets, which are combined before they are shuffled, say where each
    begins, and rows are sorted within a bucket only: an experiment of any size is numbered by many tasks.
    """
    hashed = F.xxhash64(col(key), F.lit(seed))
    # One text per experiment, so that a missing part of its key is a value like any other.
    group = F.to_json(F.struct(*[col(k) for k in by])) if by else F.lit("")
    bucketed = df.withColumns({"_group": group, "_bucket": F.shiftright(hashed, 64 - BUCKET_BITS).cast("int")})
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy("_group", "_bucket").count()
    begins = counts.select(
        "_group", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_begin"),
        *([F.sum("count").over(Window.partitionBy("_group")).alias(total)] if total else []),
    )
    inside = Window.partitionBy("_group", "_bucket").orderBy(F.xxhash64(col(key), F.lit(seed)), col(key))
    numbered = lookup_join(bucketed, begins, ["_group", "_bucket"], "inner").withColumn(name, F.col("_begin") + F.row_number().over(inside) - 1)
    return numbered.select(*[col(c) for c in df.columns if c not in (name, total)], name, *([total] if total else []))


def assign_folds(df: DataFrame, key: str, folds: int | None, seed: int = 42, by: Sequence[str] = (), name: str = "fold") -> DataFrame:
    """Shuffled folds whose sizes differ by at most one, the larger ones first, or one fold per row for leave-one-out."""
    if folds is None:
        return number_rows(df, key, seed, by, name).withColumn(name, F.col(name).cast("int"))
    numbered = number_rows(df, key, seed, by, "_number", "_total")
    whole, more = F.floor(F.col("_total") / folds), F.col("_total") % folds
    edge = more * (whole + 1)
    fold = F.when(F.col("_number") < edge, F.floor(F.col("_number") / (whole + 1))).otherwise(more + F.floor(safe_ratio(F.col("_number") - edge, whole)))
    return numbered.withColumn(name, fold.cast("int")).drop("_number", "_total")


def r_squared(y: Column, sse: Column) -> Column:
    """1 - SSE/SST; without variation in y it is 1 for a perfect fit and 0 otherwise."""
    sst = F.var_pop(y) * F.count(y)
    varied = F.max(y) > F.min(y)
    return F.when(varied, 1 - safe_ratio(sse, sst)).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))


def metrics(oof: DataFrame, by: Sequence[str] = (), keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """Train R2, and pooled out-of-fold R2, RMSE and MAE. A model without all its predictions gets NULL scores."""
    y, train, cv = F.col("y"), F.col("yhat_train"), F.col("yhat_cv")
    whole_train, whole_cv = F.count(train) == F.count(y), F.count(cv) == F.count(y)
    sse_train, sse = F.sum((y - train) * (y - train)), F.sum((y - cv) * (y - cv))
    return oof.groupBy(*[col(k) for k in [*by, *keys]]).agg(
        F.count(y).alias("n"),
        F.when(whole_train, r_squared(y, sse_train)).alias("train_r2"),
        F.when(whole_cv, r_squared(y, sse)).alias("cv_r2"),
        F.when(whole_cv, F.sqrt(safe_ratio(sse, F.count(y)))).alias("cv_rmse"),
        F.when(whole_cv, F.avg(F.abs(y - cv))).alias("cv_mae"),
        F.when(whole_train & whole_cv, "ok").otherwise("incomplete").alias("status"),
    )


def is_overfit(gap: float = 0.4, weak: float = 0.5) -> Column:
    train, cv = F.col("train_r2"), F.col("cv_r2")
    return F.coalesce(((train - cv) > gap) & (cv < weak), F.lit(False))


def model_rank(models: Sequence[str], model: str | Column = "model") -> Column:
    """Position of the model in the given order, last if absent."""
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), col(model))
    return F.when(rank > 0, rank).otherwise(len(models) + 1)


def best_models(scores: DataFrame, models: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per target the highest cross-validated R2 among models that are not overfit, else the highest of all.

    The first model in order wins a tie, and a model without a score never beats one with a score. The input has
    one row per target and model.
    """
    scored = scores.withColumns({"is_overfit": is_overfit(), "_order": model_rank(models)})
    window = Window.partitionBy(*[col(k) for k in [*by, "target"]]).orderBy(
        F.col("cv_r2").isNull().asc(), F.col("is_overfit").asc(), F.col("cv_r2").desc(), F.col("_order").asc()
    )
    return scored.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n", "_order")


def quality(score: str | Column = "cv_r2") -> Column:
    """Traffic-light class of a cross-validated R2."""
    return F.when(col(score) < 0.4, "red").when(col(score) < 0.7, "yellow").otherwise("green")
