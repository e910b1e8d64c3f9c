"""Forests and boosted trees with Spark ML. The fits are distributed over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col
from assaysieve.session import checkpointable, scratch_path

# Forest size and seed.
TREES = 100
SEED = 42
MAX_BINS = 256  # split points that are tried per feature; a feature with more distinct values is cut at quantiles


def assemble(df: DataFrame, features: Sequence[str], to: str = "_features") -> DataFrame:
    """Rows with all features as one vector; rows with a gap are left out."""
    doubles = df.withColumns({f"_f{i}": col(c).cast("double") for i, c in enumerate(features)})
    names = [f"_f{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=names, outputCol=to, handleInvalid="skip").transform(doubles).drop(*names)


def estimator(kind: str, label: str = "y", **options):
    """A forest that considers every feature at each split, or gradient-boosted trees."""
    shared = {"featuresCol": "_features", "labelCol": label, "predictionCol": "yhat", "seed": SEED, "maxBins": MAX_BINS}
    if kind == "random_forest":
        settings = {"numTrees": TREES, "maxDepth": 30, "featureSubsetStrategy": "all", "maxMemoryInMB": 1024, "cacheNodeIds": True}
        return RandomForestRegressor(**{**shared, **settings, **options})
    if kind == "gbt":
        return GBTRegressor(**{**shared, "maxIter": TREES, "maxDepth": 6, "stepSize": 0.3, "checkpointInterval": 10, **options})
    raise ValueError(f"unknown tree model {kind!r}")


ROWS_PER_TASK = 1_000_000
PARALLEL_FITS = 4  # fits submitted at a time; each is itself distributed


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to at least one task per core and kept: tree fits are bound by computing, not by bytes."""
    checkpointable(df.sparkSession)  # where rounds of boosting cut their lineage
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism).persist()


def fit_tree(df: DataFrame, features: Sequence[str], target: str, kind: str, **options):
    rows = df.withColumn("y", col(target).cast("double")).where("y is not null")
    dealt = spread(assemble(rows, features).select("y", "_features"))
    try:
        return estimator(kind, **options).fit(dealt)
    finally:
        dealt.unpersist()


def score_tree(df: DataFrame, model, features: Sequence[str], to: str = "yhat") -> DataFrame:
    """All rows with their prediction, NULL where a feature is missing."""
    doubles = {f"_f{i}": col(c).cast("double") for i, c in enumerate(features)}
    whole = reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(f) for f in doubles])
    filled = df.withColumns(doubles).withColumn("_whole", whole).withColumns({f: F.when(F.col("_whole"), F.col(f)).otherwise(0.0) for f in doubles})
    vectors = VectorAssembler(inputCols=list(doubles), outputCol="_features").transform(filled)
    scored = model.transform(vectors).withColumn("yhat", F.when(F.col("_whole"), F.col("yhat"))).drop("_features", "_whole", *doubles)
    return scored if to == "yhat" else scored.withColumnRenamed("yhat", to)


def tree_out_of_fold(
    df: DataFrame, features: Sequence[str], target: str, kind: str, fold: str, folds: int, keep: Sequence[str], name: str | None = None, **options
) -> tuple[object, DataFrame]:
    """The model on all rows, and its training-fit and out-of-fold predictions for every row without gaps.

    The fits are independent jobs and are submitted side by side, so that small ones fill the cluster together. Each fold's predictions are
    written to one table as they come, so that neither models nor plans add up with the folds.
    """
    rows = spread(assemble(df.withColumn("y", col(target).cast("double")).where("y is not null"), features).select(
        *[col(c) for c in keep], col(fold).cast("int").alias("fold"), "y", "_features"
    ))
    path = scratch_path(df.sparkSession, "tree-folds")
    whole = estimator(kind, **options).fit(rows)

    def fit(left_out: int) -> None:
        part = estimator(kind, **options).fit(rows.where(F.col("fold") != left_out))
        held = whole.transform(rows.where(F.col("fold") == left_out)).withColumnRenamed("yhat", "yhat_train")
        part.transform(held).withColumnRenamed("yhat", "yhat_cv").drop("_features").write.mode("overwrite").parquet(f"{path}/{left_out}")

    try:
        with ThreadPool(max(1, min(folds, df.sparkSession.sparkContext.defaultParallelism))) as pool:
            pool.map(inheritable_thread_target(df.sparkSession)(fit), range(folds))
    finally:
        rows.unpersist()
    oof = df.sparkSession.read.schema(f"{_schema(rows, keep)}, fold int, y double, yhat_train double, yhat_cv double").parquet(*[f"{path}/{f}" for f in range(folds)])
    return whole, oof.withColumns({"target": F.lit(target), "model": F.lit(name or kind)})


def _schema(rows: DataFrame, columns: Sequence[str]) -> str:
    kinds = dict(rows.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


def leaves(model, p: int, spark: SparkSession) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per tree: the range of each feature in which a row reaches each leaf (low exclusive, high inclusive), the share of training rows that the
    splits on each feature let through, and the leaf's value times the tree's weight.

    The nodes come from the model's own saved form; like the model itself they are held by the driver.
    """
    path = scratch_path(spark, "tree-nodes")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.get("nodeData.impurityStats", F.lit(0)).alias("rows"), "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("at"),
    ).toPandas()
    weights = model.treeWeights
    total = sum(weights) if type(model).__name__.startswith("RandomForest") else 1.0
    forest = []
    for tree, own in nodes.groupby("treeID"):
        by_id = {r.id: r for r in own.itertuples(index=False)}
        found = []
        stack = [(0, np.full(p, -np.inf), np.full(p, np.inf), np.ones(p))]
        while stack:
            number, low, high, share = stack.pop()
            node = by_id[number]
            if node.leftChild < 0:
                found.append((low, high, share, node.prediction))
                continue
            j = int(node.feature)
            for child, is_left in ((node.leftChild, True), (node.rightChild, False)):
                less, more, part = low.copy(), high.copy(), share.copy()
                if is_left:
                    more[j] = min(more[j], node.at)
                else:
                    less[j] = max(less[j], node.at)
                part[j] *= by_id[child].rows / node.rows
                stack.append((child, less, more, part))
        low, high, share, value = (np.array(x) for x in zip(*found, strict=True))
        forest.append((low, high, share, value * weights[int(tree)] / total))
    return forest
