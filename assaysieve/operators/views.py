"""Tables behind the charts and the report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, has_identifier, image_link, lookup_key
from assaysieve.operators.catalogue import align_columns
from assaysieve.operators.roles import place_first, prediction_columns
from assaysieve.operators.skew import lookup_join
from assaysieve.operators.validate import quality


def model_comparison(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Models of each target in ascending cross-validated R2 with their quality class."""
    keys = [*by, "target"]
    return scores.select(*[col(k) for k in keys], "model", "cv_r2", quality().alias("quality")).orderBy(*keys, "cv_r2", "model")


def actual_vs_predicted(oof: DataFrame, best: DataFrame, by: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Measured value, training-fit and out-of-fold prediction of each target's best model. One best row per target."""
    keys = [*by, "target", "model"]
    chosen = best.select(*[col(k) for k in keys], "train_r2", "cv_rmse")
    return lookup_join(oof, chosen, keys, "inner").select(*[col(k) for k in [*keep, *keys]], "y", "yhat_train", "yhat_cv", "train_r2", "cv_rmse")


def plot_bounds(pairs: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """Common axis range of measured and predicted values."""
    return pairs.groupBy(*[col(k) for k in by]).agg(
        F.least(F.min("y"), F.min("yhat_train")).alias("low"), F.greatest(F.max("y"), F.max("yhat_train")).alias("high")
    )


class Projection(NamedTuple):
    features: list[str]
    means: list[float]
    loadings: list[list[float]]
    explained: list[float]


def fit_projection(df: DataFrame, features: Sequence[str], components: int = 2) -> Projection:
    """Principal components from one aggregate of means and covariances; the largest loading of each is positive."""
    features = list(features)
    p = len(features)
    aggs = [F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(features)]
    aggs += [
        F.covar_pop(col(features[i]).cast("double"), col(features[j]).cast("double")).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)
    ]
    row = df.dropna(subset=features).agg(*aggs).first()
    covariance = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)], float)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    loadings = []
    for i in order:
        v = vectors[:, i]
        loadings.append((v * (1.0 if v[np.argmax(np.abs(v))] >= 0 else -1.0)).tolist())
    total = float(values.sum())
    explained = [float(values[i]) / total if total > 0 else 0.0 for i in order]
    return Projection(features, [row[f"m{i}"] for i in range(p)], loadings, explained)


def project(df: DataFrame, projection: Projection, keep: Sequence[str] = ()) -> DataFrame:
    centred = [col(c) - F.lit(m) for c, m in zip(projection.features, projection.means, strict=True)]
    parts = [
        reduce(add, [F.lit(float(w)) * c for w, c in zip(weights, centred, strict=True)]).alias(f"pc{i + 1}")
        for i, weights in enumerate(projection.loadings)
    ]
    return df.select(*[col(c) for c in keep], *parts)


def feature_map(train: DataFrame, novel: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Training and novel entities in the plane of the training features' two main components."""
    fitted = fit_projection(train, features)
    shares = {f"explained_{i + 1}": F.lit(s) for i, s in enumerate(fitted.explained)}
    known = project(train, fitted, keep).withColumn("kind", F.lit("training"))
    new = project(align_columns(novel, fitted.features, keep), fitted, keep).withColumn("kind", F.lit("novel"))
    return known.unionByName(new).withColumns(shares)


def error_bars(ranked: DataFrame, keep: Sequence[str], limit: int | None = 20, order: Sequence | None = None) -> DataFrame:
    """One row per entity and target with value and error; the best `limit` entities of the ranking."""
    top = ranked if limit is None else ranked.orderBy(*(order or [F.col("score").desc_nulls_last(), *keep])).limit(limit)
    entries = []
    for p in prediction_columns(ranked):
        target = p.removesuffix("_Prediction")
        error = col(f"{target}_Uncertainty") if f"{target}_Uncertainty" in ranked.columns else F.lit(0.0)
        entries.append(F.struct(F.lit(target).alias("target"), col(p).alias("value"), error.cast("double").alias("error")))
    return top.select(*[col(c) for c in keep], F.explode(F.array(*entries)).alias("e")).select(*[col(c) for c in keep], "e.*")


def novel_top(ranked: DataFrame, experiment: DataFrame, top_n: int = 15, name: str = "solvent_name", order: Sequence | None = None) -> DataFrame:
    """The best entities of the ranking that were not measured. Names are compared trimmed and in lower case."""
    known = experiment.select(lookup_key(name).alias("name_key")).distinct()
    unseen = lookup_join(ranked.withColumn("name_key", lookup_key(name)), known, ["name_key"], "left_anti").drop("name_key")
    return unseen.orderBy(*(order or [F.col("score").desc_nulls_last(), col(name)])).limit(top_n)


def measured_vs_novel(
    ranked: DataFrame, experiment: DataFrame, targets: Sequence[str], top_n: int = 15, name: str = "solvent_name", order: Sequence | None = None
) -> DataFrame:
    """Measured values and the best novel predictions in one table, with their origin; measured values have no error."""
    novel = error_bars(novel_top(ranked, experiment, top_n, name, order), [name], None).withColumn("origin", F.lit("novel"))
    present = [t for t in targets if t in experiment.columns]
    entries = F.array(*[F.struct(F.lit(t).alias("target"), col(t).cast("double").alias("value")) for t in present])
    measured = experiment.select(col(name), F.explode(entries).alias("e")).select(
        col(name), "e.target", "e.value", F.lit(0.0).alias("error"), F.lit("measured").alias("origin")
    )
    return measured.unionByName(novel)


def measured_order(experiment: DataFrame, target: str, name: str, limit: int) -> DataFrame:
    """The `limit` best measured entities of one target with their position."""
    order = [col(target).desc_nulls_last(), col(name)]
    top = experiment.select(col(name), col(target)).orderBy(*order).limit(limit)
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def measured_positions(experiment: DataFrame, targets: Sequence[str], name: str, limit: int | None = None) -> DataFrame:
    """Measured values of every target with their position, best first; at most `limit` per target, of which each task passes on no more."""
    entries = F.array(*[F.struct(F.lit(t).alias("target"), col(t).cast("double").alias("value")) for t in targets])
    long = experiment.select(col(name), F.explode(entries).alias("e")).select(col(name), "e.*").where("value is not null")
    placed = long.withColumn("position", F.row_number().over(Window.partitionBy("target").orderBy(F.col("value").desc(), col(name))))
    return placed if limit is None else placed.where(F.col("position") <= limit)


def with_links(df: DataFrame, identifier: str = "SMILES", fallback: str | None = None, to: str = "Structure") -> DataFrame:
    """Picture link from the identifier or its fallback, as second column; no column if no row has one."""
    own = col(identifier) if identifier in df.columns else F.lit(None).cast("string")
    source = own if fallback is None else F.when(has_identifier(own), own).otherwise(col(fallback))
    if df.where(has_identifier(source)).limit(1).count() == 0:
        return df
    return place_first(df.withColumn(to, image_link(source)), df.columns[0], to)


def display_names(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Columns under readable headings: the given ones, else with underscores as spaces."""
    return df.select(*[col(c).alias((names or {}).get(c, c.replace("_", " "))) for c in df.columns])
