"""Shapley values: closed form for linear models, the paths of tree models, and coalitions for any other model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col
from assaysieve.operators.trees import assemble, leaves

COALITIONS = 4096  # coalitions up to which all are evaluated
CELLS = 4_000_000  # rows times leaves times features that are held at once


def linear_shap(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], means: Sequence[float], keep: Sequence[str], intercept: float | None = None
) -> DataFrame:
    """Shapley values of a linear model, wide: weight times distance from the background mean. With its intercept also `base`, the value at the mean."""
    values = [(F.lit(float(w)) * (col(c) - F.lit(float(m)))).alias(f"phi_{c}") for c, w, m in zip(features, weights, means, strict=True)]
    base = [] if intercept is None else [F.lit(float(intercept + np.dot(weights, means))).alias("base")]
    return df.select(*[col(c) for c in keep], *values, *base)


def background(df: DataFrame, features: Sequence[str], k: int = 10, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """k-means summary of the features: centres moved to the nearest observed value per feature, and cluster shares. One centre is the mean.

    The clustering and the search for nearest values run on the executors; k rows come back.
    """
    features = list(features)
    if k == 1:
        centres, sizes = [list(df.agg(*[F.avg(col(c).cast("double")) for c in features]).first())], {0: 1}
    else:
        rows = assemble(df.select(*[col(c) for c in features]), features)
        model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_cluster").fit(rows)
        centres = [c.tolist() for c in model.clusterCenters()]
        sizes = {r["_cluster"]: r["count"] for r in model.transform(rows).groupBy("_cluster").count().collect()}
    picks = [
        F.min_by(col(c).cast("double"), F.struct(F.abs(col(c) - F.lit(centre[j])), col(c))).alias(f"{i}_{j}")
        for i, centre in enumerate(centres) for j, c in enumerate(features)
    ]
    nearest = df.agg(*picks).first()
    points = np.array([[nearest[f"{i}_{j}"] for j in range(len(features))] for i in range(len(centres))], float)
    share = np.array([sizes.get(i, 0) for i in range(len(centres))], float)
    return points, share / share.sum()


def coalition_weights(p: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every subset of features as a mask with its contribution factor for each feature."""
    for mask in range(2**p):
        inside = np.array([(mask >> j) & 1 for j in range(p)], bool)
        size = int(inside.sum())
        with_feature = factorial(size - 1) * factorial(p - size) / factorial(p) if size else 0.0
        without = factorial(size) * factorial(p - size - 1) / factorial(p) if size < p else 0.0
        yield inside, np.where(inside, with_feature, -without)


def shapley_values(predict: Callable[[np.ndarray], np.ndarray], x: np.ndarray, points: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of a batch of rows against weighted background points, over all coalitions."""
    phi = np.zeros_like(x)
    for inside, factor in coalition_weights(x.shape[1]):
        mean = sum(weight * predict(np.where(inside, x, point)) for point, weight in zip(points, share, strict=True))
        phi += mean[:, None] * factor
    return phi


PAIRS = 64  # pairs of coalitions of the first draw; every further draw doubles them
MOST_PAIRS = 4096
ERROR = 0.01  # standard error, against the spread of a row's values, at which drawing ends


def drawn_pairs(rng: np.random.Generator, p: int, pairs: int) -> np.ndarray:
    """Coalitions whose size has the weight of the Shapley kernel; each one's complement is its other half."""
    sizes = np.arange(1, p)
    weight = 1.0 / (sizes * (p - sizes))
    drawn = rng.choice(sizes, pairs, p=weight / weight.sum())
    order = rng.random((pairs, p)).argsort(1).argsort(1)
    return order < drawn[:, None]


def regression_values(
    predict: Callable[[np.ndarray], np.ndarray], x: np.ndarray, points: np.ndarray, share: np.ndarray,
    error: float = ERROR, most_pairs: int = MOST_PAIRS, seed: int = 42,
) -> tuple[np.ndarray, np.ndarray]:
    """Shapley values of a batch of rows by constrained least squares over drawn coalitions, and their standard errors.

    A linear model of coalitions is fitted to the predictions so that its values add up to prediction minus base. The pairs of a coalition and its complement are the same
    for all rows; the errors come from how the pairs' residuals scatter. Drawing ends when no error is above `error` of the spread between a row's values, or at
    `most_pairs`. A model that is linear in coalitions has errors of 0.
    """
    n, p = x.shape
    mean = lambda inside: sum(w * predict(np.where(inside, x, point)) for point, w in zip(points, share, strict=True))
    none, whole = mean(np.zeros(p, bool)), mean(np.ones(p, bool))
    if p < 2:
        return (whole - none)[:, None] * np.ones((1, p)), np.zeros((n, p))
    rng = np.random.default_rng(seed)
    masks, values = np.zeros((0, p), bool), np.zeros((0, 2, n))
    while True:
        fresh = drawn_pairs(rng, p, max(PAIRS, len(masks), p))
        masks = np.concatenate([masks, fresh])
        values = np.concatenate([values, [[mean(m) - none, mean(~m) - none] for m in fresh]])
        z = np.stack([masks, ~masks], 1).astype(float)
        flat = z.reshape(-1, p)
        inverse = np.linalg.pinv(flat.T @ flat / len(flat))
        response = flat.T @ values.reshape(-1, n) / len(flat)
        ones = inverse.sum(1)
        phi = inverse @ response
        phi -= np.outer(ones, (phi.sum(0) - (whole - none)) / ones.sum())
        residual = values - np.einsum("kap,pn->kan", z, phi)
        # What one pair moves the values by, if it is weighed a little more: the constraint holds for it too.
        turned = z @ (inverse - np.outer(ones, ones) / ones.sum()).T
        first, second = turned[:, 0], turned[:, 1]
        a, b = residual[:, 0], residual[:, 1]
        spread = (a * a).T @ (first * first) + 2 * (a * b).T @ (first * second) + (b * b).T @ (second * second)
        errors = np.sqrt(np.maximum(spread, 0)) / len(flat)
        wide = np.maximum(phi.max(0) - phi.min(0), 1e-12)
        if len(masks) >= most_pairs or (errors <= error * wide[:, None]).all():
            return phi.T, errors


def kernel_shap(
    df: DataFrame,
    features: Sequence[str],
    predict: Callable[[np.ndarray], np.ndarray],
    points: np.ndarray,
    share: np.ndarray,
    keep: Sequence[str],
    exact: bool | None = None,
    error: float = ERROR,
) -> DataFrame:
    """Shapley values of a vectorised predictor. Coalitions are evaluated inside each Arrow batch: no row multiplies.

    With `exact` every coalition is, at any number of features; by default up to 12. Otherwise values are fitted to drawn coalitions, until their standard
    errors, which come as columns `error_<feature>`, are below `error` of the spread of a row's values.
    """
    exact = 2 ** len(features) <= COALITIONS if exact is None else exact
    features, keep = list(features), list(keep)
    rows = df.select(*[col(c) for c in dict.fromkeys([*keep, *features])]).dropna(subset=features)
    kinds = dict(rows.dtypes)
    names = [f"phi_{c}" for c in features] + ([] if exact else [f"error_{c}" for c in features])
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{c}` double" for c in names] + ["base double"])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = float(share @ predict(points))
        for batch in batches:
            x = batch[features].to_numpy(float)
            found = shapley_values(predict, x, points, share) if exact else np.hstack(regression_values(predict, x, points, share, error))
            yield pd.concat([batch[keep], pd.DataFrame(found, columns=names, index=batch.index)], axis=1).assign(base=base)

    return rows.mapInPandas(explain, schema)


def path_values(x: np.ndarray, forest: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Shapley values of summed trees, where a feature that is not known follows both branches in the shares of the training rows.

    A leaf contributes its value times one factor per feature: whether the row's number lies in the leaf's range where the feature is known, and the
    share of rows that its splits let through where it is not. The Shapley value of such a product is an integral over one polynomial, which the
    quadrature gives exactly.
    """
    n, p = x.shape
    nodes, weights = np.polynomial.legendre.leggauss(max(1, (p + 1) // 2))
    nodes, weights = (nodes + 1) / 2, weights / 2
    phi = np.zeros((n, p))
    for low, high, share, value in forest:
        step = max(1, CELLS // max(low.size, 1))
        for begin in range(0, n, step):
            part = x[begin:begin + step]
            fits = [((part[:, j, None] > low[None, :, j]) & (part[:, j, None] <= high[None, :, j])).astype(float) for j in range(p)]
            for t, w in zip(nodes, weights, strict=True):
                factors = [t * fits[j] + (1 - t) * share[None, :, j] for j in range(p)]
                for i in range(p):
                    product = (fits[i] - share[None, :, i]) * (w * value[None, :])
                    for j in range(p):
                        if j != i:
                            product = product * factors[j]
                    phi[begin:begin + step, i] += product.sum(1)
    return phi


def tree_shap(df: DataFrame, features: Sequence[str], model, keep: Sequence[str]) -> DataFrame:
    """Shapley values of a fitted Spark ML tree model from the paths of its trees, and `base`, its mean over the training rows.

    The leaves travel to the executors once and rows are explained in their Arrow batches: no row multiplies and nothing is shuffled. A row
    with a missing feature has NULL values.
    """
    features, keep = list(features), list(keep)
    forest = leaves(model, len(features), df.sparkSession)
    base = float(sum((np.prod(share, axis=1) * value).sum() for _, _, share, value in forest))
    shared = df.sparkSession.sparkContext.broadcast(forest)
    rows = df.select(*[col(c) for c in dict.fromkeys([*keep, *features])])
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`phi_{c}` double" for c in features] + ["base double"])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(float)
            whole = ~np.isnan(x).any(1)
            phi = np.full(x.shape, np.nan)
            phi[whole] = path_values(x[whole], shared.value)
            values = pd.DataFrame(phi, columns=[f"phi_{c}" for c in features], index=batch.index).astype(object)
            yield pd.concat([batch[keep], values.where(~np.isnan(phi), None)], axis=1).assign(base=base)

    return rows.mapInPandas(explain, schema)


def importance(shap: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features by mean absolute Shapley value, strongest first."""
    means = shap.agg(*[F.avg(F.abs(col(f"phi_{c}"))).alias(f"i{i}") for i, c in enumerate(features)])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"i{i}").alias("importance")) for i, c in enumerate(features)])
    return means.select(F.explode(entries).alias("e")).select("e.*").orderBy(F.desc_nulls_last("importance"), "feature")


def shap_long(shap: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per entity and feature, the form a summary chart reads."""
    entries: Column = F.array(*[F.struct(F.lit(c).alias("feature"), col(f"phi_{c}").alias("phi")) for c in features])
    return shap.select(*[col(c) for c in keep], F.explode(entries).alias("e")).select(*[col(c) for c in keep], "e.*")
