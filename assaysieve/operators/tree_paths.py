"""Shapley values of tree models along their paths.

A leaf speaks for a product: per feature on its path, whether the row's value fits the path's range if the feature is known, and the share of training rows that its
splits let through if not. Extending such a product by one feature, and unwinding one again, are steps on the sums over subsets of each size, so that a
leaf costs its path's features squared. Where a tree's paths have few features, the values of all patterns of fitting are worked out once per leaf and rows look theirs up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.functions.exprs import col
from assaysieve.operators import histogram_trees as T

CELLS = 2_000_000  # numbers that are held at once
LEAST_SHARE = 1e-12  # of a branch that no training row took


def leaf_paths(nodes: T.Nodes, root: int, features: int) -> tuple[np.ndarray, ...]:
    """Per leaf and feature the path's range (low exclusive, high inclusive), whether missing values follow it, and its share of the rows; and the leaves' values."""
    at = np.array([root])
    low, high = np.full((1, features), -np.inf), np.full((1, features), np.inf)
    missing, share = np.ones((1, features), bool), np.ones((1, features))
    leaves: list[tuple[np.ndarray, ...]] = []
    while at.size:
        ends = nodes.feature[at] < 0
        leaves.append((low[ends], high[ends], missing[ends], share[ends], nodes.value[at[ends]]))
        at, low, high, missing, share = at[~ends], low[~ends], high[~ends], missing[~ends], share[~ends]
        rows, j = np.arange(at.size), nodes.feature[at]
        below = []
        for child, is_left in ((nodes.left[at], True), (nodes.right[at], False)):
            l, h, m, s = low.copy(), high.copy(), missing.copy(), share.copy()
            if is_left:
                h[rows, j] = np.minimum(h[rows, j], nodes.at[at])
            else:
                l[rows, j] = np.maximum(l[rows, j], nodes.at[at])
            m[rows, j] &= nodes.missing_left[at] == is_left
            whole = nodes.weight[nodes.left[at]] + nodes.weight[nodes.right[at]]
            s[rows, j] *= np.maximum(np.divide(nodes.weight[child], whole, out=np.full(at.size, 0.5), where=whole > 0), LEAST_SHARE)
            below.append((child, l, h, m, s))
        at, low, high, missing, share = (np.concatenate(x) for x in zip(*below, strict=True))
    return tuple(np.concatenate(x) for x in zip(*leaves, strict=True))


def unwound(fits: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values of products over slots: ... x leaves x slots. `fits` is 0 or 1, `share` above 0; a slot with both 1 is no player."""
    slots = fits.shape[-1]
    sums = np.zeros((slots + 1, *fits.shape[:-1]))  # over subsets of each size of the slots so far
    sums[0] = 1.0
    for s in range(slots):
        sums[1:s + 2] = sums[1:s + 2] * share[..., s] + sums[:s + 1] * fits[..., s]
        sums[0] *= share[..., s]
    factor = [factorial(k) * factorial(slots - 1 - k) / factorial(slots) for k in range(slots)]
    out = np.empty(fits.shape)
    for s in range(slots):
        known, part = fits[..., s] > 0, share[..., s]
        total, without = np.zeros(sums.shape[1:]), np.zeros(sums.shape[1:])
        for k in range(slots - 1, -1, -1):
            # Taking the slot out again: of (share + size) times the rest where it fits, of share times the rest where not.
            without = np.where(known, sums[k + 1] - part * without, sums[k] / part)
            total += factor[k] * without
        out[..., s] = total * (fits[..., s] - part) * value
    return out


def _slots(low: np.ndarray, high: np.ndarray, missing: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Per leaf the features on its path, filled up with features that are not."""
    on_path = np.isfinite(low) | np.isfinite(high) | ~missing | (share != 1)
    width = max(int(on_path.sum(1).max(initial=0)), 1)
    return np.argsort(~on_path, axis=1, kind="stable")[:, :min(width, low.shape[1])]


def tree_values(x: np.ndarray, nodes: T.Nodes) -> tuple[np.ndarray, float]:
    """Shapley values of summed trees for the rows, and the model's mean over the training rows."""
    n, features = x.shape
    phi, base = np.zeros((n, features)), nodes.start
    lost = np.isnan(x)
    for root in nodes.roots.tolist():
        low, high, missing, share, value = leaf_paths(nodes, root, features)
        base += float((share.prod(1) * value).sum())
        if not features or len(value) == 1:
            continue
        slots = _slots(low, high, missing, share)
        leaves, width = slots.shape
        row = np.arange(leaves)[:, None]
        low, high, missing, share = (a[row, slots] for a in (low, high, missing, share))
        few = leaves * features << width <= CELLS
        if few:
            patterns = np.arange(1 << width)[:, None] >> np.arange(width) & 1
            known = unwound(np.broadcast_to(patterns[:, None, :], (1 << width, leaves, width)).astype(float), share, value[:, None].T)
            table = np.zeros((leaves, 1 << width, features))
            for s in range(width):
                table[np.arange(leaves), :, slots[:, s]] += known[:, :, s].T
            table = table.reshape(-1, features)
        step = max(1, CELLS // (leaves * max(width, features)))
        for begin in range(0, n, step):
            part, gone = x[begin:begin + step], lost[begin:begin + step]
            code = np.zeros((len(part), leaves), np.int64)
            fits = None if few else np.empty((len(part), leaves, width))
            for s in range(width):
                own = part[:, slots[:, s]]
                fit = np.where(gone[:, slots[:, s]], missing[:, s], (own > low[:, s]) & (own <= high[:, s]))
                if few:
                    code += fit.astype(np.int64) << s
                else:
                    fits[..., s] = fit
            if few:
                phi[begin:begin + step] += table[code + (np.arange(leaves) << width)].sum(1)
            else:
                found = unwound(fits, share, value)
                for s in range(width):
                    for j in range(features):
                        phi[begin:begin + step, j] += found[:, slots[:, s] == j, s].sum(1)
    return phi, base


def explain_trees(df: DataFrame, features: Sequence[str], model: DataFrame, keep: Sequence[str], limit: int = T.MODEL_BYTES) -> DataFrame:
    """Shapley values of one fitted tree model and `base`, its mean over the training rows, for every row; missing values follow the paths they were taught.

    A model of up to `limit` bytes is copied to the executors; of a larger one, shares meet the rows in groups and their values add up.
    """
    features, keep = list(features), list(keep)
    if T.model_bytes(model) <= limit:
        shared = df.sparkSession.sparkContext.broadcast(T.joined_nodes(model.select("tree", "piece", "start", *T.ARRAY_NAMES).toArrow()))

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for rows in batches:
                phi, base = tree_values(T._as_matrix(rows, len(features)), shared.value)
                yield _listed(np.column_stack([phi, np.full(len(phi), base)]))

        told = df.withColumn("_phi", arrow_udf(run, returnType="array<double>")(T._vectors(features)))
    else:
        start = float(model.agg(F.max("start")).first()[0])

        def share(x: np.ndarray, nodes: T.Nodes) -> dict[str, pa.Array]:
            phi, base = tree_values(x, nodes)
            return {"phi": _listed(np.column_stack([phi, np.full(len(phi), base - nodes.start)]))}

        rows, found = T.by_shares(df, model, features, limit, "phi array<double>", share)
        places = range(len(features) + 1)
        total = found.groupBy("_row").agg(F.array(*[F.sum(F.col("phi")[i]) + F.lit(start if i == len(features) else 0.0) for i in places]).alias("_phi"))
        told = rows.join(total, "_row")
    values = [F.col("_phi")[i].alias(f"phi_{c}") for i, c in enumerate(features)]
    return told.select(*[col(c) for c in keep], *values, F.col("_phi")[len(features)].alias("base"))


def _listed(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())
