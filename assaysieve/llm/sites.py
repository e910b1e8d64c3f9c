"""Hierarchical empirical Bayes over sites: shares per host and per section of a host, shrunk towards the level above.

Groups are summed with partial sums per task, so a host with a third of all rows is a few numbers per task before anything is shuffled.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_GROUPS = 50_000  # groups up to which their table is copied to all executors
PRIOR_RANGE = 1.0, 1_000.0  # rows that a level above may weigh


def prior_rows(groups: DataFrame, count: str, total: str) -> float:
    """How many rows the prior of these groups weighs, by moments of the group shares.

    With little more spread between groups than sampling explains, the prior is strong; with much, weak.
    """
    share = F.col(total) / F.col(count)
    m = groups.agg(
        F.count("*").alias("k"), F.sum(count).alias("n"), F.sum(total).alias("s"),
        F.sum(F.col(count) * share * share).alias("q"), F.sum(F.col(count) * F.col(count)).alias("nn"),
    ).first()
    if not m["n"] or m["k"] < 2:
        return PRIOR_RANGE[1]
    mean = m["s"] / m["n"]
    between = m["q"] - m["n"] * mean * mean
    spread = mean * (1 - mean)
    scale = m["n"] - m["nn"] / m["n"]
    variance = max((between - (m["k"] - 1) * spread) / scale, 0.0) if scale > 0 else 0.0
    return min(max(spread / variance - 1, PRIOR_RANGE[0]), PRIOR_RANGE[1]) if variance > 0 else PRIOR_RANGE[1]


def with_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], n_groups: int) -> DataFrame:
    """Attach group sums (one row per key) to rows; null keys meet null keys.

    A counted small table is broadcast. A larger one meets the rows in a shuffled join, whose hot keys adaptive execution splits.
    """
    right = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return rows.join(F.broadcast(right) if n_groups <= BROADCAST_GROUPS else right, on, "left").drop(*[f"_g_{k}" for k in keys])


def logit(p: Column) -> Column:
    clear = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(clear / (1 - clear))

