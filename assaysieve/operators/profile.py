"""Dataset profile, model recommendation, correlations and distributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, safe_ratio
from assaysieve.operators.catalogue import missing_ratio
from assaysieve.operators.roles import numeric_columns
from assaysieve.operators.skew import exact_quantiles, lookup_join

# Row-count bands (from, to) with the models and the validation recommended for each.
RECOMMENDATIONS = (
    (0, 19, ("Gaussian Process",), "LOOCV"),
    (20, 50, ("Random Forest", "SVR", "XGBoost", "CatBoost"), "5-Fold CV"),
    (51, 200, ("Random Forest", "XGBoost", "LightGBM", "CatBoost", "Gaussian Process"), "10-Fold CV + Test Set"),
    (201, None, ("Neural Networks", "XGBoost", "LightGBM", "Random Forest"), "10-Fold CV + Test Set"),
)


def recommend(rows: int) -> tuple[list[str], str]:
    for low, high, models, strategy in RECOMMENDATIONS:
        if rows >= low and (high is None or rows <= high):
            return list(models), strategy
    raise ValueError("row count must not be negative")


def recommendation_columns(rows: Column) -> tuple[Column, Column]:
    """Recommended models and validation as expressions over a row count."""
    models = strategy = F.lit(None)
    for low, high, names, plan in RECOMMENDATIONS[::-1]:
        here = rows.between(low, high) if high is not None else rows >= low
        models = F.when(here, F.array(*[F.lit(n) for n in names])).otherwise(models)
        strategy = F.when(here, F.lit(plan)).otherwise(strategy)
    return models, strategy


def outlier_ratio(df: DataFrame, columns: Sequence[str] | None = None, limit: float = 3.0, by: Sequence[str] = ()) -> DataFrame:
    """Share of numeric cells more than `limit` sample deviations from their column mean, per group.

    The first pass yields a few statistics per group, the second counts; rows are never gathered by group.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    by = list(by)
    if not columns:
        return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.lit(0.0).alias("outlier_ratio"))
    stats = [F.avg(col(c)).alias(f"_m{i}") for i, c in enumerate(columns)]
    stats += [_sample_deviation(col(c)).alias(f"_s{i}") for i, c in enumerate(columns)]
    if by:
        joined = lookup_join(df, df.groupBy(*by).agg(*stats), by)
        far = [F.count_if(_is_far(col(c), F.col(f"_m{i}"), F.col(f"_s{i}"), limit)) for i, c in enumerate(columns)]
    else:
        row = df.agg(*stats).first()
        joined = df
        far = [
            F.count_if(_is_far(col(c), F.lit(row[f"_m{i}"]).cast("double"), F.lit(row[f"_s{i}"]).cast("double"), limit))
            for i, c in enumerate(columns)
        ]
    cells = F.count("*") * len(columns)
    return joined.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.coalesce(safe_ratio(reduce(add, far), cells), F.lit(0.0)).alias("outlier_ratio")
    )


def _sample_deviation(c: Column) -> Column:
    """Sample standard deviation, NULL below two values."""
    squares = F.var_pop(c) * F.count(c)
    return F.sqrt(safe_ratio(squares, F.count(c) - F.lit(1)))


def _is_far(c: Column, mean: Column, deviation: Column, limit: float) -> Column:
    return F.coalesce(F.abs(safe_ratio(c - mean, deviation)) > limit, F.lit(False))


def dataset_profile(
    df: DataFrame, features: Sequence[str], raw: DataFrame | None = None, raw_features: Sequence[str] | None = None
) -> DataFrame:
    """One row: samples, features, missing and outlier shares, recommended models and validation.

    The missing share is taken from `raw`, the frame before imputation, where one is given.
    """
    before = df if raw is None else raw
    share = before.agg(missing_ratio(before, raw_features or features).alias("r")).first()["r"]
    numeric = [c for c in features if c in numeric_columns(df)]
    counted = outlier_ratio(df, numeric)
    models, strategy = recommendation_columns(F.col("n_samples"))
    return counted.select(
        F.col("n_rows").alias("n_samples"), F.lit(len(features)).alias("n_features"),
        F.lit(float(share)).alias("missing_pct"), "outlier_ratio",
    ).withColumns({"models": models, "validation_strategy": strategy})


def correlations(df: DataFrame, left: Sequence[str], right: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of column pairs over the rows where both are present, long form, from one aggregate.

    NULL and NaN are both missing. The result is NULL where either side is constant. Without `right`, all ordered pairs of `left` including the
    diagonal. Sums of every pair come from matrix products per batch; each task hands on one small row per pair.
    """
    pairs = list(combinations(left, 2)) + [(c, c) for c in left] if right is None else [(a, b) for a in left for b in right]
    mirrored = right is None
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    known = [F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in columns]
    means = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(str(i)) for i, c in enumerate(known)]).first()
    shift = np.array([means[str(i)] for i in range(len(columns))])
    at = np.array([(columns.index(a), columns.index(b)) for a, b in pairs])
    wanted = df.select(*[c.alias(f"c{i}") for i, c in enumerate(known)])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(at)))
        i, j = at[:, 0], at[:, 1]
        for batch in batches:
            x = batch.to_numpy(float) - shift
            seen = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            squares = x * x
            n, s, q, c = seen.T @ seen, x.T @ seen, squares.T @ seen, x.T @ x
            total += np.stack([n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j]])
        yield pd.DataFrame(total.T, columns=["n", "sx", "sy", "sxx", "syy", "sxy"]).assign(pair=np.arange(len(at), dtype="int32"))

    parts = wanted.mapInPandas(sums, "n double, sx double, sy double, sxx double, syy double, sxy double, pair int")
    summed = parts.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")

    def spread(s: str, ss: str, which: int) -> Column:
        """Centred squares, 0 where what is left of the raw squares is rounding noise."""
        centred = F.col(ss) - safe_ratio(F.col(s) * F.col(s), n)
        floor = F.element_at(F.array(*[F.lit(float(1e-24 * shift[k] ** 2)) for k in at[:, which]]), F.col("pair") + 1) * n
        return F.when((centred > 1e-12 * F.col(ss)) & (centred > floor), centred)

    cross = F.col("sxy") - safe_ratio(F.col("sx") * F.col("sy"), n)
    corr = safe_ratio(cross, F.sqrt(spread("sx", "sxx", 0)) * F.sqrt(spread("sy", "syy", 1)))
    names = [F.element_at(F.array(*[F.lit(p[k]) for p in pairs]), F.col("pair") + 1) for k in (0, 1)]
    found = summed.select(names[0].alias("column_a"), names[1].alias("column_b"), corr.alias("corr"))
    if not mirrored:
        return found
    both = F.array(F.struct("column_a", "column_b", "corr"), F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "corr"))
    once = F.array(F.struct("column_a", "column_b", "corr"))
    return found.select(F.explode(F.when(F.col("column_a") == F.col("column_b"), once).otherwise(both)).alias("e")).select("e.*")


def correlation_heatmap(df: DataFrame) -> DataFrame:
    """Correlations of all numeric columns; no rows with fewer than two of them."""
    numeric = numeric_columns(df)
    return correlations(df, numeric if len(numeric) >= 2 else [])


def target_correlations(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Features by targets, ordered by strength of correlation with the first target."""
    numeric = numeric_columns(df)
    kept = [t for t in targets if t in numeric]
    features = [c for c in numeric if c not in targets]
    long = correlations(df, features, kept)
    wide = long.groupBy(F.col("column_a").alias("feature")).agg(*[
        F.max(F.when(F.col("column_b") == t, F.col("corr"))).alias(t) for t in kept
    ])
    return wide.orderBy(F.abs(col(kept[0])).desc_nulls_last(), "feature") if kept else wide


BIN_RANGE = 1 << 16  # bins that are made at a time


def bin_plan(df: DataFrame, column: str) -> dict[str, float]:
    """Histogram range and bin count: the narrower of the Sturges and Freedman-Diaconis widths."""
    q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
    c = col(column).cast("double")
    row = df.agg(F.count(c), F.min(c), F.max(c), _sample_deviation(c)).first()
    n, low, high, deviation = row
    plan = {"n": n, "low": low, "high": high, "deviation": deviation, "bins": 1, "width": 1.0}
    if not n or high == low:
        if n:
            plan["low"], plan["high"] = low - 0.5, high + 0.5
        return plan
    width = (high - low) / (math.log2(n) + 1)
    robust = 2 * (q3 - q1) / n ** (1 / 3)
    if robust > 0:
        width = min(width, robust)
    if dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint"):
        width = max(width, 1.0)
    plan["bins"] = math.ceil((high - low) / width)
    plan["width"] = (high - low) / plan["bins"]
    return plan


def histogram(df: DataFrame, columns: Sequence[str], plans: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Counts per bin of every column, empty bins included; the last bin is closed on the right.

    Heavy tails can ask for very many bins: they are made in ranges of bounded size, and joined to the counts.
    """
    plans = plans or {c: bin_plan(df, c) for c in columns}
    columns = [c for c in columns if plans[c]["n"]]
    cells = []
    for c in columns:
        p = plans[c]
        spot = F.floor((col(c).cast("double") - p["low"]) / p["width"]).cast("bigint")
        cells.append(F.struct(F.lit(c).alias("target"), F.least(spot, F.lit(p["bins"] - 1).cast("bigint")).alias("bin")))
    counted = (
        df.select(F.explode(F.array(*cells)).alias("e")).select("e.*").where("bin is not null")
        .groupBy("target", "bin").agg(F.count("*").alias("n"))
    )
    return _with_all_bins(df.sparkSession, counted, {c: plans[c] for c in columns})


def _with_all_bins(spark: SparkSession, counted: DataFrame, plans: dict[str, dict[str, float]]) -> DataFrame:
    layout = spark.createDataFrame(
        [(c, p["bins"], float(p["low"]), float(p["width"])) for c, p in plans.items()],
        "target string, bins bigint, low double, width double",
    )
    size = F.lit(BIN_RANGE).cast("bigint")
    ranges = layout.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("bins") - 1) / size)))).withColumn("from", F.col("from") * size)
    spread = ranges.repartition("target", "from") if max(p["bins"] for p in plans.values()) > BIN_RANGE else ranges
    every = spread.select("target", "low", "width", F.explode(F.sequence("from", F.least(F.col("from") + size, F.col("bins")) - 1)).alias("bin"))
    return every.join(counted, ["target", "bin"], "left").select(
        "target", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(df: DataFrame, column: str, plan: dict[str, float] | None = None, grid: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, Scott bandwidth.

    Equal values are counted first. Each task adds its values up on the whole grid and hands on one row per grid point.
    """
    plan = plan or bin_plan(df, column)
    n, low, high, deviation = plan["n"], plan["low"], plan["high"], plan["deviation"]
    if not n or n < 2 or not deviation:
        return df.sparkSession.createDataFrame([], "grid_index int, x double, density double, scaled_count double")
    bandwidth = deviation * n ** (-1 / 5)
    points = low + np.arange(grid) * ((high - low) / (grid - 1))
    norm = 1.0 / (n * bandwidth * math.sqrt(2 * math.pi))
    counted = df.select(col(column).cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count("*").cast("double").alias("w"))

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(grid)
        for batch in batches:
            u = (points[None, :] - batch["v"].to_numpy()[:, None]) / bandwidth
            total += batch["w"].to_numpy() @ np.exp(-u * u / 2)
        yield pd.DataFrame({"grid_index": np.arange(grid, dtype="int32"), "x": points, "part": total})

    sums = counted.mapInPandas(added, "grid_index int, x double, part double").groupBy("grid_index", "x").agg((F.sum("part") * norm).alias("density"))
    return sums.select("grid_index", "x", "density", (F.col("density") * float(n * plan["width"])).alias("scaled_count"))


def target_stats(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Count, range, mean and sample deviation per target, long form."""
    parts = []
    for t in targets:
        c = col(t).cast("double")
        parts += [F.struct(
            F.lit(t).alias("target"), F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"),
            F.avg(c).alias("mean"), _sample_deviation(c).alias("deviation"),
        ).alias(f"s{len(parts)}")]
    return df.agg(*parts).select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(parts))])).alias("e")).select("e.*")
