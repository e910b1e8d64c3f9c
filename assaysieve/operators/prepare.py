"""Cleaning, imputing, scaling and feature engineering.

Fitting reads the data once per step and returns a few numbers per column. Applying is a projection over those
numbers as literals, so a chain of steps collapses into one Project.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col
from assaysieve.operators.roles import categorical_columns, numeric_columns
from assaysieve.operators.skew import exact_modes, exact_quantiles


@dataclass(frozen=True)
class Imputer:
    medians: dict[str, float | None]
    modes: dict[str, str]


@dataclass(frozen=True)
class Scaler:
    means: dict[str, float]
    deviations: dict[str, float]
    constant: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return list(self.means)


@dataclass(frozen=True)
class Preparation:
    """Everything learned from the training frame that scoring needs."""

    imputer: Imputer
    scaler: Scaler
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    squares: tuple[tuple[str, str], ...] = ()
    products: tuple[tuple[str, str, str], ...] = ()
    selected: tuple[str, ...] = ()
    missing_groups: tuple[str, ...] = field(default=())


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicates (nulls compare equal). Copies are combined before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def fit_imputer(df: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None) -> Imputer:
    numeric = numeric_columns(df) if numeric is None else list(numeric)
    categorical = categorical_columns(df) if categorical is None else list(categorical)
    medians = {c: q[0] for c, q in exact_quantiles(df, numeric, [0.5]).items()}
    modes = {c: m if m is not None else "Unknown" for c, m in exact_modes(df, categorical).items()}
    return Imputer(medians, modes)


def impute(df: DataFrame, imputer: Imputer) -> DataFrame:
    filled = {c: F.coalesce(col(c).cast("double"), F.lit(m)) for c, m in imputer.medians.items() if m is not None}
    kinds = dict(df.dtypes)
    filled |= {c: F.coalesce(col(c), F.lit(m).try_cast(kinds[c])) for c, m in imputer.modes.items() if c in kinds}
    return df.withColumns(filled) if filled else df


def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None, also_constant: Sequence[str] = ()) -> Scaler:
    """Mean and population deviation per column; the constant columns come from the same pass."""
    columns = numeric_columns(df) if columns is None else list(columns)
    watched = list(dict.fromkeys([*columns, *also_constant]))
    if not watched:
        return Scaler({}, {})
    stats = [F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)]
    stats += [F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(columns)]
    stats += [F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(f"c{i}") for i, c in enumerate(watched)]
    row = df.agg(*stats).first()
    means = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(columns)}
    constant = tuple(c for i, c in enumerate(watched) if row[f"c{i}"])
    deviations = {c: 1.0 if c in constant else row[f"s{i}"] or 1.0 for i, c in enumerate(columns)}
    return Scaler(means, deviations, constant)


def scale(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Apply fitted scaling; a fitted column the frame lacks is taken as 0 before scaling."""
    present = set(df.columns)
    scaled = {
        c: ((col(c).cast("double") if c in present else F.lit(0.0)) - F.lit(m)) / F.lit(scaler.deviations[c])
        for c, m in scaler.means.items()
    }
    return df.withColumns(scaled) if scaled else df


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct non-null value, from minimum and maximum instead of distinct counts."""
    columns = list(columns) if columns is not None else df.columns
    if not columns:
        return []
    row = df.agg(*[
        F.coalesce(F.min(col(c)) == F.max(col(c)), F.lit(True)).alias(str(i)) for i, c in enumerate(columns)
    ]).first()
    return [c for i, c in enumerate(columns) if row[str(i)]]


def default_engineering(columns: Sequence[str]) -> tuple[tuple[tuple[str, str], ...], tuple[tuple[str, str, str], ...]]:
    """Square and product features made when their sources are present: (new, source) and (new, left, right)."""
    squares = (("XLogP_squared", "XLogP"),) if "XLogP" in columns else ()
    products = (("XLogP_x_MW", "XLogP", "Molecular_Weight"),) if {"XLogP", "Molecular_Weight"} <= set(columns) else ()
    return squares, products


def engineer(
    df: DataFrame, squares: Sequence[tuple[str, str]] = (), products: Sequence[tuple[str, str, str]] = ()
) -> DataFrame:
    made = {new: F.pow(col(c), F.lit(2.0)) for new, c in squares if c in df.columns}
    made |= {new: col(a) * col(b) for new, a, b in products if a in df.columns and b in df.columns}
    return df.withColumns(made) if made else df


def fill_values(preparation: Preparation, fill: str = "zero") -> float | Mapping[str, float]:
    """What a missing number becomes when scoring: 0, or the training median of its column."""
    if fill == "zero":
        return 0.0
    if fill == "train_median":
        return {c: m if m is not None else 0.0 for c, m in preparation.imputer.medians.items()}
    raise ValueError(f"unknown fill {fill!r}: use 'zero' or 'train_median'")
