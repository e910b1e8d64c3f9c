"""Column roles, resolved on the driver from the schema alone. No data is read here."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.functions import vocabulary as V
from assaysieve.functions.exprs import col, finite_or_null


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def nan_as_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(c) for c in floats}) if floats else df


def name_entity_column(
    df: DataFrame, headings: Sequence[str] = V.ENTITY_HEADINGS, to: str = "solvent_name"
) -> DataFrame:
    """Rename the entity column: by heading, else keep an exact match, else first text column, else first."""
    for name in df.columns:
        if name.lower().strip().replace("_", " ") in headings:
            return df.withColumnRenamed(name, to)
    if to in df.columns:
        return df
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumnRenamed((text or df.columns)[0], to)


def infer_targets(df: DataFrame, known: Iterable[str] = V.KNOWN_DESCRIPTORS) -> list[str]:
    """Numeric columns that are not descriptors."""
    descriptors = set(known)
    found = [c for c in numeric_columns(df) if c.lower() not in descriptors]
    if not found:
        raise ValueError("no target columns: add at least one numeric column that is not a descriptor")
    return found


def feature_columns(df: DataFrame, targets: Iterable[str], reserved: Iterable[str] = ("control",)) -> list[str]:
    excluded = set(targets) | set(reserved)
    return [c for c in df.columns if c not in excluded]


def drop_ids(df: DataFrame, ids: Iterable[str] = V.ID_COLUMNS) -> DataFrame:
    lowered = set(ids)
    return df.drop(*[c for c in df.columns if c.lower() in lowered])


def mandated_selection(
    columns: Sequence[str], numeric: Sequence[str], groups: Sequence[Sequence[str]] = V.MANDATED_GROUPS
) -> tuple[list[str], list[str]]:
    """Columns to keep (in table order) and the first alias of every group that has no column."""
    by_lower: dict[str, str] = {}
    for name in columns:
        by_lower.setdefault(name.lower(), name)
    picked, missing = set(), []
    for group in groups:
        hit = next((by_lower[a] for a in group if a in by_lower), None)
        if hit is None:
            missing.append(group[0])
        else:
            picked.add(hit)
    kept = [c for c in columns if c in picked] or list(numeric[:2])
    return kept, missing


def apply_selection(df: DataFrame, selected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    if not selected:
        raise ValueError("no selection has been fitted")
    present = [c for c in selected if c in df.columns]
    if not present:
        raise ValueError(f"none of the selected features {list(selected)} is in the data")
    return df.select(*[col(c) for c in [*keep, *present]])


def prediction_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_Prediction")]


def place_first(df: DataFrame, *names: str) -> DataFrame:
    front = [c for c in names if c in df.columns]
    return df.select(*[col(c) for c in front + [c for c in df.columns if c not in front]])


def tag(df: DataFrame, organism: str = "Pichia kudriavzevii", **extra: object) -> DataFrame:
    """Experiment metadata as constant columns."""
    return df.withColumns({"Organism": F.lit(organism), **{k: F.lit(v) for k, v in extra.items()}})


def label_of(name: str) -> V.Label:
    for label in V.COLUMN_LABELS:
        if name.lower() in label.aliases:
            return label
    return V.Label((name.lower(),), name.replace("_", " "), None)


def with_labels(df: DataFrame) -> DataFrame:
    """Attach display text, number format and range to each column as metadata."""
    for name in df.columns:
        label = label_of(name)
        info = {"label": label.text, "format": label.fmt, "low": label.low, "high": label.high}
        df = df.withMetadata(name, {k: v for k, v in info.items() if v is not None})
    return df


def range_violations(df: DataFrame) -> DataFrame:
    """Rows in which a labelled column lies outside its allowed range."""
    broken = F.lit(False)
    for name in df.columns:
        label = label_of(name)
        if label.low is not None and label.high is not None:
            broken = broken | F.coalesce(~col(name).between(label.low, label.high), F.lit(False))
    return df.where(broken)


def add_constant(df: DataFrame, name: str, value: float = 0.0) -> DataFrame:
    """Add a column only when the name is new and not empty."""
    return df if not name or name in df.columns else df.withColumn(name, F.lit(value))


def repair_suffixes(df: DataFrame) -> DataFrame:
    """Fold X_x and X_y left behind by an overlapping merge into one X, left value first."""
    out = df
    for name in df.columns:
        base = name[:-2]
        if name.endswith("_x") and base + "_y" in df.columns:
            out = out.withColumn(base, F.coalesce(col(name), col(base + "_y"))).drop(name, base + "_y")
    return out


def without_controls(df: DataFrame, column: str, word: str = "control") -> DataFrame:
    """Drop rows whose name contains the word in any case; a missing name is kept."""
    return df.where(~F.coalesce(F.contains(F.lower(col(column)), F.lit(word)), F.lit(False)))
