"""Entity lists to be screened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, strip


def split_list(df: DataFrame, column: str, keep: Sequence[str] = (), delimiter: str = ",", to: str = "solvent_name") -> DataFrame:
    """One row per non-empty trimmed piece of a delimited text, with its position in the text."""
    pieces = F.split(col(column), "\\Q" + delimiter + "\\E")
    return (
        df.select(*[col(c) for c in keep], F.posexplode(pieces).alias("position", "piece"))
        .select(*[col(c) for c in keep], "position", strip("piece").alias(to))
        .where(F.length(to) > 0)
    )


def whole_library(catalogue: DataFrame, name: str = "solvent_name") -> DataFrame:
    """Distinct catalogue names, trimmed, without blanks. Only the name column is read."""
    names = catalogue.select(col(name)).dropna().distinct()
    return names.select(strip(name).alias(name)).where(F.length(name) > 0)
