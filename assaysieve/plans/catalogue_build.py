"""Build the catalogue from curated names and landed property responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.functions import vocabulary as V
from assaysieve.functions.exprs import heavy_atoms
from assaysieve.operators.catalogue import conform, curated_names, failed_lookups, fill_gaps, lookup, merge_smiles, refresh_missing, split_resolved
from assaysieve.sources.responses import latest_attempts, parse_properties, route


def enrich(df: DataFrame, landed: DataFrame, name: str = "solvent_name") -> DataFrame:
    """Fill descriptor gaps of named entities from landed responses; the frame's own values win."""
    accepted, _ = route(latest_attempts(landed))
    properties = parse_properties(accepted).withColumnRenamed("entity", name)
    described = properties.withColumn("Heavy_Atom_Count", F.when(F.col("SMILES") != "", heavy_atoms("SMILES").cast("double")))
    known = described.join(df.select(name).distinct(), [name], "left_semi")
    return fill_gaps(df, known, name, F.lit(0))


def build_catalogue(
    names: DataFrame, landed: DataFrame, name: str = "solvent_name", schema: Sequence[tuple[str, str]] = V.MASTER_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """The catalogue in master column order, and how many names were looked up and failed."""
    enriched = enrich(curated_names(names, name), landed, name).withColumnRenamed(name, schema[0][0]).persist()
    catalogue = conform(enriched, schema, "strict").orderBy(schema[0][0])
    return catalogue, failed_lookups(catalogue)


def names_to_library(
    names: DataFrame, catalogue: DataFrame, landed: DataFrame | None = None, name: str = "solvent_name",
    schema: Sequence[tuple[str, str]] = V.MASTER_SCHEMA, missing: str = "Molecular_Weight", **options
) -> tuple[DataFrame, DataFrame]:
    """Names as a library that can be screened, and the names that stay without an identifier.

    Descriptors come from the catalogue; where the weight is missing, from landed responses. Spellings of the identifier become one column,
    and columns of the schema that are absent become NULL.
    """
    found = lookup(names, catalogue, name, **options)
    if landed is not None:
        accepted, _ = route(latest_attempts(landed))
        found = refresh_missing(found, parse_properties(accepted).withColumnRenamed("entity", name), name, missing)
    wanted = [(n, t) for n, t in schema if n != schema[0][0]]
    ready, unresolved = split_resolved(conform(merge_smiles(found), wanted))
    return ready, unresolved.select(name)
