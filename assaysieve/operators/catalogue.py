"""Name resolution and gap filling against a catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.functions import vocabulary as V
from assaysieve.functions.exprs import col, lookup_key, strip, substitute
from assaysieve.operators.skew import fits_broadcast, hot_hashes, lookup_join

SYNONYMS = ("solvent_name", "IUPACName", "PubChem_CommonName")
_KEY = "_lookup_key"


def row_order(df: DataFrame) -> Column:
    """The order of rows as they lie in their files: by file name, place of the block, and place in it.

    Numbers of partitions alone do not tell, as Spark reads large files first. A frame that does not come straight from files is taken as it is.
    """
    here = F.monotonically_increasing_id()
    placed = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), here)
    try:
        df.select(placed)
    except AnalysisException:
        return here
    return placed


def catalogue_keys(catalogue: DataFrame, synonyms: Sequence[str], order: Column | None, values: Sequence[str]) -> DataFrame:
    """One row per distinct lower-case synonym, holding the first catalogue row that carries it.

    Every synonym becomes its own key, so that the lookup is one equi-join instead of an OR over three columns.
    """
    names = F.array(*[F.lower(col(s)) for s in synonyms if s in catalogue.columns])
    row = F.struct(*[col(v).alias(f"v{i}") for i, v in enumerate(values)])
    order = row_order(catalogue) if order is None else order
    return (
        catalogue.select(F.explode(F.array_distinct(names)).alias(_KEY), order.alias("_order"), row.alias("_row"))
        .where(F.col(_KEY).isNotNull())
        .groupBy(_KEY)
        .agg(F.min_by("_row", "_order").alias("_row"))
    )


def lookup(
    df: DataFrame,
    catalogue: DataFrame,
    name: str = "solvent_name",
    synonyms: Sequence[str] = SYNONYMS,
    order: Column | None = None,
    aliases: Mapping[str, str] = V.ENTITY_ALIASES,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Fill descriptor cells of named entities from the catalogue. The caller's own values win."""
    values = list(values) if values is not None else [c for c in catalogue.columns if c != name]
    keys = catalogue_keys(catalogue, synonyms, order, values)
    keyed = df.withColumn(_KEY, substitute(lookup_key(name), dict(aliases)))
    joined = lookup_join(keyed, keys, [_KEY])
    found = {v: F.col("_row")[f"v{i}"] for i, v in enumerate(values)}
    filled = [F.coalesce(col(c), found[c]).alias(c) if c in found else col(c) for c in df.columns]
    added = [found[v].alias(v) for v in values if v not in df.columns]
    return joined.select(*filled, *added)


def synonym_attribute(
    names: DataFrame, catalogue: DataFrame, attribute: str, name: str = "solvent_name", **options
) -> DataFrame:
    """Normalised name and one catalogue attribute, for the names that resolve to a value."""
    wanted = names.select(lookup_key(name).alias("name_key")).distinct()
    found = lookup(wanted, catalogue, "name_key", values=[attribute], **options)
    return found.where(col(attribute).isNotNull()).select("name_key", col(attribute))


def attach_attribute(df: DataFrame, attributes: DataFrame, attribute: str, to: str, name: str = "solvent_name") -> DataFrame:
    """Attach an attribute by normalised name. The attribute frame holds one row per name_key."""
    source = attributes.select("name_key", col(attribute).alias(to))
    return lookup_join(df.withColumn("name_key", lookup_key(name)), source, ["name_key"]).drop("name_key")


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """First row per key in the given order, combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    rows = df.select(col(key), F.struct(*[col(c) for c in rest]).alias("_r"), order.alias("_order"))
    return rows.groupBy(col(key)).agg(F.min_by("_r", "_order").alias("_r")).select(col(key), "_r.*")


def fill_gaps(left: DataFrame, right: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Union of rows and columns of both frames; left values win, right fills what is missing.

    The right side is reduced to one row per key, the first in the given order, and kept, as it is measured before it
    is joined. A small right side, or hot keys on the left, call for a left join plus the right rows without a
    partner: Spark can neither broadcast nor split a full outer join.
    """
    source = first_per_key(right, key, row_order(right) if order is None else order)
    extra = [c for c in source.columns if c != key]
    renamed = source.select(col(key), *[col(c).alias("_r_" + c) for c in extra]).persist()
    filled = [F.coalesce(col(c), col("_r_" + c)).alias(c) if c in extra else col(c) for c in left.columns]
    added = [col("_r_" + c).alias(c) for c in extra if c not in left.columns]
    if not fits_broadcast(renamed) and not hot_hashes(left, [key]):
        return left.join(renamed, [key], "full_outer").select(*filled, *added)
    matched = lookup_join(left, renamed, [key]).select(*filled, *added)
    unmatched = renamed.join(left.select(col(key)).distinct(), [key], "left_anti")
    return matched.unionByName(unmatched.select(col(key), *[col("_r_" + c).alias(c) for c in extra]), allowMissingColumns=True)


def refresh_missing(df: DataFrame, fetched: DataFrame, key: str, missing: str) -> DataFrame:
    """Overwrite rows in which one column is missing with non-null fetched values, matched by key.

    Only columns the frame already has are refreshed. Of several fetched rows of a key the first counts.
    """
    shared = [c for c in fetched.columns if c != key and c in df.columns]
    renamed = first_per_key(fetched, key, row_order(fetched)).select(col(key), *[col(c).alias("_f_" + c) for c in shared])
    stale = df.where(col(missing).isNull())
    fresh = lookup_join(stale, renamed, [key]).select(
        *[F.coalesce(col("_f_" + c), col(c)).alias(c) if c in shared else col(c) for c in df.columns]
    )
    return df.where(col(missing).isNotNull()).unionByName(fresh)


def conform(df: DataFrame, schema: Sequence[tuple[str, str]], mode: str = "append") -> DataFrame:
    """Bring a frame to a schema: absent columns become typed NULLs; order is the frame's own columns first
    ("append") or the schema's alone ("strict")."""
    types = dict(schema)
    own = list(df.columns)
    names = own + [n for n in types if n not in own] if mode == "append" else list(types)
    return df.select(*[col(n) if n in own else F.lit(None).cast(types[n]).alias(n) for n in names])


def merge_smiles(df: DataFrame, variants: Sequence[str] = ("SMILES", "IsomericSMILES", "smiles")) -> DataFrame:
    """One SMILES column from its spellings, blank where none has a value."""
    present = [v for v in variants if v in df.columns]
    merged = F.coalesce(*[col(v) for v in present], F.lit(""))
    return df.select(*[col(c) for c in df.columns if c not in present], merged.alias("SMILES"))


def split_resolved(df: DataFrame, identifier: str = "SMILES") -> tuple[DataFrame, DataFrame]:
    """Rows with an identifier and rows without one."""
    known = F.coalesce(col(identifier), F.lit("")) != ""
    return df.where(known), df.where(~known)


def failed_lookups(df: DataFrame, identifier: str = "SMILES") -> DataFrame:
    blank = F.coalesce(strip(identifier), F.lit("")) == ""
    return df.agg(F.count("*").alias("total"), F.count_if(blank).alias("failed"))


def curated_names(names: DataFrame, name: str = "solvent_name") -> DataFrame:
    """Distinct names in ascending order."""
    return names.select(col(name)).where(col(name).isNotNull()).distinct().orderBy(col(name))


def align_for_inference(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fill: float | Mapping[str, float] = 0.0
) -> DataFrame:
    """Add absent training columns, then fill: numbers with one value or a value per column, text with "Unknown"."""
    def number(c: str) -> Column:
        default = F.lit(float(fill.get(c, 0.0) if isinstance(fill, Mapping) else fill))
        return F.coalesce(col(c).cast("double"), default) if c in df.columns else default

    def text(c: str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit("Unknown")) if c in df.columns else F.lit("Unknown")

    return df.withColumns({**{c: number(c) for c in numeric}, **{c: text(c) for c in categorical}})


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The given columns in order, zero where the frame lacks one."""
    return df.select(
        *[col(c) for c in keep], *[col(c).cast("double").alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in columns]
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many."""
    counts = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [col(c) for c in df.columns], "column", "missing").where("missing > 0")


def missing_ratio(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Aggregate expression: share of missing cells."""
    names = list(columns) if columns is not None else df.columns
    if not names:
        return F.lit(0.0)
    gaps = sum((F.count_if(col(c).isNull()) for c in names[1:]), F.count_if(col(names[0]).isNull()))
    return F.coalesce(F.try_divide(gaps.cast("double"), (F.count("*") * len(names)).cast("double")), F.lit(0.0))
