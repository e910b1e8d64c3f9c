"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.functions.exprs import col, local_stamp
from assaysieve.functions.vocabulary import NULL_TEXTS
from assaysieve.operators.roles import name_entity_column, nan_as_null


def csv_encodings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of a path by encoding: UTF-16 by its byte-order mark, UTF-8 if every byte sequence is valid, else Latin-1.

    One pass of the executors over all files; the driver gets one row per file, as the reader's own listing does.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    marked = F.hex(F.substring(F.col("value").cast("binary"), 1, 2)).isin("FFFE", "FEFF")
    files = lines.groupBy("file").agg(F.bool_or(marked).alias("marked"), F.bool_and(F.is_valid_utf8("value")).alias("valid")).collect()
    found: dict[str, list[str]] = {}
    for f in sorted(files, key=lambda r: r["file"]):
        found.setdefault("UTF-16" if f["marked"] else "UTF-8" if f["valid"] else "ISO-8859-1", []).append(unquote(f["file"]))
    return found


def _without_null_texts(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.when(~col(c).isin(*NULL_TEXTS), col(c)).alias(c) if c in texts else col(c) for c in df.columns])


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, encoding: str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with header. A declared schema saves the inference pass; missing-value texts become NULL either way.

    Each file is read in its own encoding unless one is given. Files with line breaks inside quotes need multi_line, which reads
    each file in one task, as does UTF-16.
    """
    groups = {encoding: [path]} if encoding else csv_encodings(spark, path) or {"UTF-8": [path]}
    parts = []
    for name, files in groups.items():
        reader = (
            spark.read.option("header", True).option("escape", '"').option("encoding", name)
            .option("multiLine", multi_line or name == "UTF-16").option("nullValue", "").option("nanValue", "NaN")
        )
        parts.append((reader if schema is None else reader.schema(schema)).csv(files))
    table = _without_null_texts(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))
    return _infer(table) if schema is None else nan_as_null(table)


# The texts each inferred type accepts.
TEXT_FORMS = {
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": "^(True|TRUE|true|False|FALSE|false)$",
}


def _infer(text: DataFrame) -> DataFrame:
    """Give each text column the first type of TEXT_FORMS that all its values have, in one pass."""
    def typed(c: str, kind: str):
        return F.when(F.rlike(F.btrim(col(c)), F.lit(TEXT_FORMS[kind])), F.btrim(col(c)).try_cast(kind))

    checks = [F.count(col(c)).alias(f"{i}_n") for i, c in enumerate(text.columns)]
    checks += [F.count(typed(c, kind)).alias(f"{i}_{kind}") for i, c in enumerate(text.columns) for kind in TEXT_FORMS]
    seen = text.agg(*checks).first()
    out = []
    for i, c in enumerate(text.columns):
        fits = [kind for kind in TEXT_FORMS if seen[f"{i}_n"] and seen[f"{i}_{kind}"] == seen[f"{i}_n"]]
        out.append(typed(c, fits[0]).alias(c) if fits else col(c))
    return nan_as_null(text.select(*out))


def load_experiment(spark: SparkSession, source: str | DataFrame, **options) -> DataFrame:
    """Experiment table from a CSV path or a DataFrame, with its entity column named solvent_name."""
    df = source if isinstance(source, DataFrame) else read_csv(spark, source, **options)
    return name_entity_column(nan_as_null(df))


def blank_experiment(spark: SparkSession, targets: Sequence[str] = ("glucose_uptake", "substrate_conversion")) -> DataFrame:
    """Empty experiment table that carries the schema to be filled by hand."""
    return spark.createDataFrame([], "solvent_name string, " + ", ".join(f"`{t}` double" for t in targets))


# The sample experiment offered to try the screens out.
SAMPLE = (("Water", 95, 71), ("Ethanol", 40, 55), ("Hexane", 5, 12), ("Toluene", 2, 3))


def sample_experiment(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLE), "solvent_name string, glucose_uptake bigint, substrate_conversion bigint")


def load_catalogue(spark: SparkSession, path: str, name: str = "Solvent_Name", to: str = "solvent_name", **options) -> DataFrame:
    """Catalogue from Parquet or CSV with its name column renamed."""
    df = read_csv(spark, path, **options) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    return nan_as_null(df).withColumnRenamed(name, to)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def report_table(df: DataFrame, name: str = "solvent_name") -> DataFrame:
    """Report columns as text: the name, predictions and compatibility, with readable headings."""
    chosen = [c for c in df.columns if "Prediction" in c or "Compatibility" in c or c == name]
    return df.select(*[
        F.coalesce(col(c).cast("string"), F.lit("nan")).alias(c.replace("_Prediction", "").replace("_", " ")) for c in chosen
    ])


def with_report_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("generated_on", local_stamp())
