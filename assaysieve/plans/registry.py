"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(job: Query) -> Query:
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# Parts as measured entities: four descriptors and two targets per part, from its order lines. Percentages are
# summed as integers, so that both engines divide the same numbers.
LINES_SQL = """
lines AS (
  SELECT l_partkey, sum(l_quantity) / count(*) AS qty,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) AS tax_pct,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS discount_pct,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 100 ELSE 0 END) AS DOUBLE) / count(*) AS return_pct
  FROM lineitem GROUP BY l_partkey)"""
PARTS_SQL = LINES_SQL + """,
train AS (
  SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price,
         qty, tax_pct, discount_pct, return_pct
  FROM part JOIN lines ON l_partkey = p_partkey)"""
FEATURES = ["size", "price", "qty", "tax_pct"]
TARGETS = ["discount_pct", "return_pct"]


def part_lines(spark: SparkSession, folder: str) -> DataFrame:
    def mean(c):
        return F.sum(c).cast("double") / F.count("*")

    return table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        mean(F.col("l_quantity")).alias("qty"),
        mean(F.round(F.col("l_tax") * 100).cast("bigint")).alias("tax_pct"),
        mean(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount_pct"),
        mean(F.when(F.col("l_returnflag") == "R", 100).otherwise(0)).alias("return_pct"),
    )


def parts(spark: SparkSession, folder: str, how: str = "inner") -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")
    )
    lines = part_lines(spark, folder)
    return part.join(lines, part.p_partkey == lines.l_partkey, how).drop("l_partkey")


# Documents as a library, some of them measured: the labels are the measurements.
DOCS_SQL = """
library AS (
  SELECT doc_id, 'doc ' || CAST(doc_id AS VARCHAR) AS entity, lang,
         CASE WHEN lang <> 'de' THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS blanks,
         CAST(n_chars AS DOUBLE) AS chars
  FROM documents),
measured AS (
  SELECT l.*, m.quality * CAST(100 AS DOUBLE) AS quality_pct, (1 - m.toxic) * CAST(100 AS DOUBLE) AS clean_pct
  FROM library l JOIN labels m USING (doc_id))"""


def doc_library(spark: SparkSession, folder: str) -> DataFrame:
    blanks = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double")
    return table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("entity"), "lang",
        F.when(F.col("lang") != "de", blanks).alias("blanks"), F.col("n_chars").cast("double").alias("chars"),
    )


def doc_measured(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(
        "doc_id", (F.col("quality") * 100.0).alias("quality_pct"), ((1 - F.col("toxic")) * 100.0).alias("clean_pct")
    )
    return doc_library(spark, folder).join(labels, "doc_id")


DOC_TARGETS = ["quality_pct", "clean_pct"]
