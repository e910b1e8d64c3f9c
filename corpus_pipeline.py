"""A corpus pipeline: five stages that turn raw documents into tokens, each over all its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysieve.llm import bpe, decontaminate, quality, queries, secrets, simhash
from assaysieve.session import delete_paths, scratch_path


def _sized(documents: DataFrame) -> DataFrame:
    """Bring the number of characters in line with a changed text, where there is such a column."""
    return documents.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in documents.columns else documents


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents judged bad or toxic; the classifier is fitted on the labels."""
    judged = quality.classify(docs, queries.table(spark, sf_dir, "labels"), out="_verdict")
    return judged.where("_verdict.kept").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one of smallest id."""
    return simhash.deduplicate(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages, and drop documents that are mostly such."""
    return _sized(decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of each secret in its place."""
    return _sized(secrets.mask(docs))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the digest of what they decode to; the texts themselves are left behind."""
    coded = bpe.encode(docs, queries.VOCABULARY, out="_tokens").select(
        "doc_id", "lang", "source", F.col("_tokens.n_tokens").alias("n_tokens"), F.col("_tokens.ids").alias("token_ids"))
    decoded = bpe.decode(coded, queries.VOCABULARY, "token_ids", "_decoded")
    return decoded.withColumn("decoded_sha256", F.sha2("_decoded", 256)).drop("_decoded")


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", clean_of_benchmarks),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", tokenized),
]
# The stages are learned, iterative or tokenizers: SQL cannot express them. Tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared scratch folder and read again by the next."""
    docs, before = queries.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        delete_paths(spark, before)  # the stage that read it is written
        docs, before = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
