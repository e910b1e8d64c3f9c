"""Small tables with the cases that every text operator must survive, and brute-force counterparts."""

import hashlib
import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names that operators use for columns of their own.
CLASHES = ["hits", "secrets", "tokens", "licences", "counts", "verdict", "main", "fingerprint", "component_id", "_text", "bucket", "node", "odds", "detected", "shares",
           "confidence", "kept", "declared", "suffix", "label", "quality", "count", "n", "a", "b"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1) + rng.choices("klmnrs", k=rng.randint(0, 2))) for _ in range(words))


def texts() -> list[tuple]:
    passage = prose(7, 60)
    rows = [
        (1, prose(1, 120)), (2, prose(1, 120)), (3, prose(1, 120) + " one more"), (4, prose(4, 30) + "\n" + passage + "\n" + prose(5, 30)),
        (5, passage + " tail"), (6, "lead " + passage), (7, ""), (8, None), (9, "word"), (10, "\t \n"), (11, prose(11, 49)), (12, prose(11, 49)), (13, prose(11, 50)),
        (14, prose(11, 50)), (15, "aa " * 300), (16, "aa " * 120), (17, "Ünï cödé 漢字  x y 😀 " * 20), (18, prose(18, 20_000)), (19, prose(18, 20_000) + " end"), (20, "x" * 50_000),
        (None, passage), (None, None), (4, prose(44, 80)), (9, "word"), (21, "a <|endoftext|> b"), (22, "All Rights Reserved. Licensed under CC BY-SA 4.0"),
        (23, 'password = "hunter2hunter2" and AKIA' + "Q" * 20 + " and " + "0123abcd" * 5),
    ]
    return [(i, t, ["en", "fr", None][n % 3], ["s0", None, "s1"][n % 3], None if t is None else len(t)) for n, (i, t) in enumerate(rows)]


def documents(spark, clashes: bool = False):
    df = spark.createDataFrame(texts(), DOCUMENTS).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(1) for c in CLASHES})
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 1, 0), (9, 0, 0), (15, 0, 1), (16, 0, 1), (None, 0, 1), (5, None, None), (15, 1, 0)],
                                 "doc_id bigint, quality int, toxic int")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def counted(rows) -> list:
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
