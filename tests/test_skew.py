import numpy as np
import pytest
from pyspark.sql import functions as F

from assaysieve.operators import skew


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one key, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(60_000).select("id", key.cast("int").alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_join_beyond_broadcast_equals_plain_join(spark, hot, how):
    right = spark.range(0, 4000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    split = skew.lookup_join(hot, right, ["k"], how, max_rows=10)
    plain = hot.join(right, ["k"], how)
    assert split.columns == plain.columns
    assert split.count() == plain.count()
    assert split.exceptAll(plain).count() == 0


def test_hot_keys_are_found_and_split(spark, hot):
    right = spark.range(0, 4000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    found = skew.hot_hashes(hot, ["k"])
    seven, missing = spark.range(1).select(F.xxhash64(F.lit(7)), F.xxhash64(F.lit(None).cast("int"))).first()
    assert set(found) == {seven, missing} and found[seven] >= 130
    dealt, repeated = skew.salted(hot, right, ["k"], found)
    largest = dealt.groupBy("k", skew.SALT).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 60_000 * skew.HOT_SHARE
    assert repeated.count() == 4000 - 1 + found[seven]


def test_small_right_side_is_broadcast(spark, hot):
    right = spark.range(0, 40).select(F.col("id").cast("int").alias("k"))
    assert skew.fits_broadcast(right)
    assert not skew.fits_broadcast(right, max_rows=39)
    assert not skew.fits_broadcast(right, max_bytes=10)


@pytest.mark.parametrize("limit", [100_000, 50])
def test_exact_quantiles(spark, limit):
    rng = np.random.default_rng(3)
    columns = {
        "normal": rng.normal(size=9000), "hot": np.where(rng.random(9000) < 0.4, 1.5, rng.normal(size=9000)),
        "few": rng.integers(-3, 3, 9000).astype(float), "edge": np.concatenate([np.full(4500, 2.0), rng.uniform(2, 3, 4500)]),
    }
    rows = list(zip(*[map(float, v) for v in columns.values()]))
    df = spark.createDataFrame(rows, list(columns)).repartition(7).withColumn("hole", F.when(F.col("normal") > 0, F.col("normal")))
    df = df.withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = skew.exact_quantiles(df, [*columns, "hole", "none"], probs, buffer_rows=limit)
    for name, values in columns.items():
        assert got[name] == pytest.approx(np.quantile(values, probs), abs=1e-12), name
    positive = columns["normal"][columns["normal"] > 0]
    assert got["hole"] == pytest.approx(np.quantile(positive, probs), abs=1e-12)
    assert got["none"] == [None] * 5


def test_exact_modes(spark):
    df = spark.createDataFrame([("b", None, "x"), ("a", None, "x"), ("b", None, None), ("a", None, "y")], "tie string, none string, m string")
    assert skew.exact_modes(df, ["tie", "none", "m"]) == {"tie": "a", "none": None, "m": "x"}
