"""Connected components of a graph that is a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.session import checkpointable


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _to_least(links: DataFrame, upwards: bool) -> DataFrame:
    """Hang neighbours on each node's least neighbour: the larger ones (upwards), or the smaller ones and the node itself.

    Least neighbours come from partial sums per task; the join with them is one that adaptive execution can split at hot nodes.
    """
    if upwards:
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        least = ends.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low"))
        moved = ends.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        moved = links.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                                                                F.struct(F.col("a").alias("a"), F.col("low").alias("b")))).alias("l")).select("l.*")
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and its `component` (the least node reachable) for every node of the links `a`, `b` but the least ones.

    Links to the node itself and repeated links change nothing. Rounds go on until no link moves; their number grows with the
    logarithm of the nodes. Each round's links are checkpointed, so that a lost executor repeats one round at most.
    """
    checkpointable(links.sparkSession)
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct().checkpoint()
    before, state = None, _state(now)
    while state != before and state[0]:
        now = _to_least(_to_least(now, upwards=True), upwards=False).checkpoint()
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
