"""Connected components of an edge table, without gathering neighbours of a node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strutwise.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge table; the root is the least node of its component.

    Alternates large stars and small stars: each node's neighbours are joined
    to the least of them, found by a grouped minimum (combined before the
    shuffle) and a join, until nothing changes. Loops and repeated edges are
    allowed; an empty table gives an empty result.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = stored(edges.select(high, low).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = _state(now)
        if state == seen or state[0] == 0:
            break
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "edges")
        small = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        onward = large.join(small, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(onward.unionByName(small.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
