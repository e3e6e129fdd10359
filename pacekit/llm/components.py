"""Connected components by alternating large-star and small-star rounds.

Each round is two minimum aggregations (combined on the map side) and two
equi-joins, which Spark splits when a node is hot; no neighbour list is ever
collected. Rounds are written to the shared folder, so a lost executor only
costs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacekit.llm.common import stored


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of long ids -> (id, root): the smallest id reachable, for every id on an edge."""
    u, v = edges.columns
    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u > v").distinct()
    e = stored(e, "components")
    before = _state(e)
    while before[0]:
        # large star: everything above a node moves to the smallest node around it
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        low = low.select("n", F.least("n", "m").alias("m"))
        up = e.select(F.col("u").alias("x"), F.col("v").alias("n")).join(low, "n").select(
            F.col("x").alias("u"), F.col("m").alias("v"))
        e = stored(up.distinct(), "components")
        # small star: the nodes below a node, and the node, move to the smallest of them
        low = e.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        down = e.select(F.col("u").alias("n"), "v").join(low, "n")
        e = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select(F.col("n").alias("u"), F.col("m").alias("v"))).filter("u > v")
        e = stored(e.distinct(), "components")
        after = _state(e)
        if after == before:
            break
        before = after
    ids = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return ids.unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
