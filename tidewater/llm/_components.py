"""Connected components with DataFrame operations only.

Edges are rewired until every tree is a star: each node hands its larger
neighbours, then its smaller ones, to the smallest node it knows. Both steps are
a minimum by key (combined before the shuffle) and a join on that key, so a
node with a third of all edges is pre-aggregated, and its join rows are the kind
that adaptive skew handling splits. Nothing but the edge count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._scratch import settle

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``: the smallest node that can be reached.

    Loops, nulls and repeated edges are allowed. Nodes without an edge to
    another node are not in the result. Rounds grow with the logarithm of
    the longest chain.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = settle(e)
    size = e.count()
    if size == 0:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(MOST_ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # larger neighbours of a node go to the smallest it knows
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # a node goes to its smallest neighbour, and so do its other neighbours
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        small = settle(small)
        stars = small.join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count() == 0
        e = small
        if stars and small.groupBy("a").count().where("count > 1").limit(1).count() == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
