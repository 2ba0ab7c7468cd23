"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns ``a``, ``b``: long); a
    component is named by its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each round
    hooks nodes to the smallest node they see, in one aggregate and one join per step;
    rounds grow with the logarithm of the size.  A node's neighbours are never gathered
    in one row, so a hub only adds rows that partial aggregation and skew-join
    splitting spread."""
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour is hooked to the smallest of all
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stored(both.filter("b > a").join(low, "a")
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        # small star: the node and its smaller neighbours are hooked to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "small")
        last, mark = mark, now.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
