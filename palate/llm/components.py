"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.sources.staging import stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) for every node of edges (a, b).

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours. Each is a grouped minimum, aggregated before the
    shuffle, and one join; every round is written, so a lost executor costs one round at most.
    The number of rounds grows with the logarithm of the component size. Self-loops and nulls
    are ignored, repeated and reversed edges count once.
    """

    def canonical(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = stage(canonical(edges), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large step: larger neighbours of a node go to its smallest neighbour
        large = stage(canonical(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), "edges")
        # small step: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stage(canonical(handed.union(least.select("a", F.col("m").alias("b")))), "edges")
        # a star forest: no smaller end of an edge is the larger end of another, each node has one edge
        parents = small.select(F.col("b").alias("p")).distinct()
        chained = small.join(parents, F.col("a") == F.col("p"), "left_semi").limit(1).count()
        doubled = small.groupBy("a").count().filter("count > 1").limit(1).count()
        edges = small
        if not chained and not doubled:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("a")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select(F.col("a").alias("node"), F.col("a").alias("component")))
