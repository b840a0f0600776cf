"""Connected components of a graph given by its edges, as shuffled joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges written to the shared folder, and their number and digest, taken on the way."""
    seen = Observation()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")
    return materialize(edges.observe(seen, F.count("*").alias("n"), digest)), seen.get


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of an edge (a, b), root the least node of its component.

    Rounds of large stars (every greater neighbour is linked to the least one) and small
    stars (every lesser neighbour is), until the edges no longer change; about log2 of
    the longest path.  The least neighbour is an aggregate, so a node with many
    neighbours is never gathered in one place, and adaptive execution may split the
    joins.  Each round is written to the shared folder.
    """
    edges, before = _stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(least, "a")
        small = lower.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, after = _stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        if after == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
        before = after
    raise RuntimeError("the components did not settle")
