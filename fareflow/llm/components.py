"""Connected components of a link table, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import discard, materialize

#: A healthy run needs a round or two per doubling of the longest path; this many means a fault.
MAX_ROUNDS = 64


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every node of a link its component's smallest node.

    Each round alternates two steps.  *Large star*: every node hands its larger
    neighbours to its smallest.  *Small star*: every node hands its smaller
    neighbours and itself to the smallest of them.  Both keep components as they
    are, and the links end as one star around each smallest node.  Minima are
    combined before the shuffle, no neighbour list is ever gathered, and each
    round is written to the shared folder, in place of the one before.  NULL ends and loops are ignored, so
    an empty link table gives an empty result.
    """
    edges = (
        links.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = materialize(edges, "links")
    before = None
    for _ in range(MAX_ROUNDS):
        last, edges = edges, materialize(_small_star(_large_star(edges)), "links")
        discard(last)
        state = edges.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(a, b) as decimal(38, 0))"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
    raise RuntimeError("the links do not settle")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("of"), F.least("a", "low").alias("low"))
    moved = edges.join(least, edges["b"] == least["of"]).select("a", F.col("low").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "of")
    moved = edges.join(least, edges["a"] == least["of"]).select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = least.select(F.col("of").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()
