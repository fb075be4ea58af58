"""Connected components of an edge table, as a loop of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``): root is its smallest
    reachable node.

    Alternates two contractions: every node passes its larger neighbours to its smallest
    neighbour, then its smaller ones. The number of rounds grows with the logarithm of the
    component size. Each round is written to the shared folder, which also cuts the lineage.
    Self loops and nulls in either column are ignored, repeated edges count once.
    """
    now = staged(_ordered(edges), "edges")
    mark = _mark(now)
    while True:
        now = staged(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with the larger node first."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.where("b > a").join(least, "a")
    return _ordered(joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.union(least.select("a", F.col("m").alias("b"))))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))
    ).first()
    return tuple(row)
