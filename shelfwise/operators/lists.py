"""Ranked lists: top-n per key, and the two shapes they are stored in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_SIZE = 1000


def ranked(df: DataFrame, key: str, order: list[Column], n: int | None = None) -> DataFrame:
    """Adds ``rank`` (1 = best) within ``key`` and keeps the first ``n``.

    With ``n``, Spark limits every input task to n rows per key before the shuffle, so a hot key
    brings n rows per task and not its whole group.
    """
    numbered = df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return numbered if n is None else numbered.where(F.col("rank") <= n)


def nested(listed: DataFrame, key: str, item: str, score: str = "score") -> DataFrame:
    """Ranked rows to one row per key with an ordered ``recs`` array.

    For lists of bounded length, i.e. after ``ranked(..., n)``.
    """
    return listed.groupBy(key).agg(_recs(item, score))


def nested_parts(
    listed: DataFrame, key: str, item: str, score: str = "score", part_size: int = PART_SIZE
) -> DataFrame:
    """Ranked rows to ordered arrays of at most ``part_size`` items, numbered by ``part``.

    For lists without a limit: no row grows with the catalogue, nothing is cut off.
    """
    part = F.floor((F.col("rank") - 1) / part_size).cast("int")
    return listed.withColumn("part", part).groupBy(key, "part").agg(_recs(item, score))


def _recs(item: str, score: str) -> Column:
    rows = F.sort_array(
        F.collect_list(
            F.struct("rank", F.col(item).alias("productId"), F.col(score).alias("score"))
        )
    )
    return F.transform(rows, lambda r: F.struct(r["productId"], r["score"])).alias("recs")


def flattened(
    lists: DataFrame, key: str, item: str = "productId", part_size: int = PART_SIZE
) -> DataFrame:
    """``recs`` arrays back to ranked rows (key, rank, item, score)."""
    first = F.col("part") * part_size if "part" in lists.columns else F.lit(0)
    return lists.select(F.col(key), first.alias("_first"), F.posexplode("recs")).select(
        key,
        (F.col("_first") + F.col("pos") + 1).alias("rank"),
        F.col("col.productId").alias(item),
        F.col("col.score").alias("score"),
    )


def blended(sources: list[DataFrame], n: int | None = None) -> DataFrame:
    """One list per user from several (userId, rank, productId) lists, first source first.

    A product named by several sources keeps its best (source, rank).
    """
    tagged = [
        df.select("userId", "productId", F.lit(i).alias("source"), "rank")
        for i, df in enumerate(sources)
    ]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other)
    best = rows.groupBy("userId", "productId").agg(
        F.min(F.struct("source", F.col("rank").alias("sourceRank"))).alias("best")
    )
    flat = best.select("userId", "productId", "best.source", "best.sourceRank")
    order = [F.asc("source"), F.asc("sourceRank"), F.asc("productId")]
    return ranked(flat, "userId", order, n)
