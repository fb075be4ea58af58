"""Popularity statistics over the ratings table.

Each one is a partial aggregation, one shuffle on the grouping key and a final aggregation, so a
product that holds a large part of all ratings is already reduced to one row per input task.
Order is applied when a list is read, not before it is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import epoch_seconds, year_month
from shelfwise.functions.scalar import register_sql_functions


def rate_more(ratings: DataFrame) -> DataFrame:
    """Number of ratings per product."""
    return ratings.groupBy("productId").agg(F.count("productId").alias("count"))


def rate_more_recently(ratings: DataFrame, zone: str = "UTC") -> DataFrame:
    """Number of ratings per product and month."""
    month = year_month(epoch_seconds(F.col("timestamp")), zone).alias("yearmonth")
    return (
        ratings.select("productId", month)
        .groupBy("yearmonth", "productId")
        .agg(F.count("productId").alias("count"))
        .select("productId", "count", "yearmonth")
    )


def averages(ratings: DataFrame) -> DataFrame:
    """Mean score per product."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def most_rated(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` products with most ratings, as (productId, rank)."""
    top = counts.orderBy(F.desc("count"), "productId").limit(n)
    return _numbered(top, [F.desc("count"), F.asc("productId")])


def hot(monthly: DataFrame, n: int) -> DataFrame:
    """The ``n`` products of the latest months, as (productId, rank); each product once."""
    latest = monthly.groupBy("productId").agg(
        F.max(F.struct("yearmonth", "count")).alias("best")
    )
    order = [F.desc("best.yearmonth"), F.desc("best.count"), F.asc("productId")]
    return _numbered(latest.orderBy(*order).limit(n), order)


def best_average(means: DataFrame) -> DataFrame:
    """All products by mean score, best first; a range-partitioned sort, not one task."""
    return means.orderBy(F.desc("avg"), "productId")


def _numbered(top: DataFrame, order: list) -> DataFrame:
    # ``top`` holds at most the n rows of a limit, so one sorted array of it is small.
    return top.select("productId", F.row_number().over(Window.orderBy(*order)).alias("rank"))


def register_views(ratings: DataFrame, prefix: str = "") -> None:
    """Registers ``ratings`` and ``ratingOfMonth``, with a prefix, for use from SQL text."""
    spark = ratings.sparkSession
    register_sql_functions(spark)
    ratings.createOrReplaceTempView(f"{prefix}ratings")
    ratings.select(
        "productId", "score", year_month(epoch_seconds(F.col("timestamp"))).alias("yearmonth")
    ).createOrReplaceTempView(f"{prefix}ratingOfMonth")
