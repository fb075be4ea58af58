"""Ratings, products and vectors derived from the driver's parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.events import encoded

VECTOR_DIMS = 5
# Values of an embedding; value i is added into component i mod VECTOR_DIMS.
EMBEDDING_DIMS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_of(stamp: str):
    # The tables hold zone-less times that mean UTC; their fields do not depend on the session.
    day = F.unix_date(F.col(stamp).cast("date")).cast("bigint")
    return day * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per order line: customer, part, quantity as 0.5..5.0 stars, order time."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_of("o_orderdate").alias("timestamp"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    words = F.replace("p_name", F.lit(" "), F.lit("|"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit("").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", "p_brand", "p_type", words).alias("tags"),
    )


def item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(id, v): an item's whole embedding folded to five components, in the place of rank-5 item
    factors."""
    wide = F.col("embedding").cast("array<double>")
    folded = [
        reduce(Column.__add__, [F.get(wide, F.lit(i)) for i in range(r, EMBEDDING_DIMS, VECTOR_DIMS)])
        for r in range(VECTOR_DIMS)
    ]
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.array(*folded).alias("v")
    )


def user_vectors(rated: DataFrame, items: DataFrame) -> DataFrame:
    """(id, v): the score-weighted mean of the vectors a user rated, as user factors."""
    weighted = rated.join(items, F.col("productId") == F.col("id"))
    parts = [
        F.avg(F.col("score") * F.get("v", F.lit(i))).alias(f"v{i}") for i in range(VECTOR_DIMS)
    ]
    return (
        weighted.groupBy("userId")
        .agg(*parts)
        .select(
            F.col("userId").alias("id"),
            F.array(*[f"v{i}" for i in range(VECTOR_DIMS)]).alias("v"),
        )
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value): an application log, one line per rating and one per unrelated event."""
    rated = encoded(ratings(spark, folder)).select(
        F.concat(F.lit("INFO --- [exec] rest.ProductApi : "), "value").alias("value")
    )
    other = table(spark, folder, "events").select(
        F.concat_ws(" ", F.lit("INFO --- [exec] user"), "user_id", "event_type").alias("value")
    )
    return rated.unionByName(other)


