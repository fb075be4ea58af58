"""Labelled rows for the classifiers: who may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Labelled documents that a classifier is fitted on, at most.
TRAIN_ROWS = 12_000
# Bytes of their texts, at most.
TRAIN_BYTES = 64 << 20


def held_out(key: Column) -> Column:
    """Rows that are never learned from: a third, by the key's checksum. A null key is not."""
    checksum = F.crc32(key.cast("string").cast("binary"))
    return F.coalesce(checksum % 3 == 1, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents that are not held out, with at most
    ``most_bytes`` of text in all.

    Labelled documents are taken by the hash of their key, the smallest first, until either bound
    is reached; texts of more than a 64th of the bytes are not taken. Null labels and keys count as
    unlabelled, labels without a document do not count. Of repeated labels of a key, the larger one
    counts; of repeated documents of a key, one with the smallest hash of its text.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .where(~held_out(F.col(key)))
        .groupBy(F.col(key).alias("known_key")).agg(F.max(label).cast("double").alias("label"))
    )
    found = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    sized = found.where(F.col("key").isNotNull()).select(
        "key", F.xxhash64("text").alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"),
    ).where(F.col("size") <= most_bytes // 64)
    first = (
        sized.join(known, F.col("key") == F.col("known_key"))
        .groupBy("known_key", "label").agg(F.min(F.struct("digest", "size")).alias("first"))
        .orderBy(F.xxhash64("known_key"), "known_key").limit(rows)
    )
    # One task adds up the sizes of the ``rows`` documents.
    before = Window.orderBy(F.xxhash64("known_key"), "known_key").rowsBetween(
        Window.unboundedPreceding, 0
    )
    chosen = first.withColumn("total", F.sum("first.size").over(before)).where(
        F.col("total") <= most_bytes
    ).select("known_key", "label", F.col("first.digest").alias("known_digest"))
    # It has ``rows`` rows at most.
    same = (F.col("key") == F.col("known_key")) & (F.xxhash64("text") == F.col("known_digest"))
    copies = Window.partitionBy("known_key").orderBy("known_key")
    return (
        found.join(F.broadcast(chosen), same)
        .withColumn("copy", F.row_number().over(copies)).where("copy = 1")
        .select("text", "label")
    )
