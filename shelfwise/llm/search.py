"""Ranked lexical search: term at a time, with a limit on new accumulators.

Every task scores its own documents for every item. An item's terms are taken rarest first. A
document gets an accumulator when one of the terms names it, until the terms that are left could
not lift a document without one to the k-th best partial score. From then on only documents that
have an accumulator are updated, and these to the end, so their scores are exact. A task hands on k
documents for each item, of which the best k overall are the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import slices, unlike, utf8
from shelfwise.session import staged

TOP = 10
# Length normalisation: the percentage of a document's length measure that follows its length.
LENGTH_PERCENT = 90
# Terms of the items that are searched together; they are sent to every task.
BLOCK_BYTES = 4 << 20
# Postings that a task scores together.
CHUNK_POSTINGS = 2 << 20

# Letters, digits and all bytes of longer characters belong to terms; A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order and with repeats."""
    return text.translate(_TERM_BYTES).split()


def _item_terms(items: DataFrame, text: str, key: str) -> DataFrame:
    """(item, key, terms): a number for each row of ``items``, and its distinct terms."""
    numbered = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = [sorted(set(terms(t))) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("key"),
                 pa.array(found, pa.list_(pa.binary()))],
                ["item", "key", "terms"],
            )

    kind = numbered.schema["key"].dataType.simpleString()
    return numbered.mapInArrow(run, f"item bigint, key {kind}, terms array<binary>")


def _postings(docs: DataFrame, text: str, key: str, vocabulary) -> DataFrame:
    """(key, n, terms, tf) of every document with a term: all its terms counted in n, and those of
    the vocabulary, a broadcast list, with their frequencies."""
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        place = {t: i for i, t in enumerate(vocabulary.value)}.get
        size = max(1, len(vocabulary.value))
        for batch in slices(batches, "text"):
            counts, owners, met = [], [], []
            for i, text in enumerate(utf8(batch, "text")):
                words = terms(text)
                known = [x for x in map(place, words) if x is not None]
                counts.append(len(words))
                owners.append(len(known))
                met += known
            owner = np.repeat(np.arange(len(counts)), owners)
            cells, tf = np.unique(owner * size + np.array(met, np.int64), return_counts=True)
            ends = np.searchsorted(cells // size, np.arange(len(counts) + 1)).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array((cells % size).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32))),
                ],
                ["key", "n", "terms", "tf"],
            )
            yield out.filter(pa.array(np.array(counts) > 0))

    kind = keyed.schema["key"].dataType.simpleString()
    return keyed.mapInArrow(run, f"key {kind}, n bigint, terms array<int>, tf array<int>")


def weight(documents: int, holding: int) -> int:
    """What a term counts that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The best ``k`` (score, key) of an item; equal scores by key, null last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def least(self) -> int:
        """The score that a document has to reach."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, rows: list[tuple]) -> None:
        self.rows += rows
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        del self.rows[self.k:]


def accumulated(lists, bounds, k: int, least: int, size: int) -> np.ndarray:
    """Scores of ``size`` documents from posting lists (places, contributions), rarest term first.

    ``bounds`` has the largest contribution of each list. Scores are exact for every document that
    can be among the ``k`` best and reach ``least``; of the others they may be lower.
    """
    score = np.zeros(size, np.int64)
    held = np.zeros(size, bool)
    rest, creating = int(sum(bounds)), True
    for (places, gain), bound in zip(lists, bounds):
        rest -= int(bound)
        if not len(places):
            continue
        if creating:
            score[places] += gain
            held[places] = True
        else:
            known = held[places]
            score[places[known]] += gain[known]
        if creating and rest < max(least, int(score.max())):
            reached = least
            if size >= k:
                reached = max(reached, int(np.partition(score, size - k)[size - k]))
            creating = rest >= reached
    return score


def _ranked_chunk(chunk: pa.Table, items, weights, documents, length, best) -> None:
    """Adds a chunk's documents to the best of every item."""
    keys = chunk.column("key").to_pylist()
    n = chunk.column("n").to_numpy()
    postings = chunk.column("terms").combine_chunks()
    owner = np.repeat(np.arange(len(keys)), np.diff(postings.offsets.to_numpy()))
    term = postings.flatten().to_numpy()
    tf = chunk.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
    measure = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * documents) // length
    gain = weights[term] * ((10**9 * tf) // (1000 * tf + 8 * measure[owner]))
    order = np.argsort(term, kind="stable")
    owner, gain = owner[order], gain[order]
    ends = np.searchsorted(term[order], np.arange(len(weights) + 1))
    top = np.zeros(len(weights), np.int64)
    np.maximum.at(top, term[order], gain)
    by_key = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i]))
    key_rank = np.empty(len(keys), np.int64)
    key_rank[by_key] = np.arange(len(keys))
    for own, held in zip(items, best):
        lists = [(owner[ends[t]:ends[t + 1]], gain[ends[t]:ends[t + 1]]) for t in own]
        score = accumulated(lists, top[own], held.k, held.least(), len(keys))
        reached = held.least()
        if len(keys) > held.k:
            reached = max(reached, int(np.partition(score, len(keys) - held.k)[-held.k]))
        found = np.flatnonzero(score >= reached)
        found = found[np.lexsort((key_rank[found], -score[found]))[:held.k]]
        held.add([(int(score[i]), keys[i]) for i in found])


def _searched(postings: DataFrame, items: list, vocabulary: list, k: int) -> DataFrame:
    """(item, key, score): the best k of every task for every item of a block."""
    session = postings.sparkSession
    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    place = {t: i for i, t in enumerate(vocabulary)}
    own = [
        sorted((place[bytes(t)] for t in row["terms"]), key=lambda i: (holding[i], i))
        for row in items
    ]
    numbers = [row["item"] for row in items]
    weights = np.array([weight(documents, h) for h in holding.tolist()], np.int64)
    sent = session.sparkContext.broadcast((numbers, own, weights))

    def run(batches):
        numbers, own, weights = sent.value
        best = [Best(k) for _ in own]
        held, size, kind = [], 0, None

        def score():
            nonlocal size
            if held:
                _ranked_chunk(pa.Table.from_batches(held), own, weights, documents, length, best)
            held.clear()
            size = 0

        for batch in batches:
            kind = batch.schema.field("key").type
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
            if size >= CHUNK_POSTINGS:
                score()
        score()
        rows = [(i, key, s) for i, b in zip(numbers, best) for s, key in b.rows]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), kind, pa.int64()))],
                ["item", "key", "score"],
            )

    kind = postings.schema["key"].dataType.simpleString()
    return postings.mapInArrow(run, f"item bigint, key {kind}, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """(item_key, rank, key, score): for every row of ``items`` its ``k`` best rows of ``docs``.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. A term's
    weight is floor(1000 * ln((2 * N + 2) / (2 * df + 1))). The score adds, for every distinct
    term of the item, weight * ((10^9 * tf) div (1000 * tf + 8 * m)), where m is
    10 + (90 * n * N) div L. N counts the documents with a term, L all terms, n those of the
    document, tf the term's, df the documents that hold it.

    Documents with a score of zero are not listed. Equal scores are ranked by ascending key, null
    last. Null and empty texts have no terms: such a document does not count, such an item has no
    rows, nor has any item when a table is empty. Repeated rows, of either table, count and are
    listed each. Texts are read whole. Other columns are not read; where the result's names clash,
    the later one gets an underscore.
    """
    spark = docs.sparkSession
    wanted = staged(_item_terms(items, item_text, item_key), "search-items")
    lengths = F.transform("terms", lambda t: F.octet_length(t) + 8)
    used = F.aggregate(lengths, F.lit(0).cast("long"), lambda s, x: s + x)
    total = wanted.agg(F.coalesce(F.sum(used), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        rows = wanted.where(block == b).select("item", "terms").collect()
        vocabulary = sorted({bytes(t) for row in rows for t in row["terms"]})
        sent = spark.sparkContext.broadcast(vocabulary)
        postings = staged(_postings(docs, text, key, sent), "postings")
        part = _searched(postings, rows, vocabulary, k)
        # With several blocks each is finished before the next one is sent.
        parts.append(staged(part, "search-block") if blocks > 1 else part)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = best.join(wanted.select("item", F.col("key").alias("item_key")), "item")
    names = unlike([item_key, "rank", key, "score"])
    return named.select("item_key", "rank", "key", "score").toDF(*names)
