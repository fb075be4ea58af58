"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SMALL, rows_of

from shelfwise.llm import queries, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k=10):
    held = [(key, Counter(t)) for key, text in docs if (t := plain_terms(text))]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for key, counts in held:
            m = 10 + 90 * sum(counts.values()) * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in set(plain_terms(text)) if t in counts
            )
            if score > 0:
                rows.append((-score, key is None, key))
        rows.sort()
        out += [(item, i + 1, r[2], -r[0]) for i, r in enumerate(rows[:k])]
    return sorted(out, key=repr)


def made_up(seed, n, words=60, longest=40):
    lot = random.Random(seed)
    word = lambda: f"w{int(words * lot.random() ** 3)}"
    return [(i, " ".join(word() for _ in range(lot.randint(0, longest)))) for i in range(n)]


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(search, "CHUNK_POSTINGS", chunk)
    docs, items = made_up(1, 400), made_up(2, 25, longest=12)
    assert rows_of(search.search(*frames(spark, docs, items))) == plain_search(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 300)
    docs, items = made_up(3, 200), made_up(4, 30, longest=12)
    assert rows_of(search.search(*frames(spark, docs, items), k=3)) == plain_search(docs, items, 3)


def test_accumulators_stop_and_survivors_are_exact():
    lot = np.random.default_rng(5)
    lists, bounds = [], []
    for size in (3, 20, 400, 900):
        places = np.sort(lot.choice(1000, size, replace=False))
        gain = lot.integers(1, 10 * 1000 // size, size)
        lists.append((places, gain))
        bounds.append(int(gain.max()))
    whole = np.zeros(1000, np.int64)
    for places, gain in lists:
        whole[places] += gain
    score = search.accumulated(lists, bounds, 10, 1, 1000)
    edge = np.sort(whole)[-10]
    assert (score[whole >= edge] == whole[whole >= edge]).all()
    assert (score <= whole).all() and (score < whole).any()


def test_edges(spark):
    docs = [
        (1, None), (2, ""), (3, "Ümlaut x1 ÜMLAUT"), (3, "Ümlaut x1 ÜMLAUT"), (None, "ümlaut x1"),
        (4, "x1 " * 200_000 + "end"), (5, "a_b-c\x00d"), (6, "X1"), (7, "x1"), (8, "... !"),
    ]
    items = [(1, None), (1, "x1 end"), (1, "x1 end"), (None, "A b"), (2, "nowhere"), (3, "Ümlaut")]
    found = search.search(*frames(spark, docs, items))
    assert rows_of(found) == plain_search(docs, items)
    no_docs, no_items = frames(spark, [], [])
    some_docs, some_items = frames(spark, docs, items)
    assert search.search(no_docs, some_items).count() == 0
    assert search.search(some_docs, no_items).count() == 0
    odd = some_docs.toDF("a.b", "rank").selectExpr("*", "1 AS item", "2 AS score")
    clash = search.search(odd, some_items, text="rank", key="a.b", item_key="item_id")
    assert clash.columns == ["item_id", "rank", "a.b", "score"]
    assert rows_of(clash) == plain_search(docs, items)
    same = search.search(some_docs, some_items.withColumnRenamed("item_id", "doc_id"),
                         item_key="doc_id")
    assert same.columns == ["doc_id", "rank", "doc_id_", "score"]
    assert rows_of(same) == plain_search(docs, items)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert rows_of(queries.op13_search(spark, SMALL)) == plain_search(docs, items)
