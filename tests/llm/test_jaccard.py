"""The Jaccard join against all pairs of plain sets."""

import random
import re

import numpy as np
import pytest
from helpers import SMALL, rows_of

from shelfwise.llm import jaccard, queries

SCHEMA = "doc_id long, text string"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text, words=3):
    found = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if 0 < len(found) < words:
        return {" ".join(found)}
    return {" ".join(found[i:i + words]) for i in range(len(found) - words + 1)}


def plain_near(rows, least=90):
    sets = [plain_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= least * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    keys = {}
    for i, (key, _) in enumerate(rows):
        keys.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        known = [k for k in keys[find(i)] if k is not None]
        out.append((key, len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def made_up(seed, groups, copies, words=60, changes=4, common=0.0):
    """Groups of texts that differ from one another in a few words."""
    lot = random.Random(seed)
    line = "the same line is in very many of these texts ".split()
    rows = []
    for g in range(groups):
        base = [f"w{lot.randrange(5000)}" for _ in range(lot.randint(words // 2, words * 2))]
        for _ in range(lot.randint(1, copies)):
            text = list(base)
            for _ in range(lot.randint(0, changes)):
                text[lot.randrange(len(text))] = f"x{lot.randrange(10 ** 6)}"
            if lot.random() < common:
                text = line + text
            rows.append((len(rows), " ".join(text)))
    lot.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("seed, groups, copies, changes, common", [
    (1, 120, 6, 4, 0.0), (2, 6, 80, 6, 0.0), (3, 80, 6, 2, 0.7),
])
def test_equals_all_pairs(spark, seed, groups, copies, changes, common):
    rows = made_up(seed, groups, copies, changes=changes, common=common)
    assert rows_of(jaccard.near(frame(spark, rows))) == plain_near(rows)


@pytest.mark.parametrize("least", [60, 80])
def test_other_similarities_in_small_blocks(spark, monkeypatch, least):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    monkeypatch.setattr(jaccard, "COLUMNS", 50)
    rows = made_up(4, 12, 40, changes=12)
    assert rows_of(jaccard.near(frame(spark, rows), least=least)) == plain_near(rows, least)


def test_column_bounds_hold():
    lot = np.random.default_rng(6)
    for _ in range(3000):
        size = int(lot.integers(1, 300))
        other = int(lot.integers(jaccard.least_overlap(size, 90), size * 100 // 90 + 1))
        need = -(-90 * (size + other) // 190)
        if need > min(size, other):
            continue
        tokens = lot.choice(10**6, size + other - need, replace=False)
        x, y = set(tokens[:size]), set(tokens[size - need:])
        cut = [set(sorted(s)[:jaccard.kept_columns(len(s), 90)]) for s in (x, y)]
        both = len(cut[0] & cut[1])
        assert both >= max(jaccard.wanted_columns(len(s), 90) for s in (x, y))


def test_products_equal_sets():
    lot = random.Random(8)
    sides = [[np.array(sorted(lot.sample(range(60), lot.randint(1, 50))), np.uint64)
              for _ in range(30)] for _ in range(2)]
    alive = np.array([[lot.random() < 0.8 for _ in range(30)] for _ in range(30)])
    want = [
        [i, j] for i, a in enumerate(sides[0]) for j, b in enumerate(sides[1])
        if alive[i, j] and 2 * len(both := set(a.tolist()) & set(b.tolist()))
        >= len(set(a.tolist()) | set(b.tolist())) and both
    ]
    assert jaccard.linked_pairs(*sides, alive, 50).tolist() == want


def test_edges(spark):
    empty = jaccard.near(frame(spark, []))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0
    nine = " ".join(f"t{i}" for i in range(11))
    long = " ".join(f"y{i}" for i in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (3, None), (None, "one"), (4, "ONE"), (5, "one two"),
        (6, "One  two"), (None, "only here"), (None, None), (7, nine), (8, nine + " t11"),
        (9, long), (10, long + " z"), (11, "a b c a b c a b c"), (12, "a b c a b c"), (7, "other text"),
        (13, "Ä b c"), (14, "ä b c"), (15, long), (15, long), (20, "one two"), (20, "one two"),
    ]
    found = jaccard.near(frame(spark, rows))
    assert rows_of(found) == plain_near(rows)
    odd = frame(spark, rows).selectExpr("doc_id AS n_shingles", "text AS `a.b`", "1 AS c", "2 AS pivot")
    clash = jaccard.near(odd, text="a.b", key="n_shingles")
    assert clash.columns == ["n_shingles", "n_shingles_", "component_id"]
    assert rows_of(clash) == plain_near(rows)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert rows_of(queries.op11_jaccard(spark, SMALL)) == plain_near([(r.doc_id, r.text) for r in docs])
