import random

import pytest
import xxhash
from helpers import SMALL, rows_of

from shelfwise.llm import queries, simhash




def plain_print(text, words=4):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = [w for w in _split(folded) if w]
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    hashes = [
        xxhash.xxh64_intdigest(" ".join(parts[i:i + words]).encode(), 42) for i in range(count)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def _split(text):
    word = ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            yield word
            word = ""
        else:
            word += c
    yield word


def plain_classes(rows, distance=4):
    prints = [plain_print(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                label[max(top(i), top(j))] = min(top(i), top(j))
    members = {}
    for i, (key, _) in enumerate(rows):
        members.setdefault(top(i), []).append(key)
    least = {
        k: min((x for x in v if x is not None), default=None) for k, v in members.items()
    }
    return [(key, f"{prints[i]:016x}", least[top(i)]) for i, (key, _) in enumerate(rows)]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op1_simhash(spark, SMALL).collect()]
    assert sorted(got) == sorted(plain_classes(rows))


def test_edges(spark):
    rows = [
        (7, None), (3, ""), (None, " \n\t"), (5, "one two"), (6, "One\x0bTWO"), (6, "one two"),
        (9, "a b c d"), (10, "a b c d e"), (11, "É É É É"), (12, "é é é é"), (None, "x"),
        (13, "long " * 50_000), (14, "long " * 4),
    ]
    frame = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "doc_id long, text string, print string, root int, component_id int",
    )
    found = simhash.near_duplicates(frame).select("doc_id", "fingerprint", "component_id")
    assert rows_of(found) == sorted(plain_classes(rows), key=repr)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == [3, 5, 9, 10, 11, 12, 13]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    assert simhash.one_of_each(frame.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_one_of_each_with_shared_keys_and_any_names(spark, monkeypatch, limit):
    """Rows that share key and fingerprint but not their text: one stays, always the same."""
    monkeypatch.setattr(simhash, "BROADCAST_LIMIT_BYTES", limit)
    rows = [(1, "Aa b"), (1, "aa  b"), (1, "quite another text of some words"), (2, "aa b"), (4, "c d"), (4, "c d"),
            (3, "quite another text of some words"), (None, None), (None, ""), (6, " "), (7, "c d"), (8, "unlike all")]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "print long, `a.b` string, place int")
    seen = set()
    for parts in (1, 5):
        kept = simhash.one_of_each(frame.repartition(parts), text="a.b", key="print")
        assert kept.columns == frame.columns
        found = sorted(((r[0], r[1]) for r in kept.collect()), key=repr)
        assert [k for k, _ in found] == [1, 1, 4, 6, 8]
        seen.add(tuple(found))
    assert len(seen) == 1
    assert simhash.near_duplicates(frame, text="a.b", key="print").columns == [
        "print", "fingerprint", "component_id", "print_", "root"
    ]


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_links_connect_what_is_near(spark, distance, monkeypatch):
    monkeypatch.setattr(simhash, "PASS_VARIANTS", 1 << 12)
    draw = random.Random(distance)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for d in range(6):
            near = p
            for b in draw.sample(range(64), d):
                near ^= 1 << b
            prints.add(near)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), distance)
    pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in got.collect()]
    assert classes(prints, pairs) == classes(prints, [
        (a, b) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= distance
    ])


def classes(nodes, pairs):
    label = {n: n for n in nodes}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_bucket_bits_grow_with_the_input():
    assert simhash.bucket_bits(10**5, 2081) == 6
    bits = simhash.bucket_bits(10**11, 2081)
    assert 10**11 * 2081 >> bits <= simhash.BUCKET_PRINTS
