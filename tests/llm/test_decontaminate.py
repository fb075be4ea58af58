import random
import re
import resource

from helpers import SMALL, rows_of

from shelfwise.llm import decontaminate as d
from shelfwise.llm import queries


def plain_row(pattern, text):
    column = list(range(len(pattern) + 1))
    for c in text:
        above, new = 0, [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (p != c)))
        column = new
        yield column[-1]


def plain_least(item, text):
    return min(plain_row(item, text), default=len(item) + 1)


def test_bit_parallel_distance():
    draw = random.Random(3)
    for _ in range(300):
        a = "".join(draw.choice("abé ") for _ in range(draw.randint(1, 90)))
        b = "".join(draw.choice("abé ") for _ in range(draw.randint(0, 60)))
        assert list(d.last_row(a, b)) == list(plain_row(a, b))


def edited(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        what = draw.randrange(3)
        if what == 0:
            out[at] = draw.choice("xyz")
        elif what == 1:
            del out[at]
        else:
            out.insert(at, draw.choice("xyz"))
    return "".join(out)


def test_all_within_the_budget_are_found(spark):
    draw = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "é", "zeta"]
    phrase = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, phrase(draw.randint(1, 30))) for i in range(25)] + [(90, None), (91, " \n"), (5, "Q")]
    docs = [(1000, None), (1001, ""), (None, items[3][1])]
    for i, (_, text) in enumerate(items[:25]):
        budget = len(text) // 10
        for edits in (0, budget // 2, budget, budget + 1, 2 * budget + 3):
            body = f"{phrase(8)}\n{edited(draw, text, min(edits, len(text) - 1)).upper()} {phrase(8)}"
            docs.append((len(docs), body))
    docs.append((2, items[4][1] + " qq " * 3000 + items[4][1]))
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in d.matches(frame, bench).collect()), key=repr)
    want = []
    for key, text in docs:
        for item, wanted in items:
            wanted = d.normal(wanted or "")
            if not wanted or (n := plain_least(wanted, d.normal(text or ""))) > len(wanted) // 10:
                continue
            if len(wanted) >= 10 or alone(wanted, d.normal(text)):
                want.append((key, item, n))
    assert got == sorted(want, key=repr)
    clean = d.cleaned(frame, bench)
    hit = {(k) for k, _, _ in want}
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in docs} - hit
    assert d.matches(frame.limit(0), bench).count() == 0
    assert d.matches(frame, bench.limit(0)).count() == 0
    assert d.cleaned(frame, bench.limit(0)).count() == len(docs)


def alone(item, text):
    left = r"(?<![^\W_])" if item[0].isalnum() else ""
    return re.search(left + re.escape(item) + (r"(?![^\W_])" if item[-1].isalnum() else ""), text)


def test_short_items_stand_at_word_edges(spark):
    texts = ["a banana", "bananas", "an (a) b", "x a", "", None, "a", "c++ code", "ac++ code", "ban a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, "A"), (2, "c++"), (3, "anan")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.matches(docs, items).collect()}
    assert got == {(0, 1), (2, 1), (3, 1), (6, 1), (9, 1), (7, 2)}
    assert {r.doc_id for r in d.cleaned(docs, items).collect()} == {1, 4, 5, 8}


def test_clashing_and_dotted_names(spark):
    docs = spark.createDataFrame([(1, "the whole item text is here", 0)], "item_id long, `a.b` string, kept int")
    items = spark.createDataFrame([(5, "whole item text is")], "item_id long, text string")
    found = d.matches(docs, items.withColumnRenamed("text", "a.b"), text="a.b", key="item_id")
    assert found.columns[:2] == ["item_id", "item_id_"] and found.first()[:2] == (1, 5)
    assert d.cleaned(docs, items.withColumnRenamed("text", "a.b"), text="a.b").columns == docs.columns


def test_a_block_of_full_size():
    draw = random.Random(9)
    items = [(i, "".join(draw.choices("abcdefgh ", k=400))) for i in range(d.BLOCK_CHARS // 400)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    matcher = d.Matcher(items, d.CHARS_PER_EDIT)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 << 10
    assert [n for n, *_ in matcher.find(f"x {items[77][1]} y")] == [77]


def test_blocks_give_the_same(spark, monkeypatch):
    whole = rows_of(queries.op2_decontamination(spark, SMALL))
    monkeypatch.setattr(d, "BLOCK_CHARS", 2000)
    assert rows_of(queries.op2_decontamination(spark, SMALL)) == whole


def test_query_equals_brute_force(spark):
    items = [(r.item_id, d.normal(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        text = d.normal(r.text)
        for key, item in items:
            least = min(d.last_row(item, text), default=len(item))
            if least <= len(item) // 10:
                want.append((r.doc_id, key, least))
    got = [(r.doc_id, r.item_id, r.distance) for r in queries.op2_decontamination(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)
