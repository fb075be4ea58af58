"""The pipeline against a plain reading of its contract, on the smallest tables."""

import pytest
from helpers import SMALL
from test_secrets import plain_spans
from test_simhash import plain_classes
from test_tokens import FILES, plain_ids

import corpus_pipeline
from shelfwise.llm import decontaminate, rules


def plain_stages(docs, items):
    """The documents after each of the filtering stages, as {doc_id: text}."""
    kept = {}
    for key, text in docs.items():
        found = rules.judge(text or "")
        if found.kept:
            kept[key] = found.text
    yield kept
    kept = {k: kept[k] for k, _, c in plain_classes(list(kept.items())) if k == c}
    yield kept
    budget = [(d := decontaminate.normal(i), len(d) // 10) for i in items]
    clean = {}
    for key, text in kept.items():
        text = decontaminate.normal(text)
        if all(min(decontaminate.last_row(i, text), default=9999) > k for i, k in budget):
            clean[key] = kept[key]
    yield clean
    out = {}
    for key, text in clean.items():
        parts, at = [], 0
        for start, _, end in plain_spans(text)[1]:
            if start >= at:
                parts += [text[at:start], "[secret]"]
            at = max(at, end)
        out[key] = "".join(parts) + text[at:]
    yield out


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = plain_stages({r.doc_id: r.text for r in docs.collect()}, items)
    columns = docs.columns
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want):
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == expected and len(rows) == len(expected), name
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    lengths = {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
    assert lengths == dict(zip(expected, map(len, plain_ids(FILES[1], list(expected.values())))))
    assert corpus_pipeline.run(spark, SMALL).count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "s", 0), (None, "x " * 30, None, None, None)]])
def test_small_inputs(spark, rows):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
