import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import SMALL
from tokenizers import Tokenizer

from shelfwise.llm import packing, queries, tokens, wavelet

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PARTS = [
    "a", "B", "é", "é", "́", " ", "  ", "\n", "\t", "\x1d", "\x85", " ", "　", "'s",
    "'", "'re", "1", "²", "Ⅷ", "_", ".", "!!", "<|endoftext|>", "İ", "Σ", "ς", "漢", "😀", "\r\n", "ǅ",
    "%%%", "-", "word", " word,",
]


def plain_ids(name, texts):
    found = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch(
        texts, add_special_tokens=False
    )
    return [[*x.ids, 1] for x in found]


@pytest.mark.parametrize("name", FILES)
def test_ids_are_those_of_the_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 300)
    draw = random.Random(2)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(4000)] + ["", "x" * 9999]
    encoder = tokens.Encoder(public_tokenizers.path(name))
    got = [np.frombuffer(x, "<u4").tolist() + [1] for i in range(0, len(texts), 500)
           for x in encoder.encode(texts[i:i + 500])]
    assert got == plain_ids(name, texts)


@pytest.mark.parametrize("size", [0, 1, 63, 64, 511, 512, 513, 3000])
def test_wavelet_matrix(size):
    draw = np.random.default_rng(size)
    ids = draw.choice([0, 1, 5, 7, 49405, 70000], size).astype("<u4")
    keys, sizes, matrix = wavelet.open_shard(wavelet.pack_shard([1, None], [size, 0], ids))
    assert (keys, sizes.tolist()) == ([1, None], [size, 0])
    assert matrix.ids().tolist() == ids.tolist()
    for i in range(0, size, 7):
        assert matrix.access(i) == ids[i]
    for value in (0, 1, 2, 5, 49405, 70000, 1 << 20):
        assert matrix.count(value) == (ids == value).sum()
        assert matrix.rank(value, size // 2) == (ids[:size // 2] == value).sum()
        assert matrix.occurrences(value) == np.flatnonzero(ids == value).tolist()
    with pytest.raises(IndexError):
        matrix.access(size)


ROWS = [(3, "three"), (None, "no id"), (1, None), (2, ""), (2, "again twice"), (2, ""), (9, "long " * 9000)]


def edge_rows(spark):
    return spark.createDataFrame([(*r, 7, "x") for r in ROWS], "doc_id long, text string, start int, ids string")


def test_shards_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_IDS", 4)
    frame = edge_rows(spark)
    shards = wavelet.write_shards(frame, public_tokenizers.path(FILES[0]))
    rows = wavelet.read_documents(shards).orderBy("start").collect()
    want = plain_ids(FILES[0], [t or "" for _, t in ROWS])
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=repr) == sorted(
        ((k, x) for (k, _), x in zip(ROWS, want)), key=repr
    )
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 2, 3, 9]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    assert sorted(r.position for r in wavelet.occurrences(shards, 1).collect()) == np.flatnonzero(stream == 1).tolist()
    empty = wavelet.write_shards(frame.limit(0), public_tokenizers.path(FILES[0]))
    assert wavelet.read_documents(empty).count() == 0


def test_token_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    want, start = [], 0
    for r, ids in zip(docs, plain_ids(FILES[0], [r.text for r in docs])):
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op8_tokens(spark, SMALL).collect()) == want


def whole(pieces, rows, window):
    """Checks a packing against the ids of the documents; gives the number of sequences."""
    want = plain_ids(FILES[1], [t or "" for _, t in rows])
    documents = {}
    for (k, _), x in zip(rows, want):
        documents.setdefault(k, []).append(x)
    sequences, by_key = {}, {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_key.setdefault(r.doc_id, []).append(r)
        assert r.length > 0 and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        assert sum(n for _, n in own) <= window
    for k, own in documents.items():
        got = sorted((r.start, r.doc_tokens, r.ids) for r in by_key.pop(k))
        parts = []
        for x in own:
            cuts = sorted({s for s, total, _ in got if total == len(x)})
            for i, j in zip(cuts, [*cuts[1:], len(x)]):
                parts.append((i, len(x), np.array(x[i:j], "<u4").tobytes()))
        assert len({len(x) for x in own}) < len(own) or got == sorted(parts)
        assert sum(len(b) for *_, b in got) == 4 * sum(map(len, own))
    assert not by_key
    return len(sequences)


@pytest.mark.parametrize("window,most", [(8, 1), (16, 3), (2048, 64)])
def test_packing_keeps_every_id_once(spark, window, most):
    frame = edge_rows(spark).repartition(3)
    got = packing.pack(frame, public_tokenizers.path(FILES[1]), window=window, open_windows=most, keep_ids=True)
    whole(got.collect(), ROWS, window)
    assert packing.pack(frame.limit(0), public_tokenizers.path(FILES[1])).count() == 0


def test_packing_has_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, public_tokenizers.path(FILES[1]), keep_ids=True).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    count = whole(got, rows, 2048)
    assert sum(r.length for r in got) >= 0.98 * 2048 * count


def test_best_fit_order():
    windows = packing.Windows(10, 2)
    assert windows.place("a", 6) is None and windows.place("b", 7) is None
    assert windows.place("c", 2) is None and windows.used == [6, 9]
    assert windows.place("d", 5) == ["b", "c"] and windows.used == [6, 5]
    assert windows.place("e", 4) == ["a", "e"]


def test_clashing_names(spark):
    path = public_tokenizers.path(FILES[1])
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "start long, `a.b` string")
    pieces = packing.pack(docs, path, text="a.b", key="start")
    assert pieces.columns[:2] == ["start", "start_"] and pieces.count() == 2
    found = wavelet.read_documents(wavelet.write_shards(docs, path, text="a.b", key="start"), key="start")
    assert found.columns[:2] == ["start", "start_"]
    assert sorted((r[0], r.n_tokens) for r in found.collect()) == [(1, 3), (2, 1)]
