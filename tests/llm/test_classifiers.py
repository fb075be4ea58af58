import zlib

import numpy as np
import pytest


from shelfwise.llm import quality, queries, toxicity, training

MIDDLE = "/root/testdata/sf0.01"


def plain_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 3 == 1


EDGE = [(1, None), (2, ""), (None, "no id here."), (2, "twice. again."), (2, ""), (5, " \n.!?"), (6, "word " * 60_000)]


def edge_rows(spark):
    return spark.createDataFrame([(*r, 1, 0.5) for r in EDGE], "doc_id long, text string, label int, score double")


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_sample_is_bounded_and_never_held_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    labels = label_rows(spark, [(i, i % 2, 0) for i in range(250)] + [(7, 0, 1), (None, 1, 1), (8, None, None)])
    got = training.sample(docs, labels, "quality", "text", "doc_id").collect()
    want = {(f"t{i}", float(i % 2)) for i in range(250) if not plain_held_out(i)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert training.sample(docs, labels, "quality", "text", "doc_id", 10).count() == 10


def test_the_sample_takes_one_row_of_a_key_and_only_documents(spark):
    rows = [(i % 20, f"t{i % 20}") for i in range(2000)] + [(0, "another"), (None, "t"), (999, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = label_rows(spark, [(i, i % 2, 0) for i in range(1000)])
    got = training.sample(docs, labels, "quality", "text", "doc_id", 10)
    assert got.count() == 10
    got = training.sample(docs, labels, "quality", "text", "doc_id").collect()
    kept = [i for i in [*range(20), 999] if not plain_held_out(i)]
    assert sorted(r.label for r in got) == sorted(float(i % 2) for i in kept)
    assert {r.text for r in got} - {"another"} >= {f"t{i}" for i in kept if 0 < i < 20}
    # No document beside unlabelled ones: many labels do not crowd out the few that have a text.
    few = docs.where("doc_id between 3 and 6")
    assert training.sample(few, labels, "quality", "text", "doc_id", 10).count() == sum(
        not plain_held_out(i) for i in range(3, 7)
    )


def test_the_sample_is_bounded_by_bytes(spark):
    rows = [(i, "x" * (100 if i % 5 else 5000)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = label_rows(spark, [(i, i % 2, 0) for i in range(400)])
    got = [r.text for r in training.sample(docs, labels, "quality", "text", "doc_id", 300, 12_800).collect()]
    assert got == ["x" * 100] * 128


def test_equal_neighbours_all_vote():
    row = np.zeros((1, quality.COLUMNS), np.float32)
    row[0, :3] = 1
    rows = np.repeat(row, 60, axis=0)
    rows[50:, 3] = 2
    labels = np.array([1.0] * 20 + [0.0] * 30 + [1.0] * 10)
    for order in (np.arange(60), np.arange(60)[::-1]):
        model = quality.Model.fitted(rows[order], labels[order])
        assert abs(model.scores(row)[0] - 0.4) < 1e-6


def test_repetition_counts_alike_at_every_length():
    base = [f"w{i}" for i in range(100)]
    levels = set()
    for times in (2, 20, 200):
        columns, counts = quality.features(" ".join(base * times))
        last = quality.WORDS + quality.SHAPES + 3 * quality.LEVELS
        levels.add(tuple(c - last for c in columns if c >= last))
    assert levels == {(quality.LEVELS // 2,)}


@pytest.mark.parametrize("kind,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows(spark, kind, label):
    docs = edge_rows(spark)
    for labels in (label_rows(spark, []), label_rows(spark, [(2, 1, 1), (6, 0, 0)]), label_rows(spark, [(6, 1, 1)])):
        model = kind.fit(docs, labels)
        rows = kind.score(docs, model).collect()
        assert sorted((repr(r.doc_id) for r in rows)) == sorted(repr(k) for k, _ in EDGE)
        for r in rows:
            assert 0 <= r.score <= 1 and r.held_out == plain_held_out(r.doc_id)
    assert kind.score(docs.limit(0), model).count() == 0
    assert kind.score(docs, kind.fit(docs.limit(0), labels)).count() == len(EDGE)


def test_nearest_neighbours_equal_brute_force():
    draw = np.random.default_rng(0)
    rows = np.abs(draw.normal(size=(300, quality.COLUMNS))).astype(np.float32)
    labels = draw.integers(0, 2, 300).astype(float)
    model = quality.Model.fitted(rows, labels)
    some = np.abs(draw.normal(size=(20, quality.COLUMNS))).astype(np.float32)
    got = model.scores(some)
    for row, score in zip(some, got):
        row = row * model.weights
        row = (row / np.linalg.norm(row)) @ model.projection
        cosine = sorted(((float(row @ v) / float(np.linalg.norm(row)), y) for v, y in zip(model.vectors, labels)), reverse=True)
        near = [(max(0, c) ** 4, y) for c, y in cosine[:quality.NEIGHBOURS]]
        assert abs(score - sum(w * y for w, y in near) / sum(w for w, _ in near)) < 1e-3


def test_noisy_or_finds_the_offending_sentence(spark):
    words = [f"w{i}" for i in range(50)]
    draw = np.random.default_rng(1)
    rows = []
    for i in range(400):
        sents = [" ".join(draw.choice(words, 6)) for _ in range(5)]
        if i % 4 == 0:
            sents[i % 5] += f" vile{i % 3}"
        rows.append((i, ". ".join(sents) + ".", int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = label_rows(spark, [(i, 1, y) for i, _, y in rows])
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows)
    for i, text, y in rows[:8]:
        sents = toxicity.sentences(text)
        clean = np.prod([1 - p for p in model.probabilities(sents)])
        assert abs(got[i] - (1 - clean)) < 1e-9
    spans = toxicity.located(docs, model).collect()
    assert {r.doc_id for r in spans} == {i for i, _, y in rows if y}
    assert all("vile" in rows[r.doc_id][1][r.start:r.end] for r in spans)


def test_gradient_of_the_noisy_or():
    """A step along the slope used in training lowers the loss as its size says."""
    model = toxicity.Model({}, -3.0)
    assert abs(model.score("One. Two. Three.") - (1 - (1 - 1 / (1 + np.exp(3))) ** 3)) < 1e-12
    assert model.score("") == 0.0


def training_rows(spark, folder, label):
    """(text, label) of the labelled documents that may be learned from, read without the operator."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    return docs, [(docs[k], float(y)) for k, y in known.items()
                  if k in docs and y is not None and not plain_held_out(k)]


def unit(rows):
    length = np.sqrt((rows * rows).sum(axis=-1, keepdims=True))
    return np.where(length > 0, rows / np.where(length > 0, length, 1), 0)


def test_quality_query_equals_brute_force(spark):
    """Neighbours by a singular value decomposition and a sort of all cosines."""
    docs, train = training_rows(spark, MIDDLE, "quality")
    labels = np.array([y for _, y in train])
    rows = quality.rows_of([t for t, _ in train]).astype(np.float16).astype(float)
    weights = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.2
    weighted = unit(rows * weights)
    space = np.linalg.svd(weighted, full_matrices=False)[2][:quality.RANK].T
    vectors = unit(weighted @ space)
    found = {r.doc_id: r.score for r in queries.op4_quality(spark, MIDDLE).collect()}
    assert found.keys() == docs.keys()
    far = 0
    for key, text in docs.items():
        row = quality.rows_of([text])[0].astype(float)
        if not row.any():
            assert abs(found[key] - labels.mean()) < 1e-6
            continue
        cosine = vectors @ unit(unit(row * weights) @ space)
        near = cosine >= np.sort(cosine)[-quality.NEIGHBOURS] - 1e-6
        weight = np.clip(cosine[near], 0, 1) ** 4
        far += abs((weight * labels[near]).sum() / weight.sum() - found[key]) > 2e-2
    # Neighbours that differ in the last digits of a cosine may change places.
    assert far <= 0.01 * len(docs)


def test_toxicity_query_equals_brute_force(spark):
    """The model learned from rows read apart, and the noisy-or written out."""
    docs, train = training_rows(spark, MIDDLE, "toxic")

    def hashed(text):
        return [np.array([h for w in sorted(words) for h in toxicity.word_hashes(w)], np.int32)
                for _, _, words in toxicity.sentences(text)]

    def packed(text):
        found = hashed(text)
        return np.array([len(found), *map(len, found), *(h for f in found for h in f)], "<i4").tobytes()

    train.sort(key=lambda r: (packed(r[0]), r[1]))
    model = toxicity.Model.fitted([hashed(t) for t, _ in train], np.array([y for _, y in train]))
    found = {r.doc_id: r.score for r in queries.op7_toxicity(spark, MIDDLE).collect()}
    assert found.keys() == docs.keys()
    for key, text in docs.items():
        clean = 1.0
        for words in hashed(text):
            clean *= 1 - 1 / (1 + np.exp(-(model.bias + sum(model.weights.get(h, 0.0) for h in words.tolist()))))
        assert abs(found[key] - (1 - clean)) < 1e-6


@pytest.mark.parametrize("query,label,least", [("op4_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = queries.QUERIES[query](spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= least * len(known)
    limit = 0.5 if label == "quality" else 0.7
    assert all(r.predicted == (r.score >= limit) and 0 <= r.score <= 1 for r in rows)

