"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is a logistic function of its words. A document is toxic if any of its
sentences is, so its probability is the noisy-or of theirs, and the words' weights are learned from
document labels through it. What a document is called for can then be located.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import map_text, strings, unlike
from shelfwise.llm.training import TRAIN_ROWS, held_out, sample

SENTENCE = regex.compile(r"[^.!?…\n]+[.!?…]*")
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
# Words are hashed; those in fewer labelled documents, or in about as many clean ones, are left out.
HASHES = 1 << 22
LEAST_DOCUMENTS = 4
VOCABULARY = 4_000
PREFIXES = (4, 5, 6)
# Words whose weights a task remembers; it starts again when there are more.
KNOWN_WORDS = 300_000
STEPS, RATE, DECAY = 400, 0.3, 2e-4
LOCATED = 0.5
THRESHOLD = 0.7


def word_hashes(word: str) -> list[int]:
    """The features of a lower-case word: itself, and its first letters, for inflected forms."""
    forms = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(f.encode()) % HASHES for f in forms]


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, distinct lower-case words) of every sentence with words."""
    out = []
    for m in SENTENCE.finditer(text):
        if found := set(WORD.findall(m[0].lower())):
            out.append((m.start(), m.end(), found))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Weights of word hashes, and the score of a sentence without any of them."""

    weights: dict[int, float]
    bias: float
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    @classmethod
    def fitted(cls, documents: list[list[np.ndarray]], labels: np.ndarray) -> Model:
        """Full-batch training with AdaGrad on the noisy-or likelihood.

        Sentences without a vocabulary word are alike, so a document needs only their number.
        """
        if not len(documents) or labels.max() == labels.min():
            return cls({}, -20.0)
        seen, toxic = Counter(), Counter()
        for sents, y in zip(documents, labels):
            own = set(np.unique(np.concatenate(sents)).tolist()) if sents else set()
            seen.update(own)
            if y:
                toxic.update(own)
        positives = labels.sum()
        ratio = {
            w: np.log((t + 0.5) / (positives + 1))
            - np.log((seen[w] - t + 0.5) / (len(labels) - positives + 1))
            for w, t in toxic.items() if t >= LEAST_DOCUMENTS
        }
        chosen = sorted((w for w, r in ratio.items() if r > 1), key=lambda w: (-ratio[w], w))
        place = {w: i for i, w in enumerate(chosen[:VOCABULARY])}
        pairs, owner, plain = [], [], np.zeros(len(documents))
        for d, sents in enumerate(documents):
            for words in sents:
                own = [place[w] for w in words.tolist() if w in place]
                if own:
                    pairs += [(len(owner), w) for w in own]
                    owner.append(d)
                else:
                    plain[d] += 1
        if not pairs:
            return cls({}, -20.0)
        rows, words = np.array(pairs).T
        owner = np.array(owner)
        weights, bias = np.zeros(len(place)), -5.0
        sums, bias_sum = np.full(len(place), 1e-6), 1e-6
        for _ in range(STEPS):
            z = bias + np.bincount(rows, weights[words], len(owner))
            p, p0 = _sigmoid(z), _sigmoid(bias)
            clean = np.bincount(owner, np.log1p(-p), len(documents)) + plain * np.log1p(-p0)
            whole = -np.expm1(np.minimum(clean, -1e-12))
            # d(loss)/dz of a sentence: p for clean documents, p * (1 - 1 / P) for toxic ones.
            factor = np.where(labels > 0, 1 - 1 / whole, 1.0)
            slope = p * factor[owner]
            change = np.bincount(words, slope[rows], len(place)) + DECAY * len(labels) * weights
            bias_change = slope.sum() + (plain * factor).sum() * p0
            sums += change**2
            bias_sum += bias_change**2
            weights -= RATE * change / np.sqrt(sums)
            bias -= RATE * bias_change / np.sqrt(bias_sum)
        return cls({w: float(weights[i]) for w, i in place.items()}, float(bias))

    def logit(self, words: set[str]) -> float:
        """Of a sentence with these words."""
        known, total = self._known, self.bias
        for w in words:
            weight = known.get(w)
            if weight is None:
                if len(known) > KNOWN_WORDS:
                    known.clear()
                weight = known[w] = sum(self.weights.get(h, 0.0) for h in word_hashes(w))
            total += weight
        return total

    def probabilities(self, sents: list[tuple[int, int, set[str]]]) -> list[float]:
        return [float(_sigmoid(self.logit(words))) for _, _, words in sents]

    def score(self, text: str) -> float:
        """The noisy-or over all sentences; zero without any."""
        logits = np.array([self.logit(words) for _, _, words in sentences(text)])
        return float(-np.expm1(np.log1p(-_sigmoid(logits)).sum())) if len(logits) else 0.0


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text",
    key: str = "doc_id", rows: int = TRAIN_ROWS,
) -> Model:
    """A model from at most ``rows`` labelled documents that are not held out.

    Their sentences come to the driver as hashed features: at most 16 bytes for each word of the
    sample, whose texts have a bounded size in all.
    """

    def run(batch):
        packed = []
        for text in strings(batch, "text"):
            found = [
                [h for w in sorted(words) for h in word_hashes(w)] for _, _, words in sentences(text)
            ]
            flat = [len(found), *map(len, found), *(w for words in found for w in words)]
            packed.append(np.array(flat, "<i4").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(packed, pa.binary()), batch.column("label")], ["words", "label"]
        )

    taken = sample(docs, labels, label, text, key, rows)
    got = map_text(taken, "text", "words binary, label double", lambda: run).toArrow()
    # In an order that does not depend on the tasks.
    found = sorted(zip(got.column("words").to_pylist(), got.column("label").to_pylist()))
    documents = []
    for data, _ in found:
        flat = np.frombuffer(data, "<i4")
        sizes = flat[1:1 + flat[0]]
        documents.append(np.split(flat[1 + flat[0]:], np.cumsum(sizes)[:-1]) if flat[0] else [])
    return Model.fitted(documents, np.array([y for _, y in found]))


def _mapped(docs, text, key, schema, names, make):
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batch):
        columns = make(batch.column("key"), strings(batch, "text"))
        return pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["key"].dataType.simpleString()
    return map_text(rows, "text", f"key {kind}, {schema}", lambda: run)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, ``held_out``, ``score`` (0 to 1), ``predicted``.

    A text without sentences, null or empty, has score zero. Each repeated row is scored; other
    columns are not read. A model fitted on nothing, or on one label alone, scores near zero.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(keys, texts):
        return [keys, pa.array([shared.value.score(t) for t in texts], pa.float64())]

    found = _mapped(docs, text, key, "score double", ["key", "score"], make)
    return found.select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def located(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per offending sentence: key, ``start`` and ``end`` (code points), ``probability``.

    Texts without sentences, null or empty, have none; repeated rows are searched each; an empty
    table gives no rows. Other columns are not read; where the result's names clash, the later one
    gets an underscore.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(keys, texts):
        rows = []
        for k, t in zip(keys.to_pylist(), texts):
            sents = sentences(t)
            rows += [
                (k, i, j, p) for (i, j, _), p in zip(sents, shared.value.probabilities(sents))
                if p >= LOCATED
            ]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [keys.type, pa.int32(), pa.int32(), pa.float64()]
        return [pa.array(c, t) for c, t in zip(columns, kinds)]

    names = ["key", "start", "end", "probability"]
    found = _mapped(docs, text, key, "start int, end int, probability double", names, make)
    return found.toDF(*unlike([key, *names[1:]]))
