"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes weighted counts of hashed features: its words, the shapes of its words (letters,
digits and marks), and how much it repeats itself. The labelled sample's matrix of features is
reduced by a singular value decomposition. Every document is projected, compared with all labelled
vectors by exact cosine products in blocks, and scored by its nearest neighbours' labels, weighted
by similarity.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import map_text, strings
from shelfwise.llm.training import TRAIN_ROWS, held_out, sample

# Feature columns for words, shapes and repetition.
WORDS, SHAPES, LEVELS = 512, 384, 16
# Repeated words are counted within stretches of so many words, so that long texts can be compared.
SPAN = 200
WORD_WEIGHT, SHAPE_WEIGHT, REPEAT_WEIGHT = 0.4, 1.0, 1.5
RANK = 48
NEIGHBOURS = 25
# Documents whose products with the labelled vectors are in memory together.
BLOCK = 256

_SHAPE = bytearray(range(256))
for _c in range(256):
    if 0x30 <= _c <= 0x39:
        _SHAPE[_c] = ord("9")
    elif 0x41 <= _c <= 0x5A:
        _SHAPE[_c] = ord("X")
    elif 0x61 <= _c <= 0x7A or _c >= 0x80:
        _SHAPE[_c] = ord("x")
_SHAPE = bytes(_SHAPE)


def shapes(data: bytes) -> Counter:
    """Counts of word shapes: runs of like characters count as one."""
    codes = np.frombuffer(data.translate(_SHAPE), np.uint8)
    if not len(codes):
        return Counter()
    kept = np.r_[True, codes[1:] != codes[:-1]]
    return Counter(codes[kept].tobytes().split())


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(columns, counts) of a text; a text without words has none."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    found: Counter = Counter()
    checksum = zlib.crc32
    counts = Counter(words)
    for word, n in counts.items():
        found[checksum(word) % WORDS] += n
    for shape, n in shapes(data).items():
        found[WORDS + checksum(shape) % SHAPES] += n
    scale = len(words) / LEVELS
    lines = [x for x in data.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    threes = len(set(zip(words, words[1:], words[2:]))) if len(words) > 2 else len(words)
    shares = (
        1 - threes / max(1, len(words) - 2) if len(words) > 2 else 0.0,
        same / len(words),
        1 - len(set(lines)) / len(lines),
        1 - sum(len(set(words[i:i + SPAN])) for i in range(0, len(words), SPAN)) / len(words),
    )
    for i, share in enumerate(shares):
        level = min(LEVELS - 1, int(share * LEVELS))
        found[WORDS + SHAPES + i * LEVELS + level] += scale * LEVELS
    return np.fromiter(found.keys(), np.int64), np.fromiter(found.values(), float)


COLUMNS = WORDS + SHAPES + 4 * LEVELS
_WEIGHT = np.repeat([WORD_WEIGHT, SHAPE_WEIGHT, REPEAT_WEIGHT], [WORDS, SHAPES, 4 * LEVELS])


def rows_of(texts: list[str]) -> np.ndarray:
    """Feature rows: relative counts, damped, weighted by kind. Texts without words are zero."""
    out = np.zeros((len(texts), COLUMNS), np.float32)
    for i, text in enumerate(texts):
        columns, counts = features(text)
        if len(columns):
            out[i, columns] = np.sqrt(counts / counts.sum()) * _WEIGHT[columns]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


@dataclass
class Model:
    """Feature weights, the projection, the labelled unit vectors and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @classmethod
    def fitted(cls, rows: np.ndarray, labels: np.ndarray) -> Model:
        if not len(rows):
            return cls(np.ones(COLUMNS, np.float32), np.zeros((COLUMNS, 1), np.float32),
                       np.zeros((0, 1), np.float32), labels, 0.5)
        share = (rows > 0).sum(axis=0)
        weights = np.log((1 + len(rows)) / (1 + share)).astype(np.float32) + 0.2
        weighted = _unit(rows * weights)
        # Right singular vectors from the small square of the matrix.
        _, vectors = np.linalg.eigh(weighted.T @ weighted)
        projection = np.ascontiguousarray(vectors[:, ::-1][:, :RANK]).astype(np.float32)
        return cls(weights, projection, _unit(weighted @ projection), labels, float(labels.mean()))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Label shares among the nearest labelled vectors, and among all that are as near as the last
        of them; the prior for texts without words."""
        out = np.full(len(rows), self.prior)
        if not len(self.vectors):
            return out
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(rows), BLOCK):
            block = _unit(_unit(rows[at:at + BLOCK] * self.weights) @ self.projection)
            cosine = block @ self.vectors.T
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            weight = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1) ** 4
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            least = np.take_along_axis(cosine, near, axis=1).min(axis=1, keepdims=True)
            tied = np.flatnonzero((cosine >= least).sum(axis=1) > k)
            for i in tied:
                row = cosine[i]
                all_near = np.clip(row[row >= least[i]], 0, 1) ** 4
                total[i] = all_near.sum()
                votes[i] = (all_near * self.labels[row >= least[i]]).sum()
            voted = total > 0
            out[at:at + BLOCK][voted] = np.clip(votes[voted] / total[voted], 0, 1)
        return out


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
    key: str = "doc_id", rows: int = TRAIN_ROWS,
) -> Model:
    """A model from at most ``rows`` labelled documents that are not held out.

    Their feature rows are made in the tasks; the driver gets ``rows`` x 960 small floats at most.
    """

    def run(batch):
        data = rows_of(strings(batch, "text")).astype(np.float16)
        return pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes() for x in data], pa.binary()), batch.column("label")],
            ["row", "label"],
        )

    taken = sample(docs, labels, label, text, key, rows)
    got = map_text(taken, "text", "row binary, label double", lambda: run).toArrow()
    # In an order that does not depend on the tasks.
    found = sorted(zip(got.column("row").to_pylist(), got.column("label").to_pylist()))
    data = np.frombuffer(b"".join(row for row, _ in found), np.float16)
    return Model.fitted(
        data.reshape(-1, COLUMNS).astype(np.float32), np.array([y for _, y in found], float)
    )


def score(
    docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: key, ``held_out``, ``score`` (0 to 1), ``predicted``.

    A null or empty text gets the share of label 1 in the sample, 0.5 if nothing was labelled. Each
    repeated row is scored; other columns are not read. The broadcast model holds the labelled
    vectors, ``TRAIN_ROWS`` x 48 floats at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def build():
        known = shared.value

        def run(batch):
            texts, found = strings(batch, "text"), []
            for at in range(0, len(texts), 1024):
                found.append(known.scores(rows_of(texts[at:at + 1024])))
            return pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.concatenate(found))], ["key", "score"]
            )

        return run

    schema = f"key {rows.schema['key'].dataType.simpleString()}, score double"
    found = map_text(rows, "text", schema, build)
    return found.select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
