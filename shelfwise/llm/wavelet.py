"""Token files: one wavelet matrix per shard of documents.

A wavelet matrix keeps a sequence of ids as one bit-plane for each bit, the highest first. After
every plane the ids are split into those with a zero and those with a one there, both in order. With
counts of ones (rank) and their places (select) on the planes, single ids, counts of an id and the
places where it occurs are found without unpacking the sequence.

File: ``WVLT1``, the header's length (4 bytes, little-endian), a JSON header, and one Zstandard
frame for each plane, each plane's rank directory, the document keys and the document sizes.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import read_range, slices, strings, unlike, write_file
from shelfwise.llm import tokens
from shelfwise.session import compute_slots, scratch_path, staged

MAGIC = b"WVLT1"
END_ID = 1
# A shard is closed when it has this many ids; a longer document has a shard of its own.
SHARD_IDS = 2 << 20
BLOCK_WORDS = 8


class Plane:
    """Bits with rank and select: 64-bit words, and the ones before every eighth word."""

    def __init__(self, words: np.ndarray, ones: np.ndarray):
        self.words, self.ones = words, ones

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 512 * BLOCK_WORDS + BLOCK_WORDS, "<u8")
        words.view(np.uint8)[:len(packed)] = packed
        blocks = np.bitwise_count(words).reshape(-1, BLOCK_WORDS).sum(axis=1)
        return cls(words, np.concatenate([[0], np.cumsum(blocks)]).astype("<u8"))

    def bits(self, size: int) -> np.ndarray:
        found = np.unpackbits(self.words.view(np.uint8), count=size, bitorder="little")
        return found.view(bool)

    def bit(self, i: int) -> int:
        return int(self.words[i >> 6]) >> (i & 63) & 1

    def rank(self, i: int) -> int:
        """Ones before place ``i``."""
        first, word = i >> 9 << 3, i >> 6
        whole = int(np.bitwise_count(self.words[first:word]).sum())
        part = (int(self.words[word]) & (1 << (i & 63)) - 1).bit_count() if i & 63 else 0
        return int(self.ones[i >> 9]) + whole + part

    def select(self, bit: int, k: int) -> int:
        """The place of the ``k``-th (from 0) one or zero."""
        before = self.ones if bit else np.arange(len(self.ones)) * 512 - self.ones.astype(np.int64)
        block = int(np.searchsorted(before, k, side="right")) - 1
        words = self.words[block * BLOCK_WORDS:(block + 1) * BLOCK_WORDS]
        bits = np.unpackbits(words.view(np.uint8), bitorder="little")
        return block * 512 + int(np.flatnonzero(bits == bit)[k - int(before[block])])


class WaveletMatrix:
    """A sequence of ids with access, rank, count and occurrence lookup."""

    def __init__(self, size: int, zeros: list[int], planes: list[Plane]):
        self.size, self.zeros, self.planes = size, zeros, planes

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, planes = [], []
        for k in reversed(range(width)):
            bits = (now & now.dtype.type(1 << k)) != 0
            low, high = now.compress(~bits), now.compress(bits)
            zeros.append(len(low))
            planes.append(Plane.of(bits))
            now = np.concatenate([low, high])
        return cls(len(ids), zeros, planes)

    def ids(self) -> np.ndarray:
        """The whole sequence, as little-endian unsigned 32-bit numbers."""
        now = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k, (zeros, plane) in enumerate(zip(reversed(self.zeros), reversed(self.planes))):
            bits = plane.bits(self.size)
            above = np.empty_like(now)
            above[np.flatnonzero(~bits)] = now[:zeros]
            above[np.flatnonzero(bits)] = now[zeros:] | now.dtype.type(1 << k)
            now = above
        return now.astype("<u4")

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for zeros, plane in zip(self.zeros, self.planes):
            bit, ones = plane.bit(i), plane.rank(i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        low, high = 0, i
        if value < 0 or value >> len(self.planes):
            return 0, 0
        for k, (zeros, plane) in enumerate(zip(self.zeros, self.planes)):
            a, b = plane.rank(low), plane.rank(high)
            one = value >> (len(self.planes) - 1 - k) & 1
            low, high = (zeros + a, zeros + b) if one else (low - a, high - b)
        return low, high

    def rank(self, value: int, i: int) -> int:
        """How often an id occurs before place ``i``."""
        low, high = self._range(value, i)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.size)

    def select(self, value: int, k: int) -> int:
        """The place of the ``k``-th (from 0) occurrence of an id."""
        low, high = self._range(value, self.size)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for j, (zeros, plane) in enumerate(zip(reversed(self.zeros), reversed(self.planes))):
            one = value >> j & 1
            i = plane.select(one, i - zeros if one else i)
        return i

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]


def pack_shard(keys: list, sizes: list[int], ids: np.ndarray) -> bytes:
    """The file of a shard: document keys, their numbers of ids, and the ids one after the other."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1).compress
    matrix = WaveletMatrix.of(ids)
    frames = [press(p.words.tobytes()) for p in matrix.planes]
    frames += [press(p.ones.tobytes()) for p in matrix.planes]
    frames += [press(json.dumps(keys).encode()), press(np.array(sizes, "<i8").tobytes())]
    head = {"ids": matrix.size, "zeros": matrix.zeros, "frames": [len(f) for f in frames]}
    text = json.dumps(head).encode()
    return b"".join([MAGIC, len(text).to_bytes(4, "little"), text, *frames])


def open_shard(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(document keys, numbers of ids, the matrix) from a shard's file."""
    import zstandard

    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC) + 4
    size = int.from_bytes(data[len(MAGIC):at], "little")
    head = json.loads(data[at:at + size])
    at += size
    parts, unpress = [], zstandard.ZstdDecompressor().decompress
    for length in head["frames"]:
        parts.append(unpress(data[at:at + length]))
        at += length
    width = len(head["zeros"])
    planes = [
        Plane(np.frombuffer(parts[k], "<u8"), np.frombuffer(parts[width + k], "<u8"))
        for k in range(width)
    ]
    keys, sizes = json.loads(parts[-2]), np.frombuffer(parts[-1], "<i8")
    return keys, sizes, WaveletMatrix(head["ids"], head["zeros"], planes)


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    folder: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Encodes every text, ends it with ``end_id``, and writes shard files in ascending key order.

    ``tokenizer`` is the path of a tokenizer file. Gives one row for each shard, in the order of
    ``part`` and ``number``: path, docs, ids, and start, the ids in all shards before. Null keys
    come first; rows with an equal key are ordered by a hash of their text. A null text is empty and
    has the end id alone. An empty table gives no shard. Files of attempts that failed may lie in
    the folder; the rows name the valid ones only.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    keyed = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "tie", "row"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")

    def write(batches):
        encoder, part, number = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        keys, sizes, held, total = [], [], [], 0

        def flush():
            nonlocal number, total
            ids = np.frombuffer(b"".join(held), "<u4")
            name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.wvlt"
            path = write_file(folder, name, pack_shard(keys, sizes, ids))
            row = [part, number, path, len(keys), total]
            number, total = number + 1, 0
            for x in (keys, sizes, held):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in row], ["part", "number", "path", "docs", "ids"]
            )

        for batch in slices(batches, "text"):
            for k, found in zip(batch.column("key").to_pylist(),
                                encoder.encode(strings(batch, "text"))):
                size = len(found) // 4 + 1
                if held and total + size > SHARD_IDS:
                    yield flush()
                keys.append(k)
                sizes.append(size)
                held.append(found + end)
                total += size
        if held:
            yield flush()

    written = staged(
        ranged.mapInArrow(write, "part long, number long, path string, docs long, ids long"),
        "token-shards",
    )
    # Starts in two steps: shards inside a part, and one small row for each part.
    inside = Window.partitionBy("part").orderBy("number")
    parts = written.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("base"))
    return written.join(parts, "part").select(
        "part", "number", "path", "docs", "ids",
        (F.col("base") + F.sum("ids").over(inside) - F.col("ids")).alias("start"),
    )


def _dealt(shards: DataFrame) -> DataFrame:
    count = shards.count()
    return shards.select("path", "start").repartition(compute_slots(shards.sparkSession, count))


def read_documents(shards: DataFrame, key: str = "doc_id", key_type: str = "bigint") -> DataFrame:
    """One row per document from the shard files: key, start, n_tokens, ids_crc32, and ``ids``,
    the ids as little-endian unsigned 32-bit bytes.

    Documents without text have the end id alone, null keys and repeated rows are kept, and no
    shards give no rows. Where the result's names clash, the later one gets an underscore.
    """

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(),
                                   batch.column("start").to_pylist()):
                keys, sizes, matrix = open_shard(read_range(path))
                data = matrix.ids().tobytes()
                ends = np.cumsum(sizes)
                ids = [data[4 * i:4 * j] for i, j in zip((ends - sizes).tolist(), ends.tolist())]
                for at in range(0, len(keys), 4096):
                    own = slice(at, at + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[own]),
                            pa.array(start + (ends - sizes)[own]),
                            pa.array(sizes[own]),
                            pa.array([zlib.crc32(x) for x in ids[own]], pa.int64()),
                            pa.array(ids[own], pa.binary()),
                        ],
                        names=names,
                    )

    names = ["key", "start", "n_tokens", "ids_crc32", "ids"]
    schema = f"key {key_type}, start long, n_tokens long, ids_crc32 long, ids binary"
    return _dealt(shards).mapInArrow(read, schema).toDF(*unlike([key, *names[1:]]))


def occurrences(
    shards: DataFrame, token: int, key: str = "doc_id", key_type: str = "bigint"
) -> DataFrame:
    """Every place of an id: key, place in its document, and place among all ids."""

    def find(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(),
                                   batch.column("start").to_pylist()):
                keys, sizes, matrix = open_shard(read_range(path))
                places = np.array(matrix.occurrences(token), np.int64)
                ends = np.cumsum(sizes)
                doc = np.searchsorted(ends, places, side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[d] for d in doc], key_arrow),
                        pa.array(places - (ends - sizes)[doc]),
                        pa.array(start + places),
                    ],
                    names=[key, "place", "position"],
                )

    key_arrow = pa.int64() if key_type == "bigint" else pa.string()
    return _dealt(shards).mapInArrow(find, f"`{key}` {key_type}, place long, position long")
