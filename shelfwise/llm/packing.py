"""Packing of documents into token sequences: bounded-space online best fit.

Every task keeps a fixed number of open windows. The full windows of a long document are emitted at
once, its rest goes to the open window with the least room that takes it. If none does and no window
can be added, the fullest is emitted. The windows still open at the end are merged: the pieces of
some neighbouring tasks are laid end to end and cut at the window length.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import slices, strings, unlike
from shelfwise.llm import tokens
from shelfwise.session import staged

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
# Tasks whose leftovers are merged together: at most this many times OPEN_WINDOWS windows.
MERGED_TASKS = 16
SEQUENCE_BITS = 32
MERGED = 1 << 62


class Windows:
    """The open windows of one task. Pieces are (key, start, ids, doc_tokens)."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.open: list[list] = []
        self.used: list[int] = []

    def place(self, piece: tuple, size: int) -> list | None:
        """Puts a piece into a window; gives the pieces of a window that had to go, if any."""
        best = -1
        for i, used in enumerate(self.used):
            if used + size <= self.window and (best < 0 or used > self.used[best]):
                best = i
        gone = None
        if best < 0:
            if len(self.open) == self.most:
                fullest = max(range(self.most), key=self.used.__getitem__)
                gone = self.open.pop(fullest)
                del self.used[fullest]
            self.open.append([])
            self.used.append(0)
            best = len(self.open) - 1
        self.open[best].append(piece)
        self.used[best] += size
        if self.used[best] == self.window and gone is None:
            del self.used[best]
            return self.open.pop(best)
        return gone


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``keep_ids`` the piece's ids as little-endian unsigned 32-bit bytes.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. Pieces of a
    sequence follow each other without gaps from offset 0 and have at most ``window`` ids together.
    Every id of every row is in one piece; repeated rows are packed each, null keys are kept. Of
    windows with equal room the first one opened takes a piece. An empty table gives no rows. Other
    columns are not read; where the result's names clash, the later one gets an underscore.
    """
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = keyed.schema["key"].dataType.simpleString()
    schema = (
        f"key {key_type}, start long, length long, ids_crc32 long, doc_tokens long,"
        " task long, sequence long, offset long, open boolean, ids binary"
    )
    names = [part.split()[0] for part in schema.split(",")]
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encoder, task, sequence = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0
        windows, rows = Windows(window, open_windows), []

        def emit(pieces, is_open=False):
            nonlocal sequence
            offset = 0
            for k, start, ids, total in pieces:
                size = len(ids) // 4
                kept = ids if is_open or keep_ids else None
                rows.append((k, start, size, zlib.crc32(ids), total, task, sequence, offset,
                             is_open, kept))
                offset += size
            sequence += 1

        def taken(key_kind):
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            kinds = [key_kind, *[pa.int64()] * 7, pa.bool_(), pa.binary()]
            out = [pa.array(c, t) for c, t in zip(columns, kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names)

        kind = pa.null()
        for batch in slices(batches, "text"):
            kind = batch.schema.field("key").type
            for k, ids in zip(batch.column("key").to_pylist(),
                              encoder.encode(strings(batch, "text"))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = (k, start, ids[4 * start:4 * (start + window)], total)
                    size = min(window, total - start)
                    gone = [piece] if size == window else windows.place(piece, size)
                    if gone:
                        emit(gone)
            yield taken(kind)
        for pieces in windows.open:
            emit(pieces, True)
        if rows:
            yield taken(kind)

    placed = staged(keyed.mapInArrow(run, schema), "packed")
    closed = placed.where("not open").withColumn(
        "sequence_id", F.shiftleft("task", SEQUENCE_BITS) + F.col("sequence")
    )
    left = placed.where("open").withColumn("team", F.expr(f"task div {MERGED_TASKS}"))
    merged_schema = (
        f"key {key_type}, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long, ids binary"
    )
    merged_names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                    "ids"]

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("task", "ascending"), ("sequence", "ascending"),
                               ("offset", "ascending")])
        rows, sequence, offset = [], MERGED + (group.column("team")[0].as_py() << 24), 0
        for r in group.select(["key", "start", "doc_tokens", "ids"]).to_pylist():
            start, ids = r["start"], r["ids"]
            while ids:
                part, ids = ids[:4 * (window - offset)], ids[4 * (window - offset):]
                size = len(part) // 4
                rows.append((r["key"], start, size, zlib.crc32(part), r["doc_tokens"], sequence,
                             offset, part if keep_ids else None))
                start, offset = start + size, offset + size
                if offset == window:
                    sequence, offset = sequence + 1, 0
        kinds = [group.schema.field("key").type, *[pa.int64()] * 6, pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], merged_names)

    merged = left.groupBy("team").applyInArrow(merge, merged_schema)
    pieces = closed.select(*merged_names).unionByName(merged)
    shown = merged_names if keep_ids else merged_names[:-1]
    return pieces.select(*shown).toDF(*unlike([key, *shown[1:]]))
