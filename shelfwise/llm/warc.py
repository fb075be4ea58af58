"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some whole WARC records, and ends with
a seek table in a skippable frame (the public seekable format): sizes of all frames, their number,
and a closing magic number. One ranged read from the end of the file gives the table; a record needs
one more, of its frame. The index of a set of bundles maps record identifiers to frames and offsets
inside them.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import read_range, slices, write_file
from shelfwise.session import BROADCAST_LIMIT_BYTES, compute_slots, scratch_path, staged

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
# Equal payloads of this size are stored once.
LEAST_REVISIT = 100
DATE = "2020-01-01T00:00:00Z"

# Fixed numbers of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = "<IBI"
ENTRY = "<II"

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


KEYS = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(),
        "string": pa.string()}


def identifier(key, digest: str) -> str:
    """A record's name: its key, with all but plain characters written as ``%xx``, and the digest of
    its payload. Rows that share a key have names of their own unless they are the same. A null key
    is left out."""
    known = "" if key is None else ":" + quote(str(key), safe="")
    return f"<urn:page:{digest}{known}>"


def record(kind: str, key, url: str | None, payload: bytes, size: int, digest: str, refers) -> bytes:
    """One WARC record. A revisit has the HTTP head alone; ``size`` is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {identifier(key, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {identifier(refers, digest)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(header fields, payload, end) of the record at an offset; http-length is the HTTP head's."""
    split = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:split].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    end = split + 4 + int(fields["content-length"])
    body = data.index(b"\r\n\r\n", split + 4) + 4
    for line in data[split + 4:body].decode().split("\r\n"):
        if line.lower().startswith("content-length: "):
            fields["http-length"] = line.split(": ", 1)[1]
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return fields, data[body:end], end + 4


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        fields, payload, at = parsed(data, at)
        yield fields, payload


class Bundle:
    """Builds one bundle: whole records into frames, frames and a seek table into bytes."""

    def __init__(self):
        import zstandard

        self._press = zstandard.ZstdCompressor(level=3).compress
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._open_size = 0
        self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Adds a record; gives its frame and its offset in the frame."""
        if self._open and self._open_size + len(data) > FRAME_BYTES:
            self._close()
        place = len(self._frames), self._open_size
        self._open.append(data)
        self._open_size += len(data)
        return place

    def _close(self) -> None:
        frame = self._press(b"".join(self._open))
        self._frames.append(frame)
        self._sizes.append((len(frame), self._open_size))
        self.size += len(frame)
        self._open, self._open_size = [], 0

    def finish(self) -> bytes:
        if self._open:
            self._close()
        table = b"".join(struct.pack(ENTRY, *s) for s in self._sizes)
        table += struct.pack(FOOTER, len(self._sizes), 0, SEEKABLE)
        return b"".join(self._frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(uri: str) -> list[tuple[int, int]]:
    """(place in the file, compressed size) of every frame, from the end of a bundle."""
    foot = struct.calcsize(FOOTER)
    number, descriptor, magic = struct.unpack(FOOTER, read_range(uri, -foot))
    if magic != SEEKABLE or descriptor:
        raise ValueError(f"{uri} has no seek table")
    size = number * struct.calcsize(ENTRY) + foot
    found, at = [], 0
    for packed, _ in struct.iter_unpack(ENTRY, read_range(uri, -size)[:-foot]):
        found.append((at, packed))
        at += packed
    return found


def read_frame(uri: str, place: int, size: int) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(read_range(uri, place, size))


def described(pages: DataFrame, html: str, key: str, url: str) -> DataFrame:
    """key, url, payload, size, digest, and refers: the key of the record that has the payload."""
    rows = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    first = (
        rows.where(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
        .where("copies > 1").select(F.col("digest").alias("known"), "least")
    )
    # Repeated payloads are few beside the payloads; these stay where they are unless the list is too
    # long to be sent.
    first = staged(first, "warc-repeated")
    few = first.count() * 256 <= BROADCAST_LIMIT_BYTES
    other = F.col("least").isNotNull() & ~F.col("least").eqNullSafe(F.col("key"))
    sent = F.broadcast(first) if few else first
    return rows.join(sent, F.col("digest") == F.col("known"), "left").select(
        "key", "url", "payload", "size", "digest", other.alias("revisit"),
        F.when(other, F.col("least")).alias("refers"),
    )


def write(
    pages: DataFrame,
    html: str = "html",
    key: str = "page_id",
    url: str = "url",
    folder: str | None = None,
) -> DataFrame:
    """Writes one record per row into bundles and gives their index: key, path, frame, offset, size.

    Of equal payloads of 100 bytes or more, the row with the smallest key is a response and the
    others revisit it; rows that share that key are all responses, null keys count as larger than
    any. A null payload is empty. Keys are whole numbers or strings, any string at all; null and the
    empty string differ. An empty table gives an empty index. Files of attempts that failed may lie
    in the folder; the index names the valid ones only. Other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = described(pages, html, key, url)
    key_type = rows.schema["key"].dataType.simpleString()
    _checked(key_type)
    names = ["key", "path", "frame", "offset", "size"]

    def run(batches):
        bundle, name, index, kind = Bundle(), f"{uuid.uuid4().hex}.warc.zst", [], pa.null()

        def finish():
            write_file(folder, name, bundle.finish())
            columns = list(zip(*index))
            kinds = [kind, pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names
            )

        for batch in slices(batches, "payload"):
            kind = batch.schema.field("key").type
            for r in batch.to_pylist():
                data = record(
                    "revisit" if r["revisit"] else "response", r["key"], r["url"], r["payload"],
                    r["size"], r["digest"], r["refers"],
                )
                frame, offset = bundle.add(data)
                index.append((r["key"], f"{folder}/{name}", frame, offset, len(data)))
                if bundle.size > BUNDLE_BYTES:
                    yield finish()
                    bundle, name, index = Bundle(), f"{uuid.uuid4().hex}.warc.zst", []
        if index:
            yield finish()

    schema = f"key {key_type}, path string, frame long, offset long, size long"
    return staged(rows.mapInArrow(run, schema), "warc-index").withColumnRenamed("key", key)


READ = "payload_bytes long, payload_digest string, record_type string, refers_to {key}, url string"


def _row(fields: dict[str, str], payload: bytes, key_of) -> tuple:
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
    refers = fields.get("warc-refers-to")
    return (
        key_of(fields["warc-record-id"]), int(fields["http-length"]), digest, kind,
        key_of(refers) if refers else None, fields.get("warc-target-uri"), payload,
    )


def _checked(key_type: str) -> None:
    if key_type not in KEYS:
        raise ValueError(f"keys have to be of one of the types {', '.join(KEYS)}, not {key_type}")


def _key_of(key_type: str):
    _checked(key_type)

    def key_of(name):
        _, known, value = name.removeprefix("<urn:page:").removesuffix(">").partition(":")
        return None if not known else unquote(value) if key_type == "string" else int(value)

    return key_of


def _batch(rows: list[tuple], names: list[str], key_type: str) -> pa.RecordBatch:
    kind = KEYS[key_type]
    kinds = [kind, pa.int64(), pa.string(), pa.string(), kind, pa.string(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def read(index: DataFrame, key: str = "page_id") -> DataFrame:
    """Every record of the bundles that an index names: key, payload_bytes, payload_digest,
    record_type, refers_to, url, payload (null for revisits). Digests are verified. Records come in no
    set order, repeated ones each; an empty index gives no rows."""
    key_type = index.schema[key].dataType.simpleString()
    names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    key_of = _key_of(key_type)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for place, size in seek_table(path):
                    rows = [_row(f, p, key_of) for f, p in records(read_frame(path, place, size))]
                    rows = [r if r[3] == "response" else (*r[:6], None) for r in rows]
                    yield _batch(rows, names, key_type)

    files = staged(index.select("path").distinct(), "warc-files")
    dealt = files.repartition(compute_slots(index.sparkSession, files.count()))
    return dealt.mapInArrow(run, f"`{key}` {key_type}, {READ.format(key=key_type)}, payload binary")


def fetch(index: DataFrame, keys: DataFrame, key: str = "page_id") -> DataFrame:
    """The records of some keys, as ``read`` gives them; only their frames are read, each once by a
    task.

    ``keys`` has a column named like the index's key. A record of the null key is never fetched, an
    unknown key gives no row, a repeated one no more than once.
    """
    key_type = index.schema[key].dataType.simpleString()
    names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    key_of = _key_of(key_type)

    def run(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        path, table = None, []
        for (own, frame), places in groupby(rows, key=lambda r: (r["path"], r["frame"])):
            if own != path:
                path, table = own, seek_table(own)
            data, found = read_frame(path, *table[frame]), []
            for r in places:
                fields, payload, _ = parsed(data, r["offset"])
                row = _row(fields, payload, key_of)
                found.append(row if row[3] == "response" else (*row[:6], None))
            yield _batch(found, names, key_type)

    wanted = index.join(keys.select(f"`{key}`").distinct(), [key], "left_semi")
    # The frames of a file come together.
    dealt = wanted.repartition("path", "frame").sortWithinPartitions("path", "frame", "offset")
    return dealt.mapInArrow(run, f"`{key}` {key_type}, {READ.format(key=key_type)}, payload binary")
