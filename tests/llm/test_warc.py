import hashlib
import io

import pytest
import zstandard
from helpers import SMALL, rows_of

from shelfwise.llm import queries, warc

ROWS = [
    (5, "http://a/é x\r\ny", "é" * 60), (3, None, "é" * 60), (None, "u", "é" * 60), (7, "u", "é" * 60),
    (3, "u", "é" * 60), (8, "u", "small"), (9, "u", "small"), (10, "u", None), (11, "u", ""),
    (12, "u", "WARC/1.1\r\n\r\nx\r\n\r\n" * 50_000), (None, "u", "only null id " * 20),
]


def plain(rows):
    least = {}
    for k, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and k is not None:
            least[data] = min(k, least.get(data, k))
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        refers = least.get(data)
        revisit = refers is not None and refers != k
        out.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    refers if revisit else None))
    return out


def frame_of(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], "page_id long, url string, html string, size int, digest string")


def test_round_trip_and_fetch(spark):
    frame = frame_of(spark).repartition(2)
    index = warc.write(frame)
    back = warc.read(index)
    assert rows_of(back.drop("url", "payload")) == sorted(plain(ROWS), key=repr)
    texts = {(k, h or "") for k, _, h in ROWS}
    for r in back.collect():
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or (r.page_id, bytes(r.payload).decode()) in texts
    some = spark.createDataFrame([(3,), (8,), (404,)], "page_id long")
    got = rows_of(warc.fetch(index, some))
    assert got == sorted((tuple(r) for r in back.collect() if r.page_id in (3, 8)), key=repr)
    assert warc.read(warc.write(frame.limit(0))).count() == 0


def test_bundle_is_plain_zstandard_with_a_seek_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    index = warc.write(frame_of(spark).coalesce(1), folder=str(tmp_path / "w")).collect()
    paths = {r.path for r in index}
    assert len(paths) == 1
    data = open(paths.pop(), "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(list(warc.records(whole))) == len(ROWS)
    assert max(r.frame for r in index) > 2
    table = warc.seek_table(index[0].path)
    for r in index:
        frame = warc.read_frame(r.path, *table[r.frame])
        fields, _, end = warc.parsed(frame, r.offset)
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        assert fields["warc-record-id"] == warc.identifier(r.page_id, digest)
        assert end == r.offset + r.size


KEYS = ["a\r\nWARC-Type: x", "", None, "é:%/>", "7", "x" * 5000, "<urn:page:1>", "a\r\nWARC-Type: x"]


def test_any_string_is_a_key(spark):
    rows = [(k, "u", f"page {i} " * 20 if i % 2 else "one page for many " * 9) for i, k in enumerate(KEYS)]
    frame = spark.createDataFrame(rows, "page_id string, url string, html string")
    index = warc.write(frame)
    back = warc.read(index)
    assert rows_of(back.drop("url", "payload")) == sorted(plain(rows), key=repr)
    some = spark.createDataFrame([(k,) for k in KEYS if k is not None] * 2, "page_id string")
    assert warc.fetch(index, some).count() == len(KEYS) - 1


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int"])
def test_short_numbers_as_keys(spark, kind):
    rows = [(i % 50, "u", f"page {i % 7} " * 20) for i in range(60)] + [(None, "u", "")]
    frame = spark.createDataFrame(rows, f"page_id {kind}, url string, html string")
    back = warc.read(warc.write(frame))
    assert back.schema["page_id"].dataType.simpleString() == kind
    assert rows_of(back.drop("url", "payload")) == sorted(plain(rows), key=repr)


def test_other_keys_are_refused(spark):
    frame = spark.createDataFrame([(1.5, "u", "x")], "page_id double, url string, html string")
    with pytest.raises(ValueError, match="double"):
        warc.write(frame)


def test_payloads_are_not_shuffled(spark):
    described = warc.described(frame_of(spark), "html", "page_id", "url")
    plan = described._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_query_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    assert rows_of(queries.op3_warc(spark, SMALL)) == sorted(plain(pages), key=repr)
