import base64
import hashlib
import tempfile

import pytest
import zstandard
from pyarrow import fs

from meterline.llm import warc

PAGE = "page_id long, url string, html string, bundle string, frame int"


def pages():
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<p>page {i}</p>" * (i % 7), "x", 1) for i in range(60)]
    return [*rows, (70, None, None, "x", 1), (71, "http://a b\r\nX: y", "", "x", 1), (72, "u", "é日本\r\n\r\nWARC/1.1\r\n", "x", 1), (73, "u", "long " * 90_000, "x", 1),
            rows[5], (None, "u", "no id", "x", 1), (None, "u", rows[3][2], "x", 1)]


def test_round_trip(spark):
    rows = pages()
    index = warc.write_bundles(spark.createDataFrame(rows, PAGE).repartition(3), frame_bytes=4096)
    got = warc.read_bundles(index).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, html, *_ in rows:
        if i is not None:
            largest[html or ""] = max(largest.get(html or "", -1), i)
    want = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        to = largest.get(html or "")
        revisit = to is not None and to != i
        want.append((i, "revisit" if revisit else "response", to if revisit else None, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), None if revisit else data))
    assert sorted([(r.id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload) if r.payload is not None else None) for r in got], key=str) == sorted(want, key=str)


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "same", "", 0), (2, "u", "same", "", 0), (3, "u", "longer same", "", 0), (4, "u", "longer same", "", 0)]
    got = {r.id: r.record_type for r in warc.read_bundles(warc.write_bundles(spark.createDataFrame(rows, PAGE), revisit_bytes=5)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_bundles_are_plain_zstandard_and_seekable(spark):
    index = warc.write_bundles(spark.createDataFrame(pages()[:40], PAGE).coalesce(1), frame_bytes=600)
    records = index.collect()
    uri = records[0].bundle
    store, path = fs.FileSystem.from_uri(uri)
    data = store.open_input_file(path).read()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\nWARC-Type") == 40
    reader = warc.Bundles()
    assert max(r.frame for r in records) > 3
    for r in records:
        assert reader.frame(uri, r.frame)[r.offset:r.offset + r.length].startswith(b"WARC/1.1")
    assert b"".join(reader.frame(uri, k) for k in range(max(r.frame for r in records) + 1)) == whole


def test_fetch_by_id(spark):
    index = warc.write_bundles(spark.createDataFrame(pages(), PAGE).repartition(2), frame_bytes=2000)
    got = warc.fetch(index, spark.createDataFrame([(7,), (33,), (999,)], "id long")).collect()
    assert sorted(r.id for r in got) == [7, 33]
    assert all(warc.record_uri(r.id).encode() in bytes(r.record) for r in got)


def test_damage_is_noticed():
    record = warc.make_record(1, "u", b"payload", warc.base32_sha1(b"payload"), None, False)
    head, block, end = warc.parse_record(record, 0)
    assert end == len(record) and warc.split_http(block) == (7, b"payload")
    with pytest.raises(ValueError):
        warc.parse_record(b"HTTP/1.1 200\r\n\r\n", 0)


def test_empty(spark):
    index = warc.write_bundles(spark.createDataFrame([], PAGE), tempfile.mkdtemp(prefix="meterline-test-"))
    assert index.count() == 0 and warc.read_bundles(index).count() == 0
