"""WARC archives: round trips, ranges of any size, false magic, damage, and the SQL twin."""

import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import warc
from gaugeworks.llm.catalogue import QUERIES, SQL
from gaugeworks.session import scratch_folder
from tools.check import connect, rows

BIG, SMALL = "ä page of text. " * 100, "<p>short</p>"
PAGES = [(5, "http://a/5", BIG), (9, "http://a/9", BIG), (2, None, BIG), (9, "http://a/9", BIG), (1, "x y\r\nWARC-Type: evil", SMALL), (3, "", SMALL),
         (4, "u", None), (6, "u", ""), (None, "u", BIG), (None, "u", "only without an id " * 90), (None, None, "only without an id " * 90),
         (7, "u", "WARC/1.1\r\n\r\n" * 200), (8, "u", "\x1f\x8b\x08" * 900), (10, "u", "z" * 999), (11, "u", "z" * 999), (12, "u", "z" * 1000), (13, "u", "z" * 1000)]


def pages_of(spark, data=PAGES):
    clashes = [F.lit("clash").alias(c) for c in ("id", "payload", "sha1", "place", "refers_to", "size", "hash", "path", "length", "maybe")]
    return spark.createDataFrame(data, "page_id long, url string, html string").repartition(3).select("*", *clashes)


def wanted(data, least=1000):
    out, largest = [], {}
    for i, _, html in data:
        h = (html or "").encode()
        if i is not None and len(h) >= least:
            largest[h] = max(i, largest.get(h, i))
    for i, _, html in data:
        h = (html or "").encode()
        again = largest.get(h, i) != i
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response", largest[h] if again else None))
    return sorted(out, key=repr)


def number(text):
    return int(text) if text else None


def read(spark, manifest, **how):
    found = warc.read_archives(spark, manifest, **how).collect()
    return sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found), key=repr)


@pytest.fixture(scope="module")
def manifest(spark):
    return warc.write_archives(pages_of(spark), f"{scratch_folder(spark)}/warc-test", file_bytes=1500)


@pytest.mark.parametrize("range_bytes", [1, 7, 333, 5000, 1 << 30])
def test_every_record_is_read_once_whatever_the_ranges(spark, manifest, range_bytes):
    few = manifest if range_bytes > 7 else manifest.limit(2)
    got = read(spark, few, range_bytes=range_bytes)
    assert got == (wanted(PAGES) if range_bytes > 7 else read(spark, few))


def test_manifest_and_payloads(spark, manifest):
    assert manifest.count() > 2 and manifest.agg(F.sum("n_records")).first()[0] == len(PAGES)
    found = warc.read_archives(spark, manifest, payload=True)
    responses = found.where("record_type = 'response'").collect()
    assert all(r.payload is None for r in found.where("record_type = 'revisit'").collect())
    held = {(i, html or "") for i, _, html in PAGES}
    assert all((number(r.record_id), r.payload.decode()) in held for r in responses)
    assert len(responses) == sum(kind == "response" for _, _, _, kind, _ in wanted(PAGES))
    uris = {r.target_uri for r in found.where("record_id = '1'").collect()}
    assert uris == {"x%20y%0D%0AWARC-Type:%20evil"}
    listed = warc.archives_below(spark, f"{scratch_folder(spark)}/warc-test")
    assert read(spark, listed) == wanted(PAGES)


def test_empty_table(spark):
    manifest = warc.write_archives(pages_of(spark, []), f"{scratch_folder(spark)}/warc-none")
    assert manifest.count() == 0 and warc.read_archives(spark, manifest).count() == 0


def test_members_inside_a_payload_and_noise_are_no_records():
    inner = warc.member(b"not a record at all") + b"\x1f\x8b\x08\x00 noise \x1f" + b"\x1f\x8b" * 50
    sha1 = hashlib.sha1(inner).digest()
    whole = [warc.record(str(k), "u", inner, len(inner), sha1, None, "d") for k in range(5)]
    data = b"".join(warc.member(x, level=0) for x in whole)  # stored as it is, so the magic shows
    assert data.count(warc.MAGIC) > 200
    for size in (1, 13, 100, 10_000):
        found = [r for start in range(0, len(data), size) for r in warc.records_in(io.BytesIO(data), start, min(len(data), start + size), payload=True)]
        assert [r.head["warc-record-id"] for r in found] == [f"<urn:page:{k}>" for k in range(5)]
        assert all(r.payload == inner for r in found)


def test_long_payloads_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 512)
    payload = b"".join(b"%d " % (k * k) for k in range(60_000))
    data = warc.member(warc.record("1", None, payload, len(payload), hashlib.sha1(payload).digest(), None, "d"))
    found, = warc.records_in(io.BytesIO(data), 0, len(data))
    assert (found.size, found.digest, found.payload) == (len(payload), hashlib.sha1(payload).hexdigest(), None)


def test_damage_is_an_error():
    data = warc.member(warc.record("1", None, b"text" * 100, 400, hashlib.sha1(b"text" * 100).digest(), None, "d"))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_in(io.BytesIO(data[:-3]), 0, len(data)))
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records_in(io.BytesIO(data[:-6] + b"\0" + data[-5:]), 0, len(data)))
    with pytest.raises(ValueError, match="no record"):
        list(warc.records_in(io.BytesIO(data + warc.member(b"something else\r\n\r\n")), 0, len(data) + 10))
    assert zlib.decompressobj(31).decompress(data).startswith(b"WARC/1.1\r\n")


def test_warc_query(spark, sf):
    df = QUERIES["op12_warc"](spark, sf)
    cursor = connect(sf).execute(SQL["op12_warc"])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in cursor.description], cursor.fetchall())
    assert dict(df.dtypes)["page_id"] == "bigint" and dict(df.dtypes)["refers_to"] == "bigint"
