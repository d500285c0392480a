import hashlib
import struct

import pytest
import zstandard

from quayside.llm import warc


def records(n):
    html = "<html><body><p>shared start of every page</p>" + "lorem ipsum dolor " * 40
    pages = [(i, f"http://a.example/{i}", (html + str(i) * 50).encode()) for i in range(n)]
    return [warc.to_record(i, u, p, warc.sha1_base32(p), None) for i, u, p in pages]


@pytest.mark.parametrize("n", [0, 1, 5, 600])
def test_archive_round_trip(n):
    made = records(n)
    content = warc.to_archive(made)
    assert list(warc.read_archive(content)) == made
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D and (size > 0) == (n == 600)
    # Each record is a frame of its own that any reader with the dictionary can unpack.
    words = zstandard.ZstdCompressionDict(content[8 : 8 + size]) if size else None
    if n:
        assert zstandard.ZstdDecompressor(dict_data=words).decompress(content[8 + size :], read_across_frames=False) == made[0]
    if n == 600:
        plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in made)
        assert len(content) - size < plain


def test_damage_is_noticed():
    content = warc.to_archive(records(5))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(content[:-10]))
    record = bytearray(records(1)[0])
    record[-8] ^= 1
    with pytest.raises(ValueError):
        warc.parse_record(bytes(record))


def test_ids():
    for page_id in (0, 5, -3, 2**63 - 1, -(2**63)):
        assert warc.page_of(warc.record_id(page_id, "X")) == page_id
    assert warc.page_of(warc.record_id(None, "X")) is None


def test_awkward_pages(spark):
    long = "<p>" + "x y " * 300_000
    rows = [
        (1, "http://a/1", "same", "x"), (2, None, "same", "x"), (2, "http://a/\r\n2", "same", "x"), (None, "u", "same", "x"),
        (3, "http://a/3", None, "x"), (9, "http://a/9", "", "x"), (4, "http://a/4", long, "x"), (None, None, None, None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string")
    got = warc.archive_pages(pages).collect()
    assert len(got) == 8
    for r in got:
        if r["record_type"] == "response":
            html = bytes(r["payload"])
            assert r["payload_digest"] == warc.sha1_base32(html) and r["payload_bytes"] == len(html)
    find = lambda i: [(r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got if r["page_id"] == i]
    assert find(1) == [("revisit", 2, 4)] and find(2) == [("response", None, 4)] * 2
    assert find(3) == [("revisit", 9, 0)] and find(9) == [("response", None, 0)]
    assert find(4)[0][2] == len(long)
    assert sorted(x[0] for x in find(None)) == ["response", "response"]
    assert {r["url"] for r in got if r["page_id"] == 2} == {None, "http://a/%0D%0A2"}
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_several_archives(spark, sf_dir):
    from quayside.session import work_dir

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = work_dir(spark, "warc")
    manifest = warc.write_archives(pages, path, archive_bytes=50_000)
    assert manifest.count() > 1 and manifest.agg({"n_records": "sum"}).first()[0] == pages.count()
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, path, manifest).collect() if r["payload"] is not None}
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert {i: want[i] for i in back} == back
    assert {hashlib.sha1(x).digest() for x in back.values()} == {hashlib.sha1(x).digest() for x in want.values()}
    short = warc.archive_pages(pages.withColumn("html", pages["html"].substr(1, 1)))
    assert short.count() == pages.count()
