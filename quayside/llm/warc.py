"""WARC archives compressed record by record with a Zstandard dictionary of their own."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import stage
from quayside.session import work_dir
from quayside.sinks.objects import open_store, put

# Fixed values of the formats: the skippable frame that holds a dictionary, and the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: An archive is closed once its records have so many bytes before compression.
ARCHIVE_BYTES = 32 << 20
#: A dictionary is built from records spread over its archive, of so many bytes in all.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
CHUNK = 64 << 10
MAX_RETRIES = 3
#: Tasks that read archives, at most; each reads one archive after the other.
READ_TASKS = 10_000

MANIFEST = "archive string, n_records long, raw_bytes long, stored_bytes long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    """A page's record name; it holds the page_id, which a reader gets back from it."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, digest)}>"
    return f"<urn:uuid:{uuid.UUID(int=page_id % 2**64)}>"


def page_of(name: str | None) -> int | None:
    if name is None:
        return None
    number = uuid.UUID(name[10:-1]).int
    if number >> 64:
        return None
    return number - 2**64 if number >= 2**63 else number


def to_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: the whole response, or the headers of one that revisits `refers_to`."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines += [f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        # A line end in an address would end the header.
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError("a payload does not agree with its digest")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields.get("WARC-Refers-To")),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
    }


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(records: list[bytes]) -> bytes:
    """A dictionary from records at even distances; empty where they are too few to build one."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = [r[: 64 << 10] for r in records[::step]]
    if len(samples) < 8 or sum(map(len, samples)) < 8 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8, steps=1).as_bytes()
    except zstandard.ZstdError:  # samples too much alike or too short
        return b""


def to_archive(records: list[bytes], level: int = LEVEL) -> bytes:
    """A skippable frame with the dictionary, then each record as a frame of its own."""
    learned = train(records)
    known = zstandard.ZstdCompressionDict(learned) if learned else None
    if known:
        known.precompute_compress(level=level)
    pack = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True).compress
    lead = struct.pack("<II", DICTIONARY_FRAME, len(learned)) + learned
    return b"".join([lead, *map(pack, records)])


def read_archive(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one by one."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    learned, at = content[8 : 8 + size], 8 + size
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learned) if learned else None)
    while at < len(content):
        one, parts = unpack.decompressobj(), []
        while not one.eof:
            chunk = content[at : at + CHUNK]
            if not chunk:
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(chunk))
            at += len(chunk)
        at -= len(one.unused_data)
        yield b"".join(parts)


def plan(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_digest (hex) and refers_to of each page.

    Of pages with equal payloads, that with the largest page_id is the response and the others
    refer to it. Payloads shorter than `min_payload_bytes` and pages without page_id are always
    responses; so are all rows that share the largest page_id.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload"))
    # Only digests that occur twice are joined back: narrow rows, summed before they are dealt out.
    largest = (
        rows.filter(F.octet_length("payload") >= min_payload_bytes)
        .groupBy(F.col("payload_digest").alias("__digest"))
        .agg(F.max("page_id").alias("__largest"), F.count("page_id").alias("__n"))
        .filter("__n > 1")
    )
    refers = F.when(F.col("__largest") > F.col("page_id"), F.col("__largest"))
    return rows.join(largest, rows["payload_digest"] == largest["__digest"], "left").select(
        "page_id", "url", "payload", "payload_digest", refers.alias("refers_to")
    )


def write_archives(pages: DataFrame, path: str, min_payload_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page below `path` and returns the manifest, a row per archive.

    Null html is an empty payload. Tasks hold the records of one archive at a time. A name belongs
    to one attempt of a task and only archives in the manifest count, so repeated tasks add nothing.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            content = to_archive(held)
            name = f"{uuid.uuid4().hex}.warc.zst"
            put(store, f"{folder}/{name}", content, MAX_RETRIES)
            row = {"archive": [name], "n_records": [len(held)], "raw_bytes": [size], "stored_bytes": [len(content)]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "payload_digest", "refers_to")), strict=True):
                page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                held.append(to_record(page_id, url, payload, digest, refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    held.clear()
                    size = 0
        if held:
            yield close()

    return stage(plan(pages, min_payload_bytes).mapInArrow(write, MANIFEST), "archives")


def read_archives(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """The records of the archives in `manifest`; payloads of responses are held against their digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        names = RECORD.split(", ")
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n.split()[0], types[n.split()[1]]) for n in names])
        for batch in batches:
            for name in batch["archive"].to_pylist():
                with store.open_input_file(f"{folder}/{name}") as source:
                    content = source.read()
                rows: list[dict] = []
                for record in read_archive(content):
                    rows.append(parse_record(record))
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # A set number of partitions is not merged again: the rows are small, the archives are not.
    dealt = manifest.select("archive").repartition(min(READ_TASKS, max(1, manifest.count())))
    return dealt.mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Archives all pages and reads the archives back: a row per page, as the records say.

    page_id, payload_bytes, payload_digest (base32 SHA-1), record_type, refers_to, url, payload.
    """
    spark = pages.sparkSession
    path = path or work_dir(spark, "warc")
    return read_archives(spark, path, write_archives(pages, path))
