"""Object keys of landed files."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.routing import DELIMITER


def escape_part(part: Column) -> Column:
    """A part that is one safe path segment: no separators, no `.` or `..`, not empty."""
    for found, put in (("%", "%25"), ("/", "%2F"), ("\x00", "%00")):
        part = F.replace(part, F.lit(found), F.lit(put))
    return F.when(part == "", "%").otherwise(F.regexp_replace(part, r"^\.", "%2E"))


def object_prefix(parts: Column, escape: bool = False) -> Column:
    """Stream parts as a path. Unescaped by default: a `/` in a header adds a level."""
    return F.array_join(F.transform(parts, escape_part) if escape else parts, "/")


def object_key(parts: Column, sealed_at: Column, suffix: Column, escape: bool = False) -> Column:
    """`<parts>/ingest_year_month_day=<day>/<second>-<suffix>.jsonl.zst`, in UTC.

    `sealed_at` is an instant (TIMESTAMP); the result does not depend on the session zone.
    """
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    seconds = F.floor(F.unix_micros(sealed_at) / 1_000_000)
    utc = (epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).cast("string")
    day = F.substring(utc, 1, 10)
    second = F.concat(day, F.lit("T"), F.substring(utc, 12, 8), F.lit("Z"))
    return F.concat(
        object_prefix(parts, escape),
        F.lit("/ingest_year_month_day="),
        day,
        F.lit("/"),
        second,
        F.lit("-"),
        suffix,
        F.lit(".jsonl.zst"),
    )


def file_suffix(run_id: Column, batch_id: Column, shard: Column, stream: Column, file_seq: Column) -> Column:
    """Eight hex characters that are the same again when a task or a batch is rerun."""
    identity = F.concat_ws(
        "|", run_id, batch_id.cast("string"), shard.cast("string"), stream, file_seq.cast("string")
    )
    return F.substring(F.sha2(identity, 256), 1, 8)


def landed_suffix(stream: str, run_id: str, batch_id: int, shard: int, file_seq: int) -> str:
    """`file_suffix`, then shard and file number.

    A batch gives all its files one seal time, and a large stream has more files in it than
    eight hex characters can tell apart; the numbers make the name unique in the batch.
    """
    identity = f"{run_id}|{batch_id}|{shard}|{stream}|{file_seq}".encode()
    return f"{hashlib.sha256(identity).hexdigest()[:8]}-{shard}-{file_seq}"


def landed_key(stream: str, sealed_us: int, suffix: str, escape: bool) -> str:
    """The key of one file, for the writer task: same text as `object_key`."""
    parts = stream.split(DELIMITER)
    if escape:
        parts = [p.replace("%", "%25").replace("/", "%2F").replace("\x00", "%00") for p in parts]
        parts = ["%" if not p else "%2E" + p[1:] if p[0] == "." else p for p in parts]
    at = datetime.fromtimestamp(sealed_us // 1_000_000, tz=timezone.utc)
    name = f"{at:%Y-%m-%dT%H:%M:%SZ}-{suffix}.jsonl.zst"
    return "/".join([*parts, f"ingest_year_month_day={at:%Y-%m-%d}", name])
