"""Snapshots of the ledger: the manifest of many batches in few files, laid out for skipping.

A snapshot holds the manifest rows of the batches that were complete when it was made, by day and sorted
by stream, with the bounds of each file's offsets, and the list of these batches. Readers take
the newest complete snapshot and the ledger of the batches that it does not have. Nothing is
removed or replaced: jobs that land or make snapshots at the same time do not disturb each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.landing import LEDGER, MANIFEST

#: Manifest rows of a snapshot's file.
FILE_ROWS = 500_000
BOUNDS = ["day", "low", "high"]


def _glob(spark: SparkSession, pattern: str) -> list[JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath() for f in found or []]


def _batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Batches whose ledger is complete, by the marks that Spark's committer leaves; names only."""
    found = []
    for mark in _glob(spark, f"{path}/ledger/run_id=*/batch_id=*/_SUCCESS"):
        batch = mark.getParent()
        found.append((batch.getParent().getName().split("=", 1)[1], int(batch.getName().split("=", 1)[1])))
    return sorted(found)


def _newest(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete snapshot; its list of batches is written last."""
    marks = _glob(spark, f"{path}/snapshots/*/batches/_SUCCESS")
    return max((m.getParent().getParent().getName() for m in marks), default=None)


def _bounded(rows: DataFrame) -> DataFrame:
    """Manifest rows with the day of their object and the bounds of their offsets."""
    keyed = F.regexp_extract("object_key", r"^.*/ingest_year_month_day=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1)
    sealed = F.to_date(F.timestamp_micros(F.coalesce("sealed_us", "created_us")))  # without an object
    day = F.coalesce(F.nullif(keyed, F.lit("")).try_cast("date"), sealed)
    low = F.array_min(F.transform("offsets", lambda r: r["start"]))
    high = F.array_max(F.transform("offsets", lambda r: r["end"]))
    return rows.withColumns({"day": day, "low": low, "high": high})


def _columns(spark: SparkSession) -> list[str]:
    return ["run_id", "batch_id", *spark.createDataFrame([], MANIFEST).columns, *BOUNDS]


def _ledger_of(spark: SparkSession, path: str, batches: list[tuple[str, int]]) -> DataFrame:
    """Manifest rows of some batches; only their folders are read."""
    schema = f"{LEDGER}, run_id STRING, batch_id BIGINT"
    if not batches:
        rows = spark.createDataFrame([], schema)
    else:
        folders = [f"{path}/ledger/run_id={run}/batch_id={batch}" for run, batch in batches]
        rows = spark.read.schema(schema).option("basePath", f"{path}/ledger").parquet(*folders)
    return _bounded(rows.where("kind = 'manifest'")).select(_columns(spark))


def _snapshot(spark: SparkSession, path: str, name: str | None) -> tuple[DataFrame, set[tuple[str, int]]]:
    """The rows of a snapshot and the batches that they are of."""
    empty = _ledger_of(spark, path, [])
    if name is None:
        return empty, set()
    root = f"{path}/snapshots/{name}"
    # Given the schema, a snapshot without any file can be read too.
    rows = spark.read.schema(empty.schema).parquet(f"{root}/files").select(empty.columns)
    held = spark.read.schema("run_id STRING, batch_id BIGINT").parquet(f"{root}/batches").collect()
    return rows, {(r["run_id"], r["batch_id"]) for r in held}


def write_snapshot(spark: SparkSession, path: str, file_rows: int = FILE_ROWS) -> str | None:
    """Folds the ledger of all complete batches into a new snapshot; its name, None if there is nothing new.

    Reads the snapshot before and the ledger since. A snapshot that is not finished is never read,
    and of two that are made at once either is whole.
    """
    before = _newest(spark, path)
    rows, held = _snapshot(spark, path, before)
    batches = _batches(spark, path)
    fresh = [b for b in batches if b not in held]
    if not fresh:
        return None
    number = int(before.split("-")[0]) + 1 if before else 1
    name = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    root = f"{path}/snapshots/{name}"
    folded = rows.unionByName(_ledger_of(spark, path, fresh))
    parts = max(1, -(-folded.count() // file_rows))
    # By ranges of day and stream, so that a file covers few of them.
    dealt = folded.repartitionByRange(parts, "day", "stream_id").sortWithinPartitions("day", "stream_id", "low")
    dealt.write.partitionBy("day").parquet(f"{root}/files")
    covered = spark.createDataFrame(sorted(held | set(fresh)), "run_id STRING, batch_id BIGINT")
    covered.coalesce(1).write.parquet(f"{root}/batches")
    return name


def landed_files(
    spark: SparkSession,
    path: str,
    days: tuple[str, str] | None = None,
    streams: Iterable[str] | None = None,
    offsets: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """The manifest, by snapshot and tail, of all files or those that may hold what is asked for.

    `days` are the first and the last day of the objects (YYYY-MM-DD), `streams` stream ids and
    `offsets` a topic, a partition and its first and last offset. Days are folders of the
    snapshot; streams and offset bounds are in its files' statistics, so that others are
    not read. Rows equal those of `manifest`, with `day`, `low` and `high` at the end.
    """
    rows, held = _snapshot(spark, path, _newest(spark, path))
    tail = _ledger_of(spark, path, [b for b in _batches(spark, path) if b not in held])
    asked = _asked(days, streams, offsets)
    return rows.where(asked).unionByName(tail.where(asked))


def _asked(
    days: tuple[str, str] | None, streams: Iterable[str] | None, offsets: tuple[str, int, int, int] | None
) -> Column:
    asked = F.lit(True)
    if days:
        first, last = (F.lit(d).cast("date") for d in days)
        asked &= F.col("day").between(first, last)
    if streams is not None:
        asked &= F.col("stream_id").isin(list(streams))
    if offsets:
        topic, partition, first, last = offsets
        asked &= (F.col("low") <= last) & (F.col("high") >= first)
        asked &= F.exists(
            "offsets",
            lambda r: (r["topic"] == topic) & (r["partition"] == partition) & (r["start"] <= last) & (r["end"] >= first),
        )
    return asked
