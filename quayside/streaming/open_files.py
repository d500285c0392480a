"""Continuous landing whose open files live in the state store.

A file that is not full yet is a value state (where it stands) and two list states (its compressed
frames, its offset ranges) of its stream's key. A batch compresses the lines that it brought and
appends one frame; what came before is neither read nor written again until the file is full. Timers
close files that get no more records. State, timers and source offsets are committed together by
the checkpoint, so a restarted query goes on with the same files.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quayside.functions.keys import landed_key, landed_suffix
from quayside.functions.metrics import ratio_text
from quayside.operators.packing import Cursor, spans
from quayside.schema import OFFSET_RANGES
from quayside.sinks import landing
from quayside.sinks.landing import MANIFEST, LandingOptions, Range, batch_folder, merged
from quayside.sinks.objects import is_local, open_store, put
from quayside.streaming.landing import _drain_id, _exists, query_id, record_commits
from quayside.streaming.reports import observed

#: The query's id, as Spark hands it to the tasks of a streaming query.
_QUERY_ID = "sql.streaming.queryId"
#: Ledger rows on their way out of the state operator: nested columns are JSON.
_FLAT = f"kind STRING, {MANIFEST.replace(OFFSET_RANGES, 'STRING')}, reject STRING, fresh_lines BIGINT, fresh_bytes BIGINT"
_FIELDS = [c.strip().split(" ")[0] for c in _FLAT.split(",")]
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_CURSOR = "open BOOLEAN, filled BIGINT, created BIGINT, files BIGINT, records BIGINT, lines BIGINT, size BIGINT"
#: Keys over which rejects are dealt out in the state operator.
REJECT_KEYS = 256
_HELD = "topic STRING, partition INT, first BIGINT, last BIGINT"
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads what it changed, not the files of the store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

class _Objects:
    """Stores finished files of a run and describes them."""

    def __init__(self, path: str, run_id: str, options: LandingOptions):
        self.store, self.root = open_store(path)
        self.run_id, self.options = run_id, options
        self.escape = is_local(path) if options.escape_keys is None else options.escape_keys

    def seal(
        self, shard: int, stream: str, at: Cursor, records: int, lines: int, raw: int, content: bytes,
        offsets: list[Range], reason: str, named_us: int, sealed_us: int,
    ) -> dict:
        key, failed = None, 0
        if lines:
            # File numbers of a stream go on through the run, so they tell its files apart.
            suffix = landed_suffix(stream, self.run_id, 0, shard, at.files - 1)
            key = landed_key(stream, named_us, suffix, self.escape)
            about = landing.object_metadata(lines, raw, len(content))
            failed = put(self.store, f"{self.root}/objects/{key}", content, self.options.max_retries, metadata=about)
        row = _described(shard, stream, at, records, lines, raw, offsets, reason, sealed_us)
        status = "uploaded" if lines else "released"
        ratio = ratio_text(raw, len(content)) if lines else None
        return row | {
            "object_key": key, "compressed_size_b": len(content), "compression_ratio": ratio,
            "status": status, "failed_attempts": failed,
        }


def _described(
    shard: int, stream: str, at: Cursor, records: int, lines: int, raw: int,
    offsets: list[Range], reason: str, sealed_us: int,
) -> dict:
    named = [dict(zip(("topic", "partition", "start", "end"), r)) for r in merged(offsets)]
    return {
        "kind": "manifest", "shard": shard, "stream_id": stream, "file_seq": at.files - 1, "object_key": None,
        "record_count": records, "line_count": lines, "raw_size_b": raw, "compressed_size_b": 0,
        "compression_ratio": None, "seal_reason": reason, "created_us": at.created, "sealed_us": sealed_us,
        "status": "open", "failed_attempts": 0, "offsets": json.dumps(named), "reject": None,
    }


class OpenFiles(StatefulProcessor):
    """Packs the records of each (shard, stream) into files that stay open across batches.

    Takes a key's records of one batch at a time, which the source's limit per batch and the lanes
    bound. Yields ledger rows: one per finished file with all its offsets, one of status `open`
    per batch and stream with the offsets that it brought to the file still open, and the rejects.
    """

    def __init__(self, path: str, options: LandingOptions):
        self.path, self.options, self.rules = path, options, options.rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.objects = handle, None
        self.compressor = zstandard.ZstdCompressor(level=self.options.compression_level)
        self.cursor = handle.getValueState("cursor", _CURSOR)
        self.frames = handle.getListState("frames", "frame BINARY")
        self.held = handle.getListState("held", _HELD)

    def close(self) -> None:
        pass

    def _store(self) -> _Objects:
        if self.objects is None:
            run_id = TaskContext.get().getLocalProperty(_QUERY_ID)
            self.objects = _Objects(self.path, run_id, self.options)
        return self.objects

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        shard, stream = int(key[0]), key[1]
        if shard < 0:  # records without a stream
            for part in rows:
                yield _frame([{"kind": "reject", "reject": r} for r in part["reject"]])
            return
        batch = pd.concat(list(rows)).sort_values(["t", "topic", "partition", "offset"], kind="stable")
        now = int(batch["now"].iloc[0])
        payload = batch["payload"].tolist()
        size = np.array([len(p) if p is not None else 0 for p in payload], "i8")
        # Ages count from arrival, whatever a record's timestamp.
        t = batch["t"].to_numpy("i8") if self.rules.max_age_ms is None else np.full(len(batch), now, "i8")
        codes, names = pd.factorize(batch["topic"])
        names = list(names)
        partitions, offsets = batch["partition"].to_numpy("i8"), batch["offset"].to_numpy("i8")

        at, records, lines, raw = self._where()
        before = at
        found, after = spans(t, size, at, self.rules)
        out, part = [], landing._OpenFile(self.compressor)
        for s in found:
            if s.seq != at.files - 1 or not at.open:
                records = lines = raw = 0
            at = Cursor(True, 0, s.created, s.seq + 1)
            chosen = b"".join(p for p in payload[s.start : s.stop] if p)
            if chosen:
                part.write(memoryview(chosen), int(np.count_nonzero(size[s.start : s.stop])))
            if s.stop > s.start:
                part.add_offsets(names, codes[s.start : s.stop], partitions[s.start : s.stop], offsets[s.start : s.stop])
            if s.reason:
                total = (records + part.records, lines + part.lines, raw + part.raw)
                row = self._seal(shard, stream, at, *total, part, s.reason, now, s.sealed_us)
                out.append(row | {"fresh_lines": part.lines, "fresh_bytes": part.raw})
                part, at = landing._OpenFile(self.compressor), at._replace(open=False)
        if after.open and part.records:
            ranges = part.offset_ranges()
            if part.lines:
                self.frames.appendValue((part.finish(),))
            self.held.appendList(ranges)
            records, lines, raw = records + part.records, lines + part.lines, raw + part.raw
            row = _described(shard, stream, after, part.records, part.lines, part.raw, ranges, "open", now)
            out.append(row | {"fresh_lines": part.lines, "fresh_bytes": part.raw})
        if not after.open:
            records = lines = raw = 0
        self.cursor.update((after.open, after.filled, after.created, after.files, records, lines, raw))
        self._timer(before, after)
        if out:
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        shard, stream = int(key[0]), key[1]
        at, records, lines, raw = self._where()
        due = int(self.rules.due(np.int64(at.created)))
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        if not at.open or due > now:
            return
        row = self._seal(shard, stream, at, records, lines, raw, None, "dormant", now, due)
        self.cursor.update((False, 0, 0, at.files, 0, 0, 0))
        yield _frame([row])

    def _where(self) -> tuple[Cursor, int, int, int]:
        if not self.cursor.exists():
            return Cursor(), 0, 0, 0
        is_open, filled, created, files, records, lines, raw = self.cursor.get()
        return Cursor(is_open, filled, created, files), records, lines, raw

    def _seal(
        self, shard: int, stream: str, at: Cursor, records: int, lines: int, raw: int,
        part: landing._OpenFile | None, reason: str, now: int, sealed_us: int | None,
    ) -> dict:
        """The file's frames and ranges, those in the state first, become an object; the state is empty then."""
        content = b"".join(f[0] for f in self.frames.get()) if self.frames.exists() else b""
        ranges = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        if part is not None:
            content += part.finish()
            ranges += part.offset_ranges()
        self.frames.clear()
        self.held.clear()
        sealed_us = now if sealed_us is None else sealed_us
        return self._store().seal(shard, stream, at, records, lines, raw, content, ranges, reason, now, sealed_us)

    def _timer(self, before: Cursor, after: Cursor) -> None:
        if self.rules.max_age_ms is None:
            return
        due = lambda at: -(-int(self.rules.due(np.int64(at.created))) // 1000) if at.open else None
        old, new = due(before), due(after)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({k: pd.Series([r.get(k) for r in rows], dtype=object) for k in _FIELDS})


@contextmanager
def _state_store(spark: SparkSession):
    """The settings of the state store, for queries that are started or read meanwhile."""
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _unpacked(flat: DataFrame) -> DataFrame:
    nested = {"offsets": F.from_json("offsets", OFFSET_RANGES), "reject": F.from_json("reject", landing._REJECT, _TIMES)}
    return flat.withColumns(nested).drop("fresh_lines", "fresh_bytes")


def start_open_files(
    records: DataFrame,
    config: DataFrame,
    path: str,
    checkpoint: str,
    options: LandingOptions = LandingOptions(),
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Lands a stream of records until stopped, with open files in the state store.

    Arguments are those of `start_landing`; files are carried from batch to batch and, with
    `max_age_ms`, closed by timers, which keep small batches coming without records. Null timestamps count as the epoch. The run id is the query's id. Ledger,
    commits and names are as there, but an `open` row has only what its batch brought. A run that was
    drained is over; another one needs a new checkpoint. A `RunReport` of the query's `name` keeps its figures.
    """
    if options.distribution != "keyed":
        raise ValueError("open files are carried only with distribution='keyed'")
    if options.max_age_ms is not None and trigger and "availableNow" in trigger:
        raise ValueError("a query with timers does not end by itself: give max_age_ms or availableNow")
    store, root = open_store(checkpoint)
    if _exists(store, f"{root}/metadata") and _drained(path, query_id(checkpoint)):
        raise ValueError("this run was drained: use a new checkpoint")
    spark = records.sparkSession
    rows = landing._rows_to_land(records, config, options)
    rejected = F.col("reject.error_class").isNotNull()
    rows = rows.select(
        # Rejects only pass through; each of their keys is a call of the state operator.
        F.when(rejected, -1 - F.col("spread") % REJECT_KEYS).otherwise(F.col("shard")).cast("bigint").alias("shard"),
        F.coalesce("stream_id", F.lit("")).alias("stream_id"),
        F.coalesce("t", F.lit(0)).alias("t"),
        # In a stream this is the time of the batch, which a repetition has again.
        F.unix_micros(F.current_timestamp()).alias("now"),
        "topic", "partition", "offset", "payload",
        F.when(rejected, F.to_json("reject", _TIMES)).alias("reject"),
    )
    ledger = rows.groupBy("shard", "stream_id").transformWithStateInPandas(
        OpenFiles(path, options), _FLAT, "Append", "None" if options.max_age_ms is None else "ProcessingTime"
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = query_id(checkpoint)
        # One pass: reading the batch twice would land it twice. What follows reads files, in the
        # caller's session: that of the batch plans without adaptive execution, as its state needs.
        writer = _unpacked(batch).write.mode("overwrite").partitionBy("kind")
        writer.parquet(f"{path}/ledger/{batch_folder(run_id, batch_id)}")
        record_commits(spark, path, run_id, batch_id)

    writer = observed(ledger).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        writer = writer.queryName(name)
    with _state_store(spark):
        return writer.trigger(**(trigger or {"processingTime": "15 seconds"})).foreachBatch(run).start()


def _drained(path: str, run_id: str) -> bool:
    """Whether any drain of the run is in the ledger; its batches have negative numbers."""
    store, root = open_store(path)
    return _exists(store, f"{root}/drained/{run_id}")


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
    return reader.option("flattenCollectionTypes", "false").load().drop("partition_id")


def open_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The open files of a stopped query: key, cursor, frames and offsets, from its last checkpoint."""
    with _state_store(spark):
        found = _state(spark, checkpoint, "cursor").select("key.*", "value.*").where("open")
        for name in ("frames", "held"):
            part = _state(spark, checkpoint, name).select("key.*", F.col("list_value").alias(name))
            found = found.join(part, ["shard", "stream_id"], "left")
    return found


def drain_open_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    last_batch: int,
    options: LandingOptions = LandingOptions(),
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
) -> None:
    """After a stopped query: seals every open file and commits a last time.

    Reads the state store as a table, so executors finish the files. Drained twice, a run has the
    files of the first time.
    """
    run_id, named_us = query_id(checkpoint), clock()
    if _drained(path, run_id):
        return

    def seal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        objects = _Objects(path, run_id, options)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                at = Cursor(True, r["filled"], r["created"], r["files"])
                content = b"".join(f["frame"] for f in r["frames"] or [])
                ranges = [tuple(h.values()) for h in r["held"] or []]
                rows.append(objects.seal(
                    r["shard"], r["stream_id"], at, r["records"], r["lines"], r["size"], content, ranges,
                    "final", named_us, named_us,
                ))
            if rows:
                yield pa.RecordBatch.from_pylist([{k: r.get(k) for k in _FIELDS} for r in rows], like)

    like = to_arrow_schema(spark.createDataFrame([], _FLAT).schema)
    drained = _drain_id(last_batch)
    sealed = _unpacked(open_files(spark, checkpoint).mapInArrow(seal, _FLAT))
    sealed.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/ledger/{batch_folder(run_id, drained)}")
    record_commits(spark, path, run_id, drained)
    store, root = open_store(path)
    store.create_dir(f"{root}/drained", recursive=True)
    with store.open_output_stream(f"{root}/drained/{run_id}", compression=None) as out:
        out.write(str(drained).encode())
