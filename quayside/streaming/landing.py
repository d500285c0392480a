"""Continuous landing with Structured Streaming.

Every micro-batch is landed by `foreachBatch` and then accounted for. The query's
checkpoint decides what is read again after a failure; everything a batch writes is keyed
by the query's id and its own and repeats identically, so readers of the ledger see each
record once. A new checkpoint is a new run, which leaves those before it as they are.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.offsets import PARTITION, offset_ranges
from quayside.schema import RECORD
from quayside.sinks.landing import LandingOptions, batch_folder, land, manifest, quarantined
from quayside.sinks.objects import open_store
from quayside.streaming.offset_log import append_offsets, moves


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def query_id(checkpoint: str) -> str:
    """The id that a streaming query keeps as long as its checkpoint: the run id of its landing."""
    store, root = open_store(checkpoint)
    with store.open_input_stream(f"{root}/metadata", compression=None) as source:
        return json.loads(source.read())["id"]


def _intent_name(root: str, run_id: str, batch_id: int) -> str:
    return f"{root}/batches/{batch_folder(run_id, batch_id)}.json"


def _intent(path: str, run_id: str, batch_id: int, now: Callable[[], int]) -> int:
    """The seal time of a batch, fixed before its first file and kept for repetitions."""
    store, root = open_store(path)
    name = _intent_name(root, run_id, batch_id)
    if _exists(store, name):
        with store.open_input_stream(name, compression=None) as source:
            return json.loads(source.read())["sealed_us"]
    sealed_us = now()
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        out.write(json.dumps({"batch_id": batch_id, "sealed_us": sealed_us}).encode())
    return sealed_us


def _drain_id(batch_id: int) -> int:
    """Ledger id of the drain after a batch; negative, so no micro-batch has it."""
    return -batch_id - 1


def _opened(spark: SparkSession, path: str, run_id: str, batch_id: int) -> DataFrame | None:
    """Files the batch before left open, unless they were drained."""
    store, root = open_store(path)
    if not _exists(store, _intent_name(root, run_id, batch_id - 1)):
        return None
    if _exists(store, _intent_name(root, run_id, _drain_id(batch_id - 1))):
        return None
    return manifest(spark, path, batch_id - 1, run_id).where("status = 'open'")


def _step(batch_id: int) -> int:
    """Place of a batch in the run's log of offsets; the drain after a batch follows it."""
    return 2 * batch_id if batch_id >= 0 else -2 * batch_id - 1


def record_commits(spark: SparkSession, path: str, run_id: str, batch_id: int) -> None:
    """Advances the commit bookkeeping by one batch, from its ledger and quarantine."""
    files = manifest(spark, path, batch_id, run_id)
    landed = files.select("status", F.explode("offsets").alias("r")).select(
        "status", "r.topic", "r.partition", "r.start", "r.end"
    )
    rejected = offset_ranges(quarantined(spark, path, batch_id, run_id))
    released = landed.where("status <> 'open'").drop("status").unionByName(rejected)
    consumed = landed.drop("status").unionByName(rejected)
    append_offsets(spark, path, run_id, _step(batch_id), released, consumed)


def commit_log(spark: SparkSession, path: str) -> DataFrame:
    """Commits of all batches: `run_id, batch_id, topic, partition, watermark, commit_offset`."""
    batch = F.when(F.col("at") % 2 == 0, F.col("at") / 2).otherwise(-(F.col("at") + 1) / 2)
    return moves(spark, path).where(F.col("watermark") > F.col("previous")).select(
        "run_id",
        batch.cast("bigint").alias("batch_id"),
        *PARTITION,
        F.col("previous").alias("watermark"),
        F.col("watermark").alias("commit_offset"),
    )


def land_batch(
    config: DataFrame,
    path: str,
    run_id: str,
    options: LandingOptions = LandingOptions(),
    carry: bool = False,
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` function.

    Without `carry` each batch seals all its files: the trigger interval is the age limit.
    With it, files below their size and age stay open and grow over many batches; their age
    counts from the batch in which their first record arrived, whatever its timestamp. The
    batches of one `run_id` are numbered once; another job needs another.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sealed_us = _intent(path, run_id, batch_id, clock)
        opened = _opened(spark, path, run_id, batch_id) if carry else None
        land(
            batch, config, path, options, batch_id, sealed_us,
            finalize=not carry,
            now_us=sealed_us if options.max_age_ms is not None else None,
            opened=opened,
            run_id=run_id,
            arrived_us=sealed_us if carry and options.max_age_ms is not None else None,
        )
        record_commits(spark, path, run_id, batch_id)
        # Nothing reads the open files of two batches ago any more, not even a repetition.
        store, root = open_store(path)
        stale = f"{root}/open/{batch_folder(run_id, batch_id - 2)}"
        if _exists(store, stale):
            store.delete_dir(stale)

    return run


def start_landing(
    records: DataFrame,
    config: DataFrame,
    path: str,
    checkpoint: str,
    options: LandingOptions = LandingOptions(),
    trigger: dict | None = None,
    carry: bool = False,
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
) -> StreamingQuery:
    """Lands a stream of records until stopped. `trigger` is that of `DataStreamWriter`.

    The run id is the query's id, which lives in the checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        land_batch(config, path, query_id(checkpoint), options, carry, clock)(batch, batch_id)

    writer = records.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "15 seconds"}))
    return writer.foreachBatch(run).start()


def drain(
    spark: SparkSession,
    config: DataFrame,
    path: str,
    run_id: str,
    last_batch: int,
    options: LandingOptions = LandingOptions(),
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
) -> None:
    """After a stopped query with `carry`: seals every open file and commits a last time."""
    opened = _opened(spark, path, run_id, last_batch + 1)
    if opened is None:
        return
    batch_id = _drain_id(last_batch)
    # The intent is written last: until then the open files still count as open.
    land(
        spark.createDataFrame([], RECORD), config, path, options, batch_id, clock(), opened=opened, run_id=run_id
    )
    record_commits(spark, path, run_id, batch_id)
    _intent(path, run_id, batch_id, clock)
