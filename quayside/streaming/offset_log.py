"""Offset bookkeeping of a run as a log: a step writes what it changed, and levels merge what steps wrote.

An entry holds the ranges that were released and the watermarks that were set or moved in the
steps `at` to `at + FAN ** level - 1`; a step's own entry has level 0. When FAN entries that
follow each other are whole, the next step merges them into one of the level above, as a job of the
cluster. The state after any step is read from at most FAN - 1 entries of each level, so what a step
reads follows the ranges that are still tracked, and what it writes the partitions it touched.

Entries are made of finished steps and never change. The watermarks of an entry are written after its
ranges; their mark of completion is the entry's. A repeated step writes its entry again.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.offsets import PARTITION, committable, merge_ranges, outstanding
from quayside.sinks.objects import open_store

FAN = 8
RANGES = "topic STRING, partition INT, start BIGINT, `end` BIGINT"
MARKS = "topic STRING, partition INT, previous BIGINT, watermark BIGINT"

Entry = tuple[int, int]


def _folder(kind: str, run_id: str, entry: Entry) -> str:
    return f"offset_log/{kind}/run_id={run_id}/level={entry[0]}/at={entry[1]}"


def _exists(path: str, name: str) -> bool:
    store, root = open_store(path)
    return store.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound


def _whole(path: str, run_id: str, entry: Entry) -> bool:
    return _exists(path, f"{_folder('marks', run_id, entry)}/_SUCCESS")


def cover(steps: int) -> list[Entry]:
    """The fewest entries that hold the steps before `steps`, in order."""
    level = 0
    while FAN ** (level + 1) <= steps:
        level += 1
    found, start = [], 0
    for at_level in range(level, -1, -1):
        while start + FAN**at_level <= steps:
            found.append((at_level, start))
            start += FAN**at_level
    return found


def _held(path: str, run_id: str, entry: Entry) -> list[Entry]:
    """The entry, or those below it where it is not written; a step without records may have none."""
    level, at = entry
    if _whole(path, run_id, entry):
        return [entry]
    if level == 0:
        return []
    below = [(level - 1, at + i * FAN ** (level - 1)) for i in range(FAN)]
    return [e for part in below for e in _held(path, run_id, part)]


def _read(spark: SparkSession, path: str, kind: str, run_id: str, entries: list[Entry], schema: str) -> DataFrame:
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{_folder(kind, run_id, e)}" for e in entries))


def _write(rows: DataFrame, path: str, kind: str, run_id: str, entry: Entry) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{_folder(kind, run_id, entry)}")


def _joined(
    spark: SparkSession, path: str, run_id: str, entries: list[Entry], of: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tracked ranges and watermarks of some entries together, of all partitions or those in `of`."""
    ranges = _read(spark, path, "ranges", run_id, entries, RANGES)
    marks = _read(spark, path, "marks", run_id, entries, MARKS)
    if of is not None:
        ranges, marks = (df.join(F.broadcast(of), list(PARTITION), "left_semi") for df in (ranges, marks))
    marks = marks.groupBy(*PARTITION).agg(F.min("previous").alias("previous"), F.max("watermark").alias("watermark"))
    # What is committed goes before the rest is merged.
    return merge_ranges(outstanding(ranges, marks.drop("previous"))), marks


def _fold(spark: SparkSession, path: str, run_id: str, steps: int) -> None:
    """Writes the merged entries that are due before step number `steps`."""
    level = 1
    while (size := FAN**level) <= steps:
        entry = (level, steps // size * size - size)
        if not _whole(path, run_id, entry):
            ranges, marks = _joined(spark, path, run_id, _held(path, run_id, entry))
            _write(ranges, path, "ranges", run_id, entry)
            _write(marks, path, "marks", run_id, entry)
        level += 1


def offsets_after(
    spark: SparkSession, path: str, run_id: str, step: int, of: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The bookkeeping after a step: uploaded ranges still tracked, and watermarks.

    The ranges are merged and at or above their partition's watermark. `of` are the partitions that
    are asked for; None asks for all. Before the first step both are empty.
    """
    if step < _trimmed(path, run_id):
        raise ValueError(f"the log of run {run_id} was trimmed after step {step}")
    entries = [e for part in cover(step + 1) for e in _held(path, run_id, part)]
    ranges, marks = _joined(spark, path, run_id, entries, of)
    return ranges, marks.drop("previous")


def append_offsets(
    spark: SparkSession, path: str, run_id: str, step: int, released: DataFrame, consumed: DataFrame
) -> None:
    """Accounts for a step: `released` and `consumed` are ranges of its partitions, overlaps allowed.

    Steps are numbered upwards from 0, with gaps or without, and a step begins when those before
    it are whole. A partition's watermark starts at its first consumed offset and moves to the
    first offset that was not released. Rows are written for the partitions that the step
    touched alone; released ranges must be of consumed partitions.
    """
    _fold(spark, path, run_id, step)
    entry = (0, step)
    _write(merge_ranges(released.select(*PARTITION, "start", "end")), path, "ranges", run_id, entry)
    fresh = _read(spark, path, "ranges", run_id, [entry], RANGES)

    first = consumed.groupBy(*PARTITION).agg(F.min("start").alias("first"))
    held, known = offsets_after(spark, path, run_id, step - 1, first)
    marks = first.join(known, list(PARTITION), "left").select(
        *PARTITION, F.coalesce("watermark", "first").alias("watermark"), F.col("watermark").isNull().alias("new")
    )
    moved = committable(merge_ranges(fresh.unionByName(held)), marks.drop("new"))
    after = F.coalesce("commit_offset", "watermark")
    changed = marks.join(moved.drop("watermark"), list(PARTITION), "left").where(F.col("new") | (after > F.col("watermark")))
    rows = changed.select(*PARTITION, F.col("watermark").alias("previous"), after.alias("watermark"))
    _write(rows, path, "marks", run_id, entry)


def moves(spark: SparkSession, path: str) -> DataFrame:
    """Watermarks that the steps of all runs set or moved: `run_id, at` and the columns of MARKS."""
    rows = (
        spark.read.schema(f"{MARKS}, run_id STRING, level INT, at BIGINT")
        .option("basePath", f"{path}/offset_log/marks")
        .parquet(f"{path}/offset_log/marks")
    )
    return rows.where("level = 0").drop("level")


def _trimmed(path: str, run_id: str) -> int:
    """The first step whose state can be read."""
    store, root = open_store(path)
    name = f"{root}/offset_log/trimmed/{run_id}"
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return -1
    with store.open_input_stream(name, compression=None) as source:
        return int(source.read())


def trim_log(path: str, run_id: str, step: int) -> int:
    """Removes ranges that no state after `step` or later is read from; the number of entries removed.

    Watermarks stay: they are the record of commits. Earlier states cannot be read from then on.
    """
    store, root = open_store(path)
    step = max(step, _trimmed(path, run_id))
    kept = {e for part in cover(step + 1) for e in _held(path, run_id, part)}
    store.create_dir(f"{root}/offset_log/trimmed", recursive=True)
    with store.open_output_stream(f"{root}/offset_log/trimmed/{run_id}", compression=None) as out:
        out.write(str(step).encode())
    removed = 0
    base = f"{root}/offset_log/ranges/run_id={run_id}"
    for level in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        for folder in store.get_file_info(fs.FileSelector(level.path)):
            entry = (int(level.base_name.split("=")[1]), int(folder.base_name.split("=")[1]))
            if entry not in kept and entry[1] + FAN ** entry[0] - 1 <= step and _whole(path, run_id, entry):
                store.delete_dir(folder.path)
                removed += 1
    return removed
