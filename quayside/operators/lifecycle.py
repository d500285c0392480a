"""Open files: which are due, and which a partition revoke drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_streams(files: DataFrame) -> DataFrame:
    """Files not sealed yet: at most the last one of each stream."""
    return files.where(F.col("seal_reason") == "open")


def dormant_due(
    opened: DataFrame, now_us: Column, max_age_us: int, capacity: int | None = None
) -> DataFrame:
    """Open files at least `max_age_us` old at `now_us`.

    With `capacity`, the oldest so many: free upload slots bound what one tick seals and
    the rest waits for the next one.
    """
    due = opened.where(F.col("created_us") <= now_us - max_age_us)
    if capacity is None:
        return due
    return due.orderBy("created_us", "shard", "stream_id").limit(max(capacity, 0))


def revoked_streams(open_offsets: DataFrame, revoked: DataFrame) -> DataFrame:
    """`stream_id, dropped` for open streams after a revoke.

    `open_offsets` has a row per stream and topic partition that feeds its open file. A
    stream drops when every one of them is revoked; mixed streams stay.
    """
    marks = revoked.select("topic", "partition").distinct().withColumn("gone", F.lit(True))
    return (
        open_offsets.join(marks, ["topic", "partition"], "left")
        .groupBy("stream_id")
        .agg(F.bool_and(F.coalesce("gone", F.lit(False))).alias("dropped"))
    )


def keep_assigned(tracker: DataFrame, revoked: DataFrame) -> DataFrame:
    """A tracker (watermarks or ranges) without the revoked partitions."""
    return tracker.join(revoked, ["topic", "partition"], "left_anti")
