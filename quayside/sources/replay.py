"""The event table replayed as framed records of several topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.topics import topic_config

GROUPS = [
    ("schema", "topic_version", ["topic-click", "topic-view", "topic-signup", "topic-purchase"]),
    ("string", "dlq", ["dlq"]),
]

OFFSET_BLOCK = 1 << 16


def replay_config(
    spark: SparkSession,
    without: tuple[str, ...] = (),
    segments: Mapping[str, int] | None = None,
) -> DataFrame:
    groups = [(d, r, [t for t in topics if t not in without]) for d, r, topics in GROUPS]
    return topic_config(spark, groups, segments)


def number_offsets(df: DataFrame, sequence: str, block: int = OFFSET_BLOCK) -> DataFrame:
    """Dense offsets per topic partition in order of an integer column.

    Rows are numbered within blocks of the sequence and blocks start where the ones before
    end, so a partition of any size is spread over many tasks.
    """
    keys = ["topic", "partition"]
    blocked = df.withColumn("block", F.floor(F.col(sequence) / block))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        blocked.groupBy(*keys, "block")
        .count()
        .withColumn("base", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    within = Window.partitionBy(*keys, "block").orderBy(sequence)
    return (
        blocked.withColumn("n", F.row_number().over(within))
        .join(bases, [*keys, "block"])
        .withColumn("offset", F.col("base") + F.col("n") - 1)
        .drop("block", "base", "n")
    )


def _header(key: str, value, present) -> F.Column:
    return F.when(
        present, F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))
    )


def replay_events(spark: SparkSession, sf_dir: str, offsets: bool = False) -> DataFrame:
    """RECORD rows (and `arrival_seq`) from `events`; with dense offsets only on request."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    seq, props = F.col("event_id"), F.col("props").cast("binary")
    dlq = F.col("event_type") == "error"
    frame = F.lit(b"\x00" * 5)
    value = (
        F.when(seq % 97 == 0, F.lit(None).cast("binary"))
        .when(~dlq & (seq % 101 == 0), props)
        .when(seq % 89 == 0, F.when(dlq, F.lit(b"")).otherwise(frame))
        .when(dlq, props)
        .otherwise(F.concat(frame, props))
    )
    name = F.when(seq % 59 == 0, "").otherwise(F.col("event_type"))
    version = F.concat(F.lit("1."), F.col("user_id") % 3, F.lit(".0"))
    code = F.when(F.col("value") < 20, "400").otherwise("500")
    headers = F.array_compact(
        F.array(
            _header("schema_name", name, seq % 53 != 0),
            _header("schema_version", version, seq % 47 != 0),
            _header("status_code", code, dlq & (seq % 43 != 0)),
            _header("note", F.lit('has"quote'), seq % 61 == 0),
        )
    )
    records = e.select(
        F.when(dlq, "dlq").otherwise(F.concat(F.lit("topic-"), "event_type")).alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        seq.alias("arrival_seq"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        value.alias("value"),
        headers.alias("headers"),
    )
    return number_offsets(records, "arrival_seq") if offsets else records
