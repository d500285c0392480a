"""Topic configuration: which decoder and router each topic uses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.decode import DECODERS
from quayside.functions.routing import ROUTERS
from quayside.schema import TOPIC_CONFIG

# A configuration is written by hand; one beyond this size is joined without a broadcast.
BROADCAST_TOPICS = 100_000


def topic_config(
    spark: SparkSession,
    groups: Iterable[tuple[str, str, Iterable[str]]],
    segment_offsets: Mapping[str, int] | None = None,
) -> DataFrame:
    """`(decoder, router, topics)` groups as one row per topic; the last group wins.

    `segment_offsets` sets the length of lanes (see `seal.lane`) for single topics, such as
    those with very large records.
    """
    segments = segment_offsets or {}
    by_topic = {}
    for decoder, router, topics in groups:
        if decoder not in DECODERS:
            raise ValueError(f"unknown decoder '{decoder}'")
        if router not in ROUTERS:
            raise ValueError(f"unknown router '{router}'")
        for topic in topics:
            by_topic[topic] = (topic, decoder, router, segments.get(topic))
    config = spark.createDataFrame(list(by_topic.values()), TOPIC_CONFIG)
    return F.broadcast(config) if len(by_topic) <= BROADCAST_TOPICS else config


def suggest_segments(manifest: DataFrame, lane_bytes: int) -> DataFrame:
    """Lane lengths by topic that keep about `lane_bytes` per partition, from past files.

    `topic, segment_offsets`, to be reviewed and passed to `topic_config`. The bytes of a
    file are shared out by the offsets it holds.
    """
    held = manifest.where(F.col("line_count") > 0).select(
        (F.col("raw_size_b") / F.col("record_count")).alias("record_bytes"),
        F.explode("offsets").alias("r"),
    )
    count = F.col("r.end") - F.col("r.start") + 1
    average = F.sum(F.col("record_bytes") * count) / F.sum(count)
    return held.groupBy(F.col("r.topic").alias("topic")).agg(
        F.greatest(F.lit(1), F.floor(F.lit(lane_bytes) / average)).alias("segment_offsets")
    )


def assign_config(records: DataFrame, config: DataFrame) -> DataFrame:
    """Adds the configuration columns; all are NULL for a topic without configuration."""
    return records.join(config, "topic", "left")


def unconfigured(records: DataFrame, config: DataFrame) -> DataFrame:
    """Records of topics without configuration."""
    return records.join(config, "topic", "left_anti")
