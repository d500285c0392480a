"""Benchmark records in the size profiles of a heterogeneous cluster."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Profile(NamedTuple):
    topic: str
    payload_bytes: int
    schema_name: str
    schema_version: str


# Payload bytes of topics 1-10, 11-20, 21-30, 31-35, 36-40, 41-45 and 46-50.
PROFILE_SIZES = [
    (10, 32_096),
    (10, 100_000),
    (10, 500_000),
    (5, 1_050_000),
    (5, 10_000_000),
    (5, 20_000_000),
    (5, 30_000_000),
]
PARTITIONS = 6
DEAD_LETTER = Profile("dlq", 360, "topic-A", "1")
SMALL = Profile("topic-small", 41, "topic-small", "1")
SMALL_BODY = '{"pier":4,"gate":"east","open":true}'
FRAME = b"\x00" * 5
#: Digests in a payload before they repeat: 32 KiB.
UNIT_DIGESTS = 512


def default_profiles() -> list[Profile]:
    sizes = [size for count, size in PROFILE_SIZES for _ in range(count)]
    return [Profile(f"topic-{i}", s, f"topic-{i}", f"version-{i}") for i, s in enumerate(sizes, 1)]


BENCH_GROUPS = [
    ("schema", "topic_version", [p.topic for p in default_profiles()]),
    ("string", "dlq", [DEAD_LETTER.topic]),
    # Framed on the wire but read as plain: its line keeps the frame bytes.
    ("string", "topic_version", [SMALL.topic]),
]


def _filler(room: F.Column) -> F.Column:
    """`room` characters of hex digests of the record's address, repeated after UNIT_DIGESTS of them."""
    digests = F.greatest(F.least(F.ceil(room / 64), F.lit(UNIT_DIGESTS)), F.lit(1)).cast("int")
    digest = lambda i: F.sha2(F.concat_ws("/", "topic", F.col("n"), i), 256)
    unit = F.array_join(F.transform(F.sequence(F.lit(1), digests), digest), "")
    times = F.ceil(room / (digests * 64)).cast("int")
    return F.substr(F.repeat(unit, times), F.lit(1), room.cast("int"))


def _bodies() -> F.Column:
    """The value of record `n` of its profile, `payload_bytes` long."""
    dead = F.col("topic") == DEAD_LETTER.topic
    frame = F.when(dead, F.lit(b"")).otherwise(F.lit(FRAME))
    lead = F.when(dead, F.format_string('{"unread":%d,"load":"', "n")).otherwise(F.format_string('{"cargo":%d,"load":"', "n"))
    room = F.greatest(F.col("payload_bytes") - F.octet_length(frame) - F.octet_length(lead) - 2, F.lit(0))
    body = F.concat(lead, _filler(room), F.lit('"}')).cast("binary")
    return F.when(F.col("topic") == SMALL.topic, F.lit(FRAME + SMALL_BODY.encode())).otherwise(F.concat(frame, body))


def synthesize_records(
    spark: SparkSession, target_bytes: int, profiles: Sequence[Profile] | None = None
) -> DataFrame:
    """About `target_bytes` of records per topic, and the one record of the small topic."""
    if profiles is None:
        profiles = [*default_profiles(), DEAD_LETTER, SMALL]
    rows = [
        (*p, 1 if p.topic == SMALL.topic else max(1, -(-target_bytes // p.payload_bytes)))
        for p in profiles
    ]
    table = spark.createDataFrame(
        rows, "topic STRING, payload_bytes BIGINT, schema_name STRING, schema_version STRING, records BIGINT"
    )
    numbered = table.select("*", F.explode(F.sequence(F.lit(0), F.col("records") - 1)).alias("n"))
    header = lambda key: F.struct(
        F.lit(key).alias("key"), F.col(key).cast("binary").alias("value")
    )
    # Spread before the payloads exist: only small rows are shuffled.
    return numbered.repartition("topic", "n").select(
        "topic",
        (F.col("n") % PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("n") / PARTITIONS).alias("offset"),
        F.timestamp_micros(F.lit(1_735_689_600_000_000) + F.col("n") * 1000).alias("timestamp"),
        _bodies().alias("value"),
        F.array(header("schema_name"), header("schema_version")).alias("headers"),
    )
