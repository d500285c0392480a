"""Row shapes shared by every part of the package."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

# Same columns as Spark's Kafka source with includeHeaders=true, less the unused ones.
RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)

TOPIC_CONFIG = "topic STRING, decoder STRING, router STRING, segment_offsets BIGINT"

OFFSET_RANGES = "ARRAY<STRUCT<topic: STRING, partition: INT, start: BIGINT, end: BIGINT>>"

# Total arrival order of records that carry no arrival_seq of their own.
ARRIVAL_ORDER = ("timestamp", "topic", "partition", "offset")
