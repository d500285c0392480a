"""Record-level steps as DataFrame -> DataFrame: decode, envelope, route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import decode as d
from quayside.functions.envelope import envelope_bytes, envelope_line
from quayside.functions.headers import drop_reason
from quayside.functions.routing import stream_id, stream_parts
from quayside.operators.topics import assign_config


def judge(records: DataFrame) -> DataFrame:
    """Adds `body_bytes` and `outcome` to records that carry a `decoder`.

    Both are small and used more than once, so they stay a projection of their own that is
    compiled together with the scan; what follows need not look at the value again.
    """
    sized = records.withColumn("body_bytes", d.body_size(F.col("value"), F.col("decoder")))
    known = F.when(F.col("decoder").isNull(), "unconfigured").otherwise(d.outcome(F.col("body_bytes")))
    return sized.withColumn("outcome", known)


def decode(records: DataFrame) -> DataFrame:
    """Adds `outcome`, `body_bytes` and `body` to records that carry a `decoder`."""
    decoded = F.col("outcome").isin("ok", "skip_empty")
    return judge(records).withColumn(
        "body", F.when(decoded, d.body(F.col("value"), F.col("decoder")))
    )


def route(records: DataFrame) -> DataFrame:
    """Adds `stream_id` to records that carry a `router`."""
    return records.withColumn(
        "stream_id", stream_id(F.col("router"), F.col("topic"), F.col("headers"))
    )


def split_stream(records: DataFrame) -> DataFrame:
    """Adds `stream_parts`."""
    return records.withColumn("stream_parts", stream_parts(F.col("stream_id")))


def envelope(judged: DataFrame) -> DataFrame:
    """Adds `line` (NULL for skipped records) and `line_bytes` (with the newline).

    A query that needs sizes only builds no lines, and no intermediate row holds a body
    next to its line.
    """
    written = F.col("outcome") == "ok"
    line = envelope_line(d.body(F.col("value"), F.col("decoder")), F.col("headers"))
    size = envelope_bytes(F.col("body_bytes"), F.col("headers"))
    return judged.withColumns(
        {
            "line": F.when(written, line),
            "line_bytes": F.when(written, size).otherwise(F.lit(0).cast("bigint")),
        }
    )


def decode_errors(decoded: DataFrame) -> DataFrame:
    """Undecodable records with the reason as text."""
    message = d.error_message(
        F.col("topic"), F.col("partition"), F.col("offset"), F.col("decoder")
    )
    return decoded.where(F.col("outcome") == "decode_error").withColumn("message", message)


def consumed(decoded: DataFrame) -> DataFrame:
    """Records that enter a stream: written and skipped ones, not undecodable or unconfigured ones."""
    return decoded.where(~F.col("outcome").isin("decode_error", "unconfigured"))


def dropped_headers(records: DataFrame) -> DataFrame:
    """One row per header that the envelope leaves out, with its position and the reason."""
    exploded = records.select("*", F.posexplode("headers").alias("position", "header"))
    return (
        exploded.withColumn("reason", drop_reason(F.col("header")))
        .where(F.col("reason").isNotNull())
        .drop("headers")
    )


def process(records: DataFrame, config: DataFrame) -> DataFrame:
    """Configuration, decode, route and envelope in one projection over the records."""
    return envelope(route(decode(assign_config(records, config))))
