"""Per-stream totals and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.metrics import MIB, rate
from quayside.schema import ARRIVAL_ORDER


def arrival(df: DataFrame) -> Column:
    """What orders records by arrival: `arrival_seq` if they carry one."""
    if "arrival_seq" in df.columns:
        return F.col("arrival_seq")
    return F.struct(*ARRIVAL_ORDER)


def stream_totals(routed: DataFrame) -> DataFrame:
    """Records (skipped ones too), written lines, written bytes and first arrival per stream."""
    return routed.groupBy("stream_id").agg(
        F.count("*").alias("record_count"),
        F.count_if(F.col("line_bytes") > 0).alias("line_count"),
        F.sum("line_bytes").alias("raw_size_b"),
        F.min("timestamp").alias("first_arrival"),
    )


def stream_catalog(routed: DataFrame) -> DataFrame:
    """Every stream with the decoders and routers that feed it."""
    return routed.select("stream_id", "decoder", "router").distinct()


def stream_partitions(routed: DataFrame) -> DataFrame:
    """Which topic partitions feed which stream."""
    return routed.groupBy("stream_id", "topic", "partition").agg(
        F.count("*").alias("record_count"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )


def initial_watermarks(records: DataFrame) -> DataFrame:
    """First offset consumed per topic partition, by arrival."""
    return records.groupBy("topic", "partition").agg(
        F.min_by("offset", arrival(records)).alias("watermark")
    )


def _counters() -> list[Column]:
    # A size or dormant seal counts as sealed; the final one at shutdown does not.
    sealed = F.col("seal_reason").isin("size", "dormant")
    return [
        F.coalesce(F.sum("line_count"), F.lit(0)).alias("record_count"),
        F.floor(F.coalesce(F.sum("raw_size_b"), F.lit(0)) / MIB).alias("mb_consumed"),
        F.count_if(sealed).alias("files_sealed"),
        F.count_if(F.col("status") == "uploaded").alias("successful_uploads"),
        F.count_if(F.col("status") == "failed").alias("failed_uploads"),
        F.count_if(F.col("seal_reason") == "dormant").alias("dormant_files"),
    ]


def _with_rates(report: DataFrame, seconds: Column) -> DataFrame:
    rated = {
        "record_count": "record_per_sec",
        "mb_consumed": "mb_per_sec",
        "files_sealed": "files_sealed_per_sec",
        "successful_uploads": "successful_uploads_per_sec",
        "failed_uploads": "failed_uploads_per_sec",
    }
    return report.withColumns({name: rate(F.col(count), seconds) for count, name in rated.items()})


def run_stats(files: DataFrame, started: Column, now: Column) -> DataFrame:
    """Totals of a run and their rates, from its file rows."""
    seconds = (F.unix_micros(now) - F.unix_micros(started)) / 1_000_000
    return _with_rates(files.agg(*_counters()), seconds)


def window_stats(records: DataFrame, every: str, seconds: float) -> DataFrame:
    """Written lines and MiB per reporting window of length `every` (`seconds` long)."""
    report = (
        records.groupBy(F.window("timestamp", every).alias("w"))
        .agg(
            F.count_if(F.col("line_bytes") > 0).alias("record_count"),
            F.floor(F.sum("line_bytes") / MIB).alias("mb_consumed"),
        )
        .select(F.col("w.start").alias("window_start"), "record_count", "mb_consumed")
    )
    return report.withColumns(
        {
            "record_per_sec": rate(F.col("record_count"), F.lit(seconds)),
            "mb_per_sec": rate(F.col("mb_consumed"), F.lit(seconds)),
        }
    )


def window_file_stats(files: DataFrame, every: str, seconds: float) -> DataFrame:
    """Run counters per reporting window, by the time a file was sealed."""
    report = (
        files.groupBy(F.window(F.timestamp_micros("sealed_us"), every).alias("w"))
        .agg(*_counters())
        .select(F.col("w.start").alias("window_start"), "*")
        .drop("w")
    )
    return _with_rates(report, F.lit(seconds))
