"""Reading records: Kafka in batch or streaming form, or files of the same columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schema import RECORD


def subscription(config: DataFrame) -> str:
    """The topics of a configuration in the form the Kafka source takes."""
    return ",".join(sorted(r.topic for r in config.select("topic").distinct().collect()))


def _kafka_options(config: DataFrame, options: Mapping[str, str]) -> dict[str, str]:
    # Offsets that are gone are an error; to skip them and vanished topics, `options` must say so.
    return {
        "subscribe": subscription(config),
        "includeHeaders": "true",
        "failOnDataLoss": "true",
        **options,
    }


def _records(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD.fields])


def read_record_stream(
    spark: SparkSession, config: DataFrame, options: Mapping[str, str], starting: str = "latest"
) -> DataFrame:
    """Records of all configured topics as a stream. `starting` counts without a checkpoint."""
    reader = spark.readStream.format("kafka").options(**_kafka_options(config, options))
    return _records(reader.option("startingOffsets", starting).load())


def read_record_batch(
    spark: SparkSession,
    config: DataFrame,
    options: Mapping[str, str],
    start: str = "earliest",
    end: str = "latest",
) -> DataFrame:
    """All retained records of the configured topics, or those between two offset maps."""
    reader = spark.read.format("kafka").options(**_kafka_options(config, options))
    return _records(reader.option("startingOffsets", start).option("endingOffsets", end).load())


def read_record_files(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Records kept in files."""
    return _records(spark.read.format(format).schema(RECORD).load(path))


def read_record_file_stream(
    spark: SparkSession, path: str, format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Records from files as they appear in a folder."""
    reader = spark.readStream.format(format).schema(RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _records(reader.load(path))
