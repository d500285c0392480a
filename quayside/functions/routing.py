"""Routers: a record -> the id of the logical stream it belongs to."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.headers import header_value

# Delimiter of stream ids, header names and what stands in for missing headers.
DELIMITER = "\x1f"
SCHEMA_NAME_HEADER = "schema_name"
SCHEMA_VERSION_HEADER = "schema_version"
STATUS_CODE_HEADER = "status_code"
UNKNOWN_SCHEMA_NAME = "unknown_schema_name"
UNKNOWN_SCHEMA_VERSION = "unknown_schema_version"
UNKNOWN_STATUS_CODE = "unknown_status_code"


def _schema(headers: Column) -> tuple[Column, Column]:
    name = F.coalesce(header_value(headers, SCHEMA_NAME_HEADER), F.lit(UNKNOWN_SCHEMA_NAME))
    version = F.coalesce(header_value(headers, SCHEMA_VERSION_HEADER), F.lit(UNKNOWN_SCHEMA_VERSION))
    return name, version


def by_schema_version(topic: Column, headers: Column) -> Column:
    """Schema name and version; topics that share a schema share the stream."""
    return F.concat_ws(DELIMITER, *_schema(headers))


def by_dead_letter(topic: Column, headers: Column) -> Column:
    """Topic, schema name, schema version and status code."""
    code = F.coalesce(header_value(headers, STATUS_CODE_HEADER), F.lit(UNKNOWN_STATUS_CODE))
    return F.concat_ws(
        DELIMITER, topic, *_schema(headers), F.concat(F.lit("status_code="), code)
    )


ROUTERS: dict[str, Callable[[Column, Column], Column]] = {
    "topic_version": by_schema_version,
    "dlq": by_dead_letter,
}


def stream_id(
    router: Column,
    topic: Column,
    headers: Column,
    registry: Mapping[str, Callable[[Column, Column], Column]] = ROUTERS,
) -> Column:
    """Stream id by the router named in the row."""
    chosen = F.lit(None).cast("string")
    for name, build in registry.items():
        chosen = F.when(router == name, build(topic, headers)).otherwise(chosen)
    return chosen


def stream_parts(stream: Column) -> Column:
    return F.split(stream, DELIMITER)
