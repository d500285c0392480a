"""Reading landed files back as lines."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.landing import manifest
from quayside.sinks.objects import open_store

CHUNK = 4 * 1024 * 1024
TASK_BYTES = 512 * 1024 * 1024


def _lines(source) -> Iterator[pa.Array]:
    """The lines of a zstd JSON lines file, without newlines, a chunk at a time."""
    held = b""
    reader = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
    while chunk := reader.read(CHUNK):
        end = chunk.rfind(b"\n") + 1
        if not end:
            held += chunk
            continue
        text, held = held + chunk[:end], chunk[end:]
        breaks = np.flatnonzero(np.frombuffer(text, "u1") == 10)
        bounds = np.concatenate([[0], breaks - np.arange(len(breaks))]).astype("i4")
        data = text.replace(b"\n", b"")
        yield pa.Array.from_buffers(pa.binary(), len(breaks), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    if held:
        yield pa.array([held])


def read_landed(
    spark: SparkSession, path: str, files: DataFrame | None = None, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Lines of the landed files: `stream_id, object_key, line`.

    `files` selects manifest rows, such as `landed_files` finds by day, stream or offsets; all
    uploaded ones by default. Only their objects are opened.
    """
    files = manifest(spark, path) if files is None else files
    files = files.where("status = 'uploaded'")
    raw = files.agg(F.sum("raw_size_b")).first()[0] or 0
    # Explicit, because manifest rows are too small for their size to say how to split them.
    tasks = max(spark.sparkContext.defaultParallelism, ceil(raw / task_bytes))

    def read(batches):
        store, root = open_store(path)
        for batch in batches:
            for stream, key in zip(*(batch.column(c).to_pylist() for c in ("stream_id", "object_key"))):
                with store.open_input_stream(f"{root}/objects/{key}", compression=None) as source:
                    for lines in _lines(source):
                        n = len(lines)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([stream] * n), pa.array([key] * n), lines],
                            names=["stream_id", "object_key", "line"],
                        )

    located = files.select("stream_id", "object_key").repartition(tasks, "object_key")
    return located.mapInArrow(read, "stream_id STRING, object_key STRING, line BINARY")
