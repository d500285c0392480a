"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import work_dir

#: Rows of documents that are worked on at a time inside a task.
SLICE_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Writes `df` below the shared folder and reads it back.

    Cuts the lineage: what follows survives lost executors without repeating what came before,
    and sees the same rows each time it is read.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task holds does not depend on a session setting."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    # The worker is used again by other tasks; what it held for this one goes back to the system.
    pa.default_memory_pool().release_unused()


def numbers(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `length` word hashes, with their bits mixed."""
    if len(values) < length or length == 0:
        return np.empty(0, np.uint64)
    out = np.zeros(len(values) - length + 1, np.uint64)
    for i in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + values[i : i + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def groups_of(count: int, per_group: int) -> int:
    return max(1, math.ceil(count / per_group))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node that each node of `edges` (u, v) can reach, as (node, label).

    Labels spread to the neighbours and then jump to the label of their label, so that long
    chains take few rounds. Each round is written out: it starts from stable rows, and no plan
    grows with the number of rounds. Nodes without an edge are not in the result.
    """
    both = stage(
        edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "edges",
    )
    near = both.groupBy("u").agg(F.min("v").alias("least"))
    labels = stage(near.select(F.col("u").alias("node"), F.least("u", "least").alias("label")), "labels")
    for _ in range(max_rounds):
        heard = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        spread = labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stage(
            spread.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label")),
            "labels",
        )
        labels = after.select("node", "label")
        if after.filter("old <> label").isEmpty():
            return labels
    raise RuntimeError(f"the components are not settled after {max_rounds} rounds")
