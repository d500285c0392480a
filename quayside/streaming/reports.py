"""Reports of a running stream: a row per micro-batch, from figures that its one pass gathers.

The landing plan counts its ledger rows with `Dataset.observe`; Spark hands the figures to a
listener with the progress of the batch, which keeps them beside the ledger. Records are not read
again. A batch that is repeated replaces its row.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quayside.functions.metrics import MIB, rate
from quayside.sinks.objects import open_store

METRICS = "landed"
_COUNTS = (
    "lines_taken", "bytes_taken", "record_count", "raw_size_b", "files_sealed", "dormant_files",
    "successful_uploads", "failed_attempts", "rejects",
)
_REPORT = f"run_id STRING, batch_id BIGINT, started STRING, seconds DOUBLE, {', '.join(f'{c} BIGINT' for c in _COUNTS)}"


def observed(ledger: DataFrame) -> DataFrame:
    """Ledger rows of `start_open_files`, with their figures observed.

    What was taken counts when it came, what is in a file when the file is finished. A file
    finished by the batch that also brought lines to it holds both older and new ones, so lines
    taken are those of `open` rows and `fresh` ones of finished files.
    """
    done = F.col("status") != "open"
    total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    sealed = F.col("seal_reason").isin("size", "dormant")
    return ledger.observe(
        METRICS,
        F.coalesce(F.sum("fresh_lines"), F.lit(0)).alias("lines_taken"),
        F.coalesce(F.sum("fresh_bytes"), F.lit(0)).alias("bytes_taken"),
        total("line_count", done).alias("record_count"),
        total("raw_size_b", done).alias("raw_size_b"),
        F.count_if(sealed).alias("files_sealed"),
        F.count_if(F.col("seal_reason") == "dormant").alias("dormant_files"),
        F.count_if(F.col("status") == "uploaded").alias("successful_uploads"),
        total("failed_attempts", done).alias("failed_attempts"),
        F.count_if(F.col("kind") == "reject").alias("rejects"),
    )


class RunReport(StreamingQueryListener):
    """Writes the report rows of the landing query that it is made for.

    Add it with `spark.streams.addListener` before the query starts, and name the query so.
    """

    def __init__(self, path: str, name: str):
        self.path, self.name, self._ended = path, name, threading.Event()
        self._id = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = str(event.id)
            self._ended.clear()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = (progress.observedMetrics or {}).get(METRICS)
        if progress.name != self.name or figures is None:
            return
        row = {"run_id": str(progress.id), "batch_id": progress.batchId, "started": progress.timestamp}
        row |= {"seconds": progress.batchDuration / 1000} | {c: figures[c] for c in _COUNTS}
        store, root = open_store(self.path)
        store.create_dir(f"{root}/reports", recursive=True)
        with store.open_output_stream(f"{root}/reports/{row['run_id']}-{row['batch_id']}.json", compression=None) as out:
            out.write(json.dumps(row).encode())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self._id:
            self._ended.set()

    def wait(self, seconds: float = 60) -> bool:
        """Until the last report of the stopped query is written; events come a little later than the batches."""
        return self._ended.wait(seconds)


def run_reports(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch: its figures, MiB in finished files and rates over the batch's duration."""
    store, root = open_store(path)
    store.create_dir(f"{root}/reports", recursive=True)
    rows = spark.read.schema(_REPORT).json(f"{path}/reports")
    seconds = F.greatest("seconds", F.lit(0.001))
    return rows.withColumns(
        {
            "started": F.col("started").cast("timestamp"),
            "mb_consumed": F.floor(F.col("raw_size_b") / MIB),
            "lines_taken_per_sec": rate(F.col("lines_taken"), seconds),
            "record_per_sec": rate(F.col("record_count"), seconds),
            "files_sealed_per_sec": rate(F.col("files_sealed"), seconds),
        }
    )
