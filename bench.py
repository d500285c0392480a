"""Times the headline queries and the landing throughput; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the input and the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from quayside.operators.topics import topic_config
from quayside.plans.queries import QUERIES
from quayside.session import build_session, work_dir
from quayside.sinks.landing import LandingOptions, land, manifest
from quayside.sources.synthetic import BENCH_GROUPS, synthesize_records

HEADLINE = [
    "envelope_lines",
    "document_envelopes",
    "stream_totals",
    "stream_partitions",
    "window_stats",
    "size_seal",
    "age_seal",
    "document_seal",
    "order_seal",
    "file_offsets",
    "committable",
    "lineitem_ranges",
    "lineitem_gaps",
    "landed_manifest",
    "landed_roundtrip",
    "landed_source",
]
MIB = 1024 * 1024
TOPIC_BYTES = 24 * MIB


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def landing(spark, cpus: int) -> dict:
    """Throughput of landing records from a few bytes to 30 MB, in both distributions."""
    stage = work_dir(spark, "bench")
    config = topic_config(spark, BENCH_GROUPS)
    staged = synthesize_records(spark, TOPIC_BYTES)
    # Stored plainly, so that reading costs what the values weigh.
    staged.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(stage)
    records = spark.read.parquet(stage)
    count, size = records.agg(F.count("*"), F.sum(F.octet_length("value"))).first()
    out = {"input_mb": round(size / MIB, 1), "records": count}
    for distribution in ("source", "keyed"):
        best = None
        for _ in range(2):
            path = work_dir(spark, "bench")
            # One instance, so that the files are those of the whole streams.
            options = LandingOptions(distribution=distribution, shards=1, segment_offsets=None)
            seconds = timed(lambda: land(records, config, path, options))
            if best is None or seconds < best[0]:
                best = (seconds, path)
        seconds, path = best
        files, raw, packed = manifest(spark, path).agg(
            F.count("object_key"), F.sum("raw_size_b"), F.sum("compressed_size_b")
        ).first()
        out[distribution] = {
            "sec": seconds,
            "mb_per_s": round(size / MIB / seconds, 1),
            "mb_per_s_per_core": round(size / MIB / seconds / cpus, 1),
            "records_per_s": round(count / seconds),
            "files": files,
            "raw_bytes": raw,
            "compressed_bytes": packed,
        }
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * cpus),
            "spark.driver.memory": "12g",
            # Records of 30 MB are more than half of a default region.
            "spark.driver.extraJavaOptions": "-XX:G1HeapRegionSize=32m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the Python workers and compile the common plans before timing.
    noop(QUERIES["landed_source"](spark, sf_dir))
    times = {name: timed(lambda: noop(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "landing": landing(spark, cpus),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
