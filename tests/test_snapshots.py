"""Snapshots of the ledger and the files that a reader opens."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from quayside.session import work_dir
from quayside.sinks.landing import LandingOptions, land, manifest
from quayside.sinks.snapshots import BOUNDS, landed_files, write_snapshot
from quayside.sources.landed import read_landed
from quayside.sources.replay import replay_config, replay_events
from tests.test_landing import rows

DAY_US = 86_400_000_000


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return replay_events(spark, sf_dir, offsets=True).cache()


@pytest.fixture(scope="module")
def landed(spark, records):
    """Four batches on four days; a snapshot after the second and after the third."""
    path, config = work_dir(spark, "snapshots"), replay_config(spark)
    options = LandingOptions(target_bytes=600, segment_offsets=100)
    for batch in range(4):
        part = records.where(F.col("partition") % 4 == batch)
        land(part, config, path, options, batch_id=batch, sealed_us=1_700_000_000_000_000 + batch * DAY_US, run_id="job")
        if batch in (1, 2):
            assert write_snapshot(spark, path) and write_snapshot(spark, path) is None
    return path


def test_equals_the_ledger(spark, landed):
    files = landed_files(spark, landed)
    assert rows(files.drop(*BOUNDS)) == rows(manifest(spark, landed))
    bounds = files.select("low", "high", F.explode("offsets").alias("r"))
    assert bounds.where("low > r.start OR high < r.end").isEmpty()


def snapshot_inputs(df):
    return [f for f in df.inputFiles() if "/snapshots/" in f]


def test_only_the_tail_of_the_ledger_is_read(spark, landed):
    read = [f for f in landed_files(spark, landed).inputFiles() if "/ledger/" in f]
    assert read and all("/batch_id=3/" in f for f in read)


def test_days(spark, landed):
    files = landed_files(spark, landed, days=("2023-11-15", "2023-11-16"))
    want = manifest(spark, landed).where("batch_id IN (1, 2)")
    assert rows(files.drop(*BOUNDS)) == rows(want)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)


def test_streams_and_offsets(spark, landed, records):
    everything = manifest(spark, landed).collect()
    stream = sorted(r["stream_id"] for r in everything)[len(everything) // 2]
    one = landed_files(spark, landed, streams=[stream])
    assert {r["object_key"] for r in one.collect()} == {r["object_key"] for r in everything if r["stream_id"] == stream}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*stream_id", plan)

    span = next(r["offsets"][0] for r in everything if r["status"] == "uploaded" and r["batch_id"] == 1)
    asked = (span["topic"], span["partition"], span["start"], span["start"])
    few = landed_files(spark, landed, offsets=asked)
    want = {
        r["object_key"]
        for r in everything
        if any((x["topic"], x["partition"]) == asked[:2] and x["start"] <= asked[3] and x["end"] >= asked[2] for x in r["offsets"])
    }
    assert {r["object_key"] for r in few.collect()} == want and 0 < len(want) < len(everything) / 4
    # The reader opens these objects and no other.
    opened = read_landed(spark, landed, few).select("object_key").distinct()
    assert {r[0] for r in opened.collect()} == {k for k in want if k}


def test_nothing_unfinished_is_read(spark, records):
    path, config = work_dir(spark, "snapshots"), replay_config(spark)
    os.makedirs(f"{path}/ledger")
    assert write_snapshot(spark, path) is None and landed_files(spark, path).isEmpty()
    for batch in range(2):
        land(records.where(F.col("partition") == batch), config, path, batch_id=batch, run_id="job")
    first = write_snapshot(spark, path)
    # Another job's ledger without the committer's mark, and a snapshot without its list of batches.
    land(records.where("partition = 2"), config, path, batch_id=0, run_id="other")
    os.remove(f"{path}/ledger/run_id=other/batch_id=0/_SUCCESS")
    assert write_snapshot(spark, path) is None
    os.makedirs(f"{path}/snapshots/999999999999-aaaaaaaa/files")
    want = rows(manifest(spark, path, run_id="job"))
    assert rows(landed_files(spark, path).drop(*BOUNDS)) == want
    # A snapshot made at the same time as another has the same number; either is whole.
    open(f"{path}/ledger/run_id=other/batch_id=0/_SUCCESS", "w").close()
    assert write_snapshot(spark, path).split("-")[0] == f"{int(first.split('-')[0]) + 1:012d}"
    assert rows(landed_files(spark, path).drop(*BOUNDS)) == rows(manifest(spark, path))
    assert len(glob.glob(f"{path}/snapshots/*/batches/_SUCCESS")) == 2
