"""Files that stay open in the state store of a streaming query."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
import zstandard
from pyspark.sql import functions as F

from quayside.operators.packing import SealRules
from quayside.operators.records import consumed, process
from quayside.operators.seal import plan_files
from quayside.plans.queries import BATCHES, _arrivals
from quayside.session import work_dir
from quayside.sinks.landing import LandingOptions, manifest, quarantined
from quayside.sources.landed import read_landed
from quayside.sources.records import read_record_file_stream
from quayside.sources.replay import replay_config, replay_events
from quayside.streaming.landing import commit_log
from quayside.streaming import open_files as module
from quayside.streaming.open_files import drain_open_files, merged, open_files, start_open_files
from quayside.streaming.reports import RunReport, run_reports

OPTIONS = LandingOptions(target_bytes=900, shards=1, segment_offsets=None)
COLUMNS = ["stream_id", "record_count", "line_count", "raw_size_b", "created_us", "seal_reason"]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return replay_events(spark, sf_dir, offsets=True).cache()


@pytest.fixture(scope="module")
def config(spark):
    return replay_config(spark)


def add(records, stage, part, parts):
    """The part-th of so many pieces in arrival order, as a file of its own."""
    step = -(-records.count() // parts)
    piece = records.where(F.floor(F.col("arrival_seq") / step) == part).drop("arrival_seq")
    piece.coalesce(1).write.mode("append").parquet(stage)


def run(spark, config, stage, path, options=OPTIONS):
    stream = read_record_file_stream(spark, stage, files_per_batch=1)
    query = start_open_files(stream, config, path, f"{path}/checkpoint", options, {"availableNow": True})
    query.awaitTermination()
    return query


def test_merged():
    assert merged([("b", 0, 5, 6), ("a", 1, 3, 4), ("a", 0, 4, 4), ("a", 0, 0, 3), ("a", 0, 6, 9), ("a", 0, 7, 7)]) == [
        ("a", 0, 0, 4),
        ("a", 0, 6, 9),
        ("a", 1, 3, 4),
        ("b", 0, 5, 6),
    ]


def test_restarts_and_repeats_give_the_files_of_one_batch(spark, records, config):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    first = records.agg(F.min("arrival_seq")).first()[0]
    moved = records.withColumn("arrival_seq", F.col("arrival_seq") - first)
    add(moved, stage, 0, 4)
    add(moved, stage, 1, 4)
    run(spark, config, stage, path)
    add(moved, stage, 2, 4)
    query = run(spark, config, stage, path)
    last = query.lastProgress["batchId"]
    assert not Path(f"{path}/open").exists()

    # The driver died after the last batch was landed but before the checkpoint knew.
    before = rows(manifest(spark, path).drop("failed_attempts"))
    commits = Path(f"{path}/checkpoint/commits")
    for name in (f"{last}", f".{last}.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    run(spark, config, stage, path)
    after = manifest(spark, path).where(F.col("batch_id") <= last).drop("failed_attempts")
    assert rows(after) == before

    add(moved, stage, 3, 4)
    last = run(spark, config, stage, path).lastProgress["batchId"]
    for _ in range(2):
        drain_open_files(spark, path, f"{path}/checkpoint", last, OPTIONS)
    with pytest.raises(ValueError, match="drained"):
        run(spark, config, stage, path)
    plan = plan_files(consumed(process(records, config)), SealRules(900)).select(*COLUMNS)
    files = manifest(spark, path).where("status <> 'open'")
    assert rows(files.select(*COLUMNS)) == rows(plan)
    expected = process(records, config).where("outcome = 'ok'")
    landed = read_landed(spark, path, files).select("stream_id", F.col("line").cast("string").alias("line"))
    assert rows(landed) == rows(expected.select("stream_id", F.col("line").cast("string").alias("line")))
    held = files.select(F.explode("offsets").alias("r")).select("r.topic", "r.partition", F.explode(F.sequence("r.start", "r.end")).alias("offset"))
    rejects = quarantined(spark, path).select("topic", "partition", "offset")
    assert rows(held.unionByName(rejects)) == rows(records.select("topic", "partition", "offset"))
    ends = commit_log(spark, path).groupBy("topic", "partition").agg(F.max("commit_offset").alias("n"))
    assert rows(ends) == rows(records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("n")))


def test_reports_are_the_ledger_batch_by_batch(spark, records, config):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    first = records.agg(F.min("arrival_seq")).first()[0]
    moved = records.withColumn("arrival_seq", F.col("arrival_seq") - first)
    for part in range(2):
        add(moved, stage, part, 2)
    stream = read_record_file_stream(spark, stage, files_per_batch=1)
    report = RunReport(path, "reported")
    spark.streams.addListener(report)
    try:
        query = start_open_files(stream, config, path, f"{path}/checkpoint", OPTIONS, {"availableNow": True}, "reported")
        query.awaitTermination()
        assert report.wait()
    finally:
        spark.streams.removeListener(report)
    found = run_reports(spark, path)
    files = manifest(spark, path).where("status <> 'open'")
    by_batch = files.groupBy("batch_id").agg(
        F.sum("line_count").alias("record_count"),
        F.sum("raw_size_b").alias("raw_size_b"),
        F.count("*").alias("files_sealed"),
        F.count_if(F.col("status") == "uploaded").alias("successful_uploads"),
    )
    assert rows(found.select(*by_batch.columns)) == rows(by_batch)
    lines = process(records, config).where("outcome = 'ok'").count()
    taken, rejects, least = found.agg(F.sum("lines_taken"), F.sum("rejects"), F.min("record_per_sec")).first()
    assert (taken, rejects) == (lines, quarantined(spark, path).count()) and least > 0


def test_a_batch_writes_only_what_it_brought(spark, records, config):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    first = records.agg(F.min("arrival_seq")).first()[0]
    moved = records.withColumn("arrival_seq", F.col("arrival_seq") - first)
    large = LandingOptions(target_bytes=10**9, shards=1, segment_offsets=None)
    for part in range(3):
        add(moved, stage, part, 3)
    run(spark, config, stage, path, large)
    brought = manifest(spark, path).where("status = 'open' AND line_count > 0")
    expected = {(r.stream_id, r.batch_id): (r.line_count, r.raw_size_b) for r in brought.collect()}
    found = {}
    for file in open_files(spark, f"{path}/checkpoint").collect():
        batches = sorted(b for s, b in expected if s == file.stream_id)
        assert len(file.frames or []) == len(batches)  # a frame a batch, none joined or rewritten
        for batch, (frame,) in zip(batches, file.frames or []):
            text = zstandard.ZstdDecompressor().decompressobj().decompress(frame)
            found[file.stream_id, batch] = (text.count(b"\n"), len(text))
    assert found == expected
    assert not Path(f"{path}/objects").exists()


def test_timers_close_files_that_get_no_more(spark, records, config):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    aged = LandingOptions(target_bytes=10**9, shards=1, max_age_ms=1000)
    records.limit(200).drop("arrival_seq").coalesce(1).write.parquet(stage)
    stream = read_record_file_stream(spark, stage)
    query = start_open_files(stream, config, path, f"{path}/checkpoint", aged, {"processingTime": "1 second"})
    try:
        end = time.time() + 90
        taken, files = 0, None
        while time.time() < end:
            if not Path(f"{path}/ledger").exists():
                time.sleep(1)
                continue
            files = manifest(spark, path).where("status <> 'open'")
            taken = files.agg(F.sum("record_count")).first()[0] or 0
            if taken + quarantined(spark, path).count() == 200:
                break
            time.sleep(1)
        # The state is read as of the last batch that the checkpoint has.
        sealed = files.agg(F.max("batch_id")).first()[0]
        while time.time() < end and query.lastProgress["batchId"] < sealed:
            time.sleep(1)
    finally:
        query.stop()
    assert taken + quarantined(spark, path).count() == 200
    assert {r.seal_reason for r in files.collect()} == {"dormant"}
    assert open_files(spark, f"{path}/checkpoint").count() == 0


def test_a_report_waits_for_each_run_of_its_query():
    report, event = RunReport("/nowhere", "again"), SimpleNamespace(name="again", id="q")
    for _ in range(2):
        report.onQueryStarted(event)
        assert not report.wait(0)
        report.onQueryTerminated(event)
        assert report.wait(0)


def test_commits_plan_adaptively_and_no_reject_is_lost(spark, records, config, monkeypatch):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    # Each record has an unknown topic, so all are rejects.
    records.withColumn("topic", F.lit("elsewhere")).drop("arrival_seq").coalesce(1).write.parquet(stage)
    sessions, commits = [], module.record_commits

    def seen(session, *args):
        sessions.append(session.conf.get("spark.sql.adaptive.enabled"))
        commits(session, *args)

    monkeypatch.setattr(module, "record_commits", seen)
    run(spark, config, stage, path)
    assert sessions == ["true"]
    assert quarantined(spark, path).count() == records.count() > module.REJECT_KEYS


def test_pieces_of_a_replay_come_in_order_and_whole(spark, records, sf_dir):
    numbered = records.select("topic", "partition", "offset", "arrival_seq")
    pieces = [p.join(numbered, ["topic", "partition", "offset"]) for p in _arrivals(spark, sf_dir)]
    spans = [p.agg(F.min("arrival_seq"), F.max("arrival_seq"), F.count("*")).first() for p in pieces]
    assert len(spans) == BATCHES and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(s[2] for s in spans) == records.count()
