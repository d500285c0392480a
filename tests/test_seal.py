"""Sealing on Spark: both ways of running it, lanes and invariants."""

import pytest
from pyspark.sql import functions as F

from quayside.operators.packing import SealRules
from quayside.operators.records import consumed, process
from quayside.operators.seal import assign_files, in_full_files, lane, plan_files, seal_rules
from quayside.sources.replay import number_offsets, replay_config, replay_events


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return consumed(process(replay_events(spark, sf_dir, True), replay_config(spark))).cache()


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("target, age", [(1_000, None), (700, 86_400_000), (10**9, None), (1, None)])
@pytest.mark.parametrize("hot", [False, True])
def test_slices_change_nothing(records, target, age, hot):
    df = records.withColumn("stream_id", F.lit("hot")) if hot else records
    rules = seal_rules(df, target, age)
    assert rows(plan_files(df, rules)) == rows(plan_files(df, rules, slice_rows=60))


def test_a_hot_stream_among_others(records):
    skewed = records.withColumn(
        "stream_id", F.when(F.col("topic") == "topic-click", "hot").otherwise(F.col("stream_id"))
    )
    rules = seal_rules(skewed, 900, 86_400_000)
    extra = ("topic", "partition", "offset")
    assert rows(assign_files(skewed, rules, extra)) == rows(assign_files(skewed, rules, extra, slice_rows=40))


def test_records_and_files_agree(records):
    rules = SealRules(1_000)
    planned = assign_files(records, rules, ("topic", "partition", "offset"))
    assert planned.count() == planned.select("topic", "partition", "offset").distinct().count() == records.count()
    files = plan_files(records, rules)
    assert files.where("seal_reason = 'size' AND raw_size_b < 1000").isEmpty()
    assert files.where("seal_reason <> 'size' AND raw_size_b >= 1000").isEmpty()
    keys = ["shard", "stream_id", "file_seq"]
    assert rows(in_full_files(planned, rules).select(*keys).distinct()) == rows(files.where("seal_reason = 'size'").select(*keys))


def test_skipped_records_join_and_open_files(spark):
    data = [("s", t, t, size) for t, size in enumerate([0, 0, 60, 0, 60, 0])]
    df = spark.createDataFrame(data, "stream_id STRING, arrival_seq BIGINT, t BIGINT, line_bytes BIGINT")
    df = df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t")
    got = plan_files(df, SealRules(100)).orderBy("file_seq").collect()
    assert [(r.record_count, r.line_count, r.raw_size_b, r.seal_reason) for r in got] == [
        (5, 2, 120, "size"), (1, 0, 0, "final"),
    ]


def test_open_tails_and_due_ones(spark):
    data = [("old", 0, 10), ("new", 5_000, 10)]
    df = spark.createDataFrame(data, "stream_id STRING, ms BIGINT, line_bytes BIGINT")
    df = df.withColumns({"timestamp": F.timestamp_millis("ms"), "arrival_seq": F.col("ms")})
    rules = SealRules(100, max_age_ms=1_000)
    got = plan_files(df, rules, finalize=False, now_us=5_500_000).collect()
    assert {r.stream_id: r.seal_reason for r in got} == {"old": "dormant", "new": "open"}


def test_lanes_are_bounded_and_stable(records):
    laned = records.withColumn("shard", lane(2, 10))
    per_lane = laned.groupBy("shard", "topic", "partition").count()
    assert per_lane.agg(F.max("count")).first()[0] <= 10


def test_numbering_does_not_depend_on_blocks(spark, sf_dir):
    plain = replay_events(spark, sf_dir, True).select("topic", "partition", "arrival_seq", "offset")
    assert rows(number_offsets(plain.drop("offset"), "arrival_seq", block=64)) == rows(plain)
