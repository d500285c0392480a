"""Ranges, commits and gaps against plain Python walks."""

import random

import pytest

from quayside.operators import offsets as o
from quayside.operators.lifecycle import dormant_due, keep_assigned, revoked_streams
from quayside.operators.stats import initial_watermarks
from pyspark.sql import functions as F

ADDRESS = "topic STRING, partition INT, offset BIGINT"
MARKS = "topic STRING, partition INT, watermark BIGINT"


def offsets(spark, per_partition):
    data = [("t", p, n) for p, found in per_partition.items() for n in found]
    return spark.createDataFrame(data, ADDRESS)


def marks(spark, found):
    return spark.createDataFrame([("t", p, n) for p, n in found.items()], MARKS)


def as_ranges(found):
    out = []
    for n in sorted(set(found)):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def collected(ranges):
    got = {}
    for r in ranges.collect():
        got.setdefault(r.partition, []).append([r.start, r.end])
    return {p: sorted(v) for p, v in got.items()}


@pytest.fixture(scope="module")
def random_sets():
    rng = random.Random(3)
    sets = {}
    for p in range(60):
        top = rng.choice([5, 40, 300])
        sets[p] = [rng.randrange(top) for _ in range(rng.choice([1, top // 2 + 1, 3 * top]))]
    return sets


@pytest.mark.parametrize("block", [4, 16, o.BLOCK])
def test_ranges(spark, random_sets, block):
    want = {p: as_ranges(found) for p, found in random_sets.items()}
    df = offsets(spark, random_sets)
    assert collected(o.offset_ranges(df, block=block)) == want
    points = df.selectExpr("topic", "partition", "offset AS start", "offset + offset % 3 AS `end`")
    merged = {p: as_ranges([n + k for n in found for k in range(n % 3 + 1)]) for p, found in random_sets.items()}
    assert collected(o.merge_ranges(points, block=block)) == merged


@pytest.mark.parametrize("block", [4, o.BLOCK])
def test_commits_gaps_and_tracking(spark, random_sets, block):
    rng = random.Random(5)
    start = {p: rng.randrange(max(found) + 2) for p, found in random_sets.items() if p % 5}
    uploaded = o.offset_ranges(offsets(spark, random_sets), block=block)
    commits, gaps, kept = {}, {}, {}
    for p, found in random_sets.items():
        have, at = set(found), start.get(p)
        if at is None:
            kept[p] = as_ranges(have)
            continue
        end = at
        while end in have:
            end += 1
        if end > at:
            commits[p] = end
        rest = [n for n in have if n >= end]
        if rest:
            kept[p] = as_ranges(rest)
        above = [n for n in have if n >= at]
        if above:
            missing = as_ranges([n for n in range(at, max(above)) if n not in have])
            if missing:
                gaps[p] = missing
    watermarks = marks(spark, start)
    found = o.committable(uploaded, watermarks)
    assert {r.partition: r.commit_offset for r in found.collect()} == commits
    moved = o.advance(watermarks, found)
    assert collected(o.outstanding(uploaded, moved)) == kept
    got = o.commit_gaps(uploaded, watermarks, block=block)
    assert collected(got.selectExpr("partition", "gap_start AS start", "gap_end AS `end`")) == gaps
    held = sum(b - a + 1 for ranges in kept.values() for a, b in ranges)
    assert tuple(o.offset_backlog(o.outstanding(uploaded, moved)).first()) == (held, held * 8)


def test_golden_commits(spark):
    df = offsets(spark, {0: range(6), 1: [49, 50, 51, 55], 2: [9], 3: [1, 2], 4: [7]})
    watermarks = marks(spark, {0: 0, 1: 50, 2: 3, 3: 1})
    owned = spark.createDataFrame([("t", p) for p in (0, 1, 2, 4)], "topic STRING, partition INT")
    ranges = o.offset_ranges(df)
    got = o.committable(ranges, watermarks, owned).collect()
    assert {r.partition: r.commit_offset for r in got} == {0: 6, 1: 52}
    moved = o.advance(watermarks, o.committable(ranges, watermarks, owned))
    # Unowned partition 3 goes; partition 4 has no watermark and is kept.
    assert collected(o.outstanding(ranges, moved, owned)) == {1: [[55, 55]], 2: [[9, 9]], 4: [[7, 7]]}


def test_uploaded_union(spark):
    schema = f"status STRING, offsets ARRAY<STRUCT<topic: STRING, partition: INT, start: BIGINT, end: BIGINT>>"
    files = [
        ("uploaded", [("t", 0, 50, 51), ("t", 0, 55, 55)]),
        ("uploaded", [("t", 0, 52, 54)]),
        ("open", [("t", 0, 56, 60)]),
        ("released", [("t", 1, 3, 3)]),
    ]
    assert collected(o.uploaded_offsets(spark.createDataFrame(files, schema))) == {0: [[50, 55]], 1: [[3, 3]]}


def test_observed_next_steps_over_compacted_offsets(spark):
    delivered = o.offset_ranges(offsets(spark, {0: [0, 2, 4, 6]}))
    uploaded = o.offset_ranges(offsets(spark, {0: [0, 2, 4]}))
    watermarks = marks(spark, {0: 0})
    assert o.committable(uploaded, watermarks).first().commit_offset == 1
    assert o.committable(o.observed_next(uploaded, delivered), watermarks).first().commit_offset == 6


def test_initial_watermark_follows_arrival(spark):
    df = spark.createDataFrame([("t", 0, 7, 1), ("t", 0, 3, 2)], f"{ADDRESS}, arrival_seq INT")
    assert initial_watermarks(df).first().watermark == 7


def test_revoke(spark):
    opened = [("gone", "t", 0), ("gone", "t", 1), ("mixed", "t", 1), ("mixed", "t", 2), ("kept", "t", 2)]
    df = spark.createDataFrame(opened, "stream_id STRING, topic STRING, partition INT")
    revoked = spark.createDataFrame([("t", 0), ("t", 1)], "topic STRING, partition INT")
    got = {r.stream_id: r.dropped for r in revoked_streams(df, revoked).collect()}
    assert got == {"gone": True, "mixed": False, "kept": False}
    left = keep_assigned(marks(spark, {0: 1, 1: 1, 2: 5}), revoked).collect()
    assert [(r.partition, r.watermark) for r in left] == [(2, 5)]


def test_due_files_and_capacity(spark):
    data = [(0, "a", 100), (0, "b", 200), (0, "c", 201), (0, "d", 50)]
    opened = spark.createDataFrame(data, "shard INT, stream_id STRING, created_us BIGINT")
    due = lambda capacity=None: [
        r.stream_id for r in dormant_due(opened, F.lit(1200), 1000, capacity).orderBy("created_us").collect()
    ]
    assert due() == ["d", "a", "b"]
    assert due(2) == ["d", "a"]
    assert due(-1) == []


def shuffled_records(df):
    """Records that the exchanges of a plan wrote; an exchange that is read again counts once."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(plan.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec":
                total += plan.metrics().apply("shuffleRecordsWritten").value()
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


def test_ranges_inside_blocks_meet_no_others(spark):
    """Only a row per block and the ranges at block edges are shuffled, sorted or held for a window."""
    spread = [2 * n + 1 for n in range(4000)]
    ranges = offsets(spark, {0: spread, 1: spread}).coalesce(1)
    found = o.offset_ranges(ranges)
    assert found.count() == 8000 and shuffled_records(found) < 100
    rows = [("t", p, n, n) for p in (0, 1) for n in spread]
    stored = spark.createDataFrame(rows, "topic STRING, partition INT, start BIGINT, `end` BIGINT").coalesce(1)
    first = marks(spark, {0: 1, 1: 3})
    merged, gaps, filled = o.merge_ranges(stored.union(stored)), o.commit_gaps(stored, first), o.observed_next(stored, stored)
    commits, kept = o.committable(stored, first), o.outstanding(stored, first)
    for df, n in ((merged, 8000), (gaps, 7997), (filled, 2), (commits, 2), (kept, 7999)):
        assert df.count() == n and shuffled_records(df) < 100
