"""The log of offsets against a plain walk over the same history."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quayside.session import work_dir
from quayside.streaming import offset_log
from quayside.streaming.offset_log import RANGES, append_offsets, cover, moves, offsets_after, trim_log
from tests.test_offsets import as_ranges


class Walk:
    """All uploaded offsets and watermarks, step by step."""

    def __init__(self):
        self.uploaded, self.marks, self.states = {}, {}, []

    def step(self, released, consumed):
        for p, found in consumed.items():
            self.marks.setdefault(p, min(found))
        for p, found in released.items():
            self.uploaded.setdefault(p, set()).update(found)
        moved = {}
        for p, at in self.marks.items():
            end = at
            while end in self.uploaded.get(p, ()):
                end += 1
            moved[p] = end
        self.marks = moved
        held = {p: as_ranges(n for n in found if n >= moved[p]) for p, found in self.uploaded.items()}
        self.states.append(({p: r for p, r in held.items() if r}, dict(moved)))


def history(seed, steps):
    """Steps that consume some partitions and release some of what was consumed so far, some of it again."""
    rng = random.Random(seed)
    pending, top, out = {}, {}, []
    for _ in range(steps):
        consumed, released = {}, {}
        for p in rng.sample(range(6), rng.choice([0, 1, 2, 3])):
            low = top.get(p, rng.randrange(50))
            new = range(low, low + rng.randrange(1, 12))
            top[p] = new[-1] + 1
            pending.setdefault(p, set()).update(new)
            consumed[p] = list(new)
            done = [n for n in sorted(pending[p]) if rng.random() < 0.6]
            if done:
                released[p] = done
                pending[p] -= set(done[: len(done) // 2 + 1])  # the others come again
        out.append((released, consumed))
    return out


def as_frame(spark, sets):
    data = [("t", p, a, b) for p, found in sets.items() for a, b in as_ranges(found)]
    return spark.createDataFrame(data, RANGES)


def state(spark, path, step, of=None):
    ranges, marks = offsets_after(spark, path, "run", step, of)
    held = {}
    for r in sorted(ranges.collect(), key=lambda r: (r.partition, r.start)):
        held.setdefault(r.partition, []).append([r.start, r.end])
    return held, {r.partition: r.watermark for r in marks.collect()}


def play(spark, path, steps, walk, first=0):
    for n, (released, consumed) in enumerate(steps, first):
        walk.step(released, consumed)
        append_offsets(spark, path, "run", n, as_frame(spark, released), as_frame(spark, consumed))


def test_cover(monkeypatch):
    monkeypatch.setattr(offset_log, "FAN", 3)
    for steps in range(100):
        at = 0
        for level, start in cover(steps):
            assert start == at and start % 3**level == 0
            at += 3**level
        assert at == steps and len(cover(steps)) <= 2 * 5


def test_every_state_equals_the_walk(spark, monkeypatch):
    monkeypatch.setattr(offset_log, "FAN", 2)
    path, walk, steps = work_dir(spark, "log"), Walk(), history(7, 11)
    play(spark, path, steps, walk)
    for n, want in enumerate(walk.states):
        assert state(spark, path, n) == want, n
    assert state(spark, path, -1) == ({}, {})
    # Merged entries are there, and a late state is read from few.
    assert (Path(path) / "offset_log/marks/run_id=run/level=3/at=0/_SUCCESS").exists()
    # A step writes the partitions that it touched and no others.
    for n, (released, consumed) in enumerate(steps):
        folder = "offset_log/{}/run_id=run/level=0/at=" + str(n)
        written = spark.read.schema(RANGES).parquet(f"{path}/{folder.format('ranges')}")
        assert {r.partition for r in written.collect()} == set(released)
        before = walk.states[n - 1][1] if n else {}
        changed = {p for p, at in walk.states[n][1].items() if before.get(p) != at}
        marks = spark.read.parquet(f"{path}/{folder.format('marks')}").collect()
        assert {r.partition for r in marks} == changed
        assert all(r.previous == before.get(r.partition, min(consumed[r.partition])) for r in marks)
    # Some partitions only, also ones that the log does not know.
    of = spark.createDataFrame([("t", 1), ("t", 99)], "topic STRING, partition INT")
    held, marks = walk.states[-1]
    assert state(spark, path, 10, of) == ({p: r for p, r in held.items() if p == 1}, {p: n for p, n in marks.items() if p == 1})

    # A step that is repeated changes nothing.
    released, consumed = steps[10]
    append_offsets(spark, path, "run", 10, as_frame(spark, released), as_frame(spark, consumed))
    assert state(spark, path, 10) == walk.states[10]

    # One that failed between its ranges and its watermarks does not count until it is repeated.
    (Path(path) / "offset_log/marks/run_id=run/level=0/at=10/_SUCCESS").unlink()
    assert state(spark, path, 10) == walk.states[9]
    append_offsets(spark, path, "run", 10, as_frame(spark, released), as_frame(spark, consumed))
    assert state(spark, path, 10) == walk.states[10]

    # Trimmed, the log goes on; states before cannot be read, commits can.
    commits = sorted(map(tuple, moves(spark, path).collect()))
    assert trim_log(path, "run", 9) > 0
    assert trim_log(path, "run", 4) == 0
    assert state(spark, path, 9) == walk.states[9] and state(spark, path, 10) == walk.states[10]
    with pytest.raises(ValueError, match="trimmed"):
        offsets_after(spark, path, "run", 8)
    play(spark, path, history(8, 2), walk, 11)
    assert state(spark, path, 12) == walk.states[12]
    assert sorted(map(tuple, moves(spark, path).where("at < 11").collect())) == commits


def test_steps_with_gaps_and_other_runs(spark, monkeypatch):
    monkeypatch.setattr(offset_log, "FAN", 2)
    path, walk = work_dir(spark, "log"), Walk()
    for n, (released, consumed) in zip((1, 2, 6, 9), history(11, 4)):
        walk.step(released, consumed)
        append_offsets(spark, path, "run", n, as_frame(spark, released), as_frame(spark, consumed))
    append_offsets(spark, path, "other", 0, as_frame(spark, {0: [7]}), as_frame(spark, {0: [7]}))
    assert state(spark, path, 9) == walk.states[3] and state(spark, path, 8) == walk.states[2] and state(spark, path, 1) == walk.states[0]
    assert moves(spark, path).where(F.col("run_id") == "other").count() == 1
