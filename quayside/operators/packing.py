"""Where files end: numpy helpers that run inside tasks.

Records of one (shard, stream) fill a file until its written bytes reach the target (that
line still goes in) or until a tick finds it old enough. Arrays hold consecutive records
in arrival order: `t` in microseconds, non-decreasing; `size` written bytes, 0 if skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import NamedTuple

import numpy as np

NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class SealRules:
    """Target of written bytes per file; age after which a tick closes a file, or None."""

    target_bytes: int
    max_age_ms: int | None = None
    t0_us: int = 0

    def __post_init__(self):
        if self.target_bytes < 1:
            raise ValueError("target_bytes must be positive")
        if self.max_age_ms is not None and self.max_age_ms < 10:
            raise ValueError("max_age_ms must be at least 10: ticks come every tenth of it")

    @property
    def tick_us(self) -> int:
        return self.max_age_ms // 10 * 1000

    def due(self, created):
        """First tick at which a file created then is old enough. Scalar or array."""
        if self.max_age_ms is None:
            return np.full_like(created, NEVER)
        age = created + self.max_age_ms * 1000 - self.t0_us
        return self.t0_us + -(-age // self.tick_us) * self.tick_us


class Cursor(NamedTuple):
    """Where a stream stands: its open file, if any, and the number of files opened."""

    open: bool = False
    filled: int = 0
    created: int = 0
    files: int = 0


class Span(NamedTuple):
    """Records `start:stop` of a run belong to file `seq`; `reason` is set if it ends there."""

    start: int
    stop: int
    seq: int
    created: int
    reason: str | None
    sealed_us: int | None


def spans(t: np.ndarray, size: np.ndarray, at: Cursor, rules: SealRules) -> tuple[list[Span], Cursor]:
    """Cuts a run of records at the file ends; one step per file, not per record."""
    done = np.cumsum(size)
    n, pos, found = len(t), 0, []
    while True:
        if at.open:
            due = int(rules.due(np.int64(at.created)))
            aged = int(np.searchsorted(t, due)) if due != NEVER else n
            if aged < n and aged <= pos:
                found.append(Span(pos, pos, at.files - 1, at.created, "dormant", due))
                at = Cursor(files=at.files)
                continue
        elif pos == n:
            return found, at
        else:
            at = Cursor(True, 0, int(t[pos]), at.files + 1)
            continue
        if pos == n:
            return found, at
        before = int(done[pos - 1]) if pos else 0
        full = int(np.searchsorted(done, before + rules.target_bytes - at.filled)) + 1
        stop = min(full, aged, n)
        if full <= min(aged, n):
            reason, sealed = "size", int(t[stop - 1])
        elif aged < n:
            reason, sealed = "dormant", due
        else:
            reason, sealed = None, None
        found.append(Span(pos, stop, at.files - 1, at.created, reason, sealed))
        if reason:
            at = Cursor(files=at.files)
        else:
            at = at._replace(filled=at.filled + int(done[stop - 1]) - before)
        pos = stop


@dataclass
class Cursors:
    """Many alternative cursors as columns."""

    open: np.ndarray
    filled: np.ndarray
    created: np.ndarray
    files: np.ndarray

    @classmethod
    def of(cls, *cursors: Cursor) -> Cursors:
        columns = zip(*cursors) if cursors else [[]] * 4
        return cls(*(np.array(c, d) for c, d in zip(columns, (bool, "i8", "i8", "i8"))))

    def one(self, i: int = 0) -> Cursor:
        return Cursor(
            bool(self.open[i]), int(self.filled[i]), int(self.created[i]), int(self.files[i])
        )

    def take(self, rows) -> Cursors:
        return Cursors(self.open[rows], self.filled[rows], self.created[rows], self.files[rows])

    @staticmethod
    def concat(parts: list[Cursors]) -> Cursors:
        return Cursors(
            *(np.concatenate([getattr(p, c) for p in parts]) for c in ("open", "filled", "created", "files"))
        )


@dataclass
class Entries:
    """Ways the file open at the start of a slice can end: sorted `at` -> `pos` -> exit.

    For size entries `at` is the bytes written in the slice up to a line that may complete
    the file, for age entries it is a tick. The next file starts at record `pos`.
    """

    at: np.ndarray
    pos: np.ndarray
    exit: Cursors


@dataclass
class Transfer:
    """What a slice does to the cursor of the stream that enters it.

    Only a slice that lies within one stream passes anything on (`single`); any other
    leaves with `fresh`, whatever comes in.
    """

    first: str
    last: str
    rows: int
    total: int
    opens_us: int
    fresh: Cursor
    size: Entries | None = None
    age: Entries | None = None
    single: bool = field(init=False)

    def __post_init__(self):
        self.single = self.first == self.last

    def apply(self, stream: str | None, at: Cursors, rules: SealRules) -> Cursors:
        """Cursors of the last stream after the slice, for cursors of `stream` before it."""
        n = len(at.open)
        if not self.single or stream != self.first:
            return Cursors.of(*[self.fresh] * n)
        none = np.int64(NEVER)
        by_size = np.searchsorted(self.size.at, rules.target_bytes - at.filled)
        by_age = np.searchsorted(self.age.at, rules.due(at.created))
        size_pos = np.append(self.size.pos, none)[by_size]
        age_pos = np.append(self.age.pos, none)[by_age]
        # Rows of one table: fresh start, size entries, age entries, then the pass-through.
        table = Cursors.concat(
            [Cursors.of(self.fresh), self.size.exit, self.age.exit, Cursors.of(Cursor(True))]
        )
        k = 1 + len(self.size.at)
        through = (size_pos == none) & (age_pos == none)
        row = np.where(age_pos < size_pos, k + by_age, 1 + by_size)
        row = np.where(at.open, np.where(through, len(table.open) - 1, row), 0)
        out = table.take(row)
        through &= at.open
        return Cursors(
            out.open,
            np.where(through, at.filled + self.total, out.filled),
            np.where(through, at.created, out.created),
            out.files + at.files,
        )


def _exits(starts: np.ndarray, t: np.ndarray, done: np.ndarray, rules: SealRules) -> Cursors:
    """Cursor at the end of the run if a file starts at record `starts[i]`, for all at once."""
    n = len(t)
    at, back = np.unique(starts, return_inverse=True)
    files = np.zeros(len(at), "i8")
    last = at.copy()
    live = np.flatnonzero(at < n)
    while len(live):
        last[live] = at[live]
        files[live] += 1
        before = np.where(at[live] > 0, done[at[live] - 1], 0)
        full = np.searchsorted(done, before + rules.target_bytes) + 1
        aged = np.searchsorted(t, rules.due(t[at[live]]))
        nxt = np.minimum(full, np.where(aged < n, aged, n + 1))
        at[live] = nxt
        live = live[nxt < n]
    is_open = at > n
    held = np.where(last > 0, done[last - 1], 0) if n else last
    total = done[-1] if n else 0
    out = Cursors(
        is_open,
        np.where(is_open, total - held, 0),
        np.where(is_open, t[np.minimum(last, n - 1)], 0),
        files,
    )
    return out.take(back)


def transfer(first: str, last: str, t: np.ndarray, size: np.ndarray, rules: SealRules) -> Transfer:
    """Transfer of a slice; `t` and `size` are those of its last stream."""
    done = np.cumsum(size)
    n, total = len(t), int(done[-1])
    fresh = _exits(np.zeros(1, "i8"), t, done, rules).one()
    out = Transfer(first, last, n, total, int(t[0]), fresh)
    if not out.single:
        return out
    ends = np.flatnonzero((size > 0) & (done - size < rules.target_bytes))
    out.size = Entries(done[ends], ends + 1, _exits(ends + 1, t, done, rules))
    ticks = np.zeros(0, "i8")
    if rules.max_age_ms is not None:
        # A file open at the start was created before t[0], so it is due by due(t[0]).
        stop = int(rules.due(np.int64(t[0])))
        ticks = np.arange(stop - rules.max_age_ms * 1000 - 2 * rules.tick_us, stop + 1, rules.tick_us)
    pos = np.searchsorted(t, ticks)
    ticks, pos = ticks[pos < n], pos[pos < n]
    out.age = Entries(ticks, pos, _exits(pos, t, done, rules))
    return out


def walk(
    tables: Iterator[tuple[int, Transfer]], rules: SealRules, stream: str | None, at: Cursor
) -> Iterator[tuple[int, str | None, Cursor]]:
    """The cursor that enters each slice of a sequence."""
    for index, table in tables:
        yield index, stream, at
        at = table.apply(stream, Cursors.of(at), rules).one()
        stream = table.last


def compose(tables: Iterator[Transfer], rules: SealRules) -> Transfer | None:
    """One transfer for a sequence of slices."""
    out, size, age = None, [], []
    for table in tables:
        if out is None:
            out, size, age = table, [table.size], [table.age]
            horizon = rules.due(np.int64(table.opens_us))
            continue
        fresh = table.apply(out.last, Cursors.of(out.fresh), rules).one()
        if out.single and table.single and out.last == table.first:
            size = [replace(e, exit=table.apply(out.last, e.exit, rules)) for e in size]
            age = [replace(e, exit=table.apply(out.last, e.exit, rules)) for e in age]
            if out.total < rules.target_bytes:
                keep = table.size.at - _steps(table.size.at) < rules.target_bytes - out.total
                size.append(_shifted(table.size, keep, out.total, out.rows))
                known = max((int(e.at[-1]) for e in age if len(e.at)), default=-NEVER)
                keep = (table.age.at > known) & (table.age.at <= horizon)
                age.append(_shifted(table.age, keep, 0, out.rows))
        else:
            size, age = [None], [None]
        out = Transfer(
            out.first, table.last, out.rows + table.rows, out.total + table.total, out.opens_us, fresh
        )
    if out is not None and out.single:
        out.size, out.age = _joined(size), _joined(age)
    return out


def _steps(at: np.ndarray) -> np.ndarray:
    return np.diff(at, prepend=0)


def _shifted(e: Entries, keep: np.ndarray, at: int, pos: int) -> Entries:
    return Entries(e.at[keep] + at, e.pos[keep] + pos, e.exit.take(keep))


def _joined(parts: list[Entries]) -> Entries:
    return Entries(
        np.concatenate([e.at for e in parts]),
        np.concatenate([e.pos for e in parts]),
        Cursors.concat([e.exit for e in parts]),
    )
