"""File ends against a record-by-record walk, for plain runs, chunks and chained slices."""

import numpy as np
import pytest

from quayside.operators.packing import Cursor, SealRules, compose, spans, transfer, walk


def walked(t, size, rules):
    files, current = [], None
    for i, (now, n) in enumerate(zip(t.tolist(), size.tolist())):
        if current and rules.max_age_ms is not None and int(rules.due(np.int64(current[1]))) <= now:
            files.append((*current, "dormant"))
            current = None
        if not current:
            current = [i, now, 0, 0]
        current[3] += 1
        current[2] += n
        if n and current[2] >= rules.target_bytes:
            files.append((*current, "size"))
            current = None
    return files + ([(*current, None)] if current else [])


def collected(pieces, size):
    files = {}
    for low, s in pieces:
        f = files.setdefault(s.seq, [None, s.created, 0, 0, None])
        if s.stop > s.start and f[0] is None:
            f[0] = low + s.start
        f[2] += int(size[low + s.start : low + s.stop].sum())
        f[3] += s.stop - s.start
        f[4] = f[4] or s.reason
    return [tuple(files[k]) for k in sorted(files)]


def cases():
    rng = np.random.default_rng(7)
    for _ in range(250):
        n = int(rng.integers(1, 300))
        t = np.sort(rng.integers(0, int(rng.choice([50, 5_000, 10**6, 10**8])), n)).astype("i8")
        size = (np.full(n, 10) if rng.random() < 0.4 else rng.integers(1, 40, n)).astype("i8")
        size[rng.random(n) < rng.choice([0, 0.3, 0.95, 1])] = 0
        age = None if rng.random() < 0.4 else int(rng.choice([10, 100, 5_000]))
        rules = SealRules(int(rng.choice([1, 30, 100, 1_000, 10**5])), age, int(t[0]))
        cuts = sorted({0, n, *rng.integers(0, n + 1, int(rng.integers(0, 12))).tolist()})
        yield t, size, rules, list(zip(cuts, cuts[1:])), int(rng.integers(1, 5))


def test_runs_chunks_and_slices_agree():
    for t, size, rules, parts, width in cases():
        want = walked(t, size, rules)
        found, _ = spans(t, size, Cursor(), rules)
        assert collected([(0, s) for s in found], size) == want

        at, pieces, entering, tables = Cursor(), [], [], []
        for i, (a, b) in enumerate(parts):
            entering.append(at)
            tables.append((i, transfer("s", "s", t[a:b], size[a:b], rules)))
            found, at = spans(t[a:b], size[a:b], at, rules)
            pieces += [(a, s) for s in found]
        assert collected(pieces, size) == want

        assert [x[2] for x in walk(iter(tables), rules, None, Cursor())] == entering
        blocks = [tables[i : i + width] for i in range(0, len(tables), width)]
        composed = [(i, compose((x for _, x in b), rules)) for i, b in enumerate(blocks)]
        chained = []
        for (_, stream, cursor), block in zip(walk(iter(composed), rules, None, Cursor()), blocks):
            chained += [x[2] for x in walk(iter(block), rules, stream, cursor)]
        assert chained == entering


def test_two_lines_fill_a_file():
    t, size = np.arange(3, dtype="i8"), np.array([70, 70, 70], "i8")
    found, at = spans(t, size, Cursor(), SealRules(128))
    assert [(s.start, s.stop, s.seq, s.reason) for s in found] == [(0, 2, 0, "size"), (2, 3, 1, None)]
    assert at == Cursor(True, 70, 2, 2)


def test_age_cut_off_is_inclusive():
    rules = SealRules(10**6, max_age_ms=1_000, t0_us=0)
    found, _ = spans(np.array([0, 1_000_000], "i8"), np.array([1, 1], "i8"), Cursor(), rules)
    assert [s.reason for s in found] == ["dormant", None]
    found, _ = spans(np.array([0, 999_999], "i8"), np.array([1, 1], "i8"), Cursor(), rules)
    assert [s.reason for s in found] == [None]


@pytest.mark.parametrize("bad", [{"target_bytes": 0}, {"target_bytes": 1, "max_age_ms": 9}])
def test_rules_are_checked(bad):
    with pytest.raises(ValueError):
        SealRules(**bad)
