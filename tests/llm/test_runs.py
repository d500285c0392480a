import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import runs
from quayside.llm.common import table


def brute(words):
    """Every stretch by its definition: for each period the maximal stretches, smallest period only."""
    found = {}
    n = len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q):
                found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def check(words):
    got = runs.find_runs([np.array(words, np.int64)])[0].tolist()
    assert [tuple(r) for r in got] == brute(words), words


def test_suffix_array_and_wavelet_tree():
    draw = np.random.default_rng(3)
    for size in (1, 2, 7, 40, 200):
        words = draw.integers(0, 3, size)
        array = runs.SuffixArray(words.copy())
        assert array.order.tolist() == sorted(range(size), key=lambda i: words[i:].tolist())
        for k, rank in enumerate(array.ranks):
            for i in range(size):
                for j in range(i + 1, size):
                    same = words[i : i + 2**k].tolist() == words[j : j + 2**k].tolist()
                    assert (rank[i] == rank[j]) == same
        tree = runs.WaveletTree(array.order)
        lo = draw.integers(0, size, 100)
        hi = lo + draw.integers(0, size, 100) % (size - lo + 1)
        limit = draw.integers(0, size + 3, 100)
        held = [sorted(array.order[a:b].tolist()) for a, b in zip(lo, hi, strict=True)]
        assert tree.below(lo, hi, limit).tolist() == [sum(x < m for x in h) for h, m in zip(held, limit, strict=True)]
        full = np.flatnonzero(hi > lo)
        pick = (limit[full]) % (hi - lo)[full]
        assert tree.nth(lo[full], hi[full], pick).tolist() == [held[i][p] for i, p in zip(full, pick, strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_against_brute_force(data):
    """Concatenated powers of short words over few letters: nested, touching and shifted runs."""
    words = []
    for _ in range(data.draw(st.integers(1, 4))):
        base = data.draw(st.lists(st.integers(0, 2), min_size=1, max_size=14))
        if data.draw(st.booleans()):
            base = base[:2] * data.draw(st.integers(1, 9)) + base[2:4]
        words += base * data.draw(st.integers(1, 9)) + base[: data.draw(st.integers(0, len(base)))]
    check(words)


@pytest.mark.parametrize("seed", range(30))
def test_periodic_periods(seed):
    """Periods that are nearly periodic themselves, whose blocks repeat far more often than they do."""
    draw = np.random.default_rng(seed)
    inner = draw.integers(0, 3, draw.integers(1, 5)).tolist()
    unit = inner * int(draw.integers(2, 40)) + draw.integers(0, 4, draw.integers(0, 4)).tolist()
    tail = unit * int(draw.integers(3, 7)) + unit[: int(draw.integers(0, len(unit)))]
    check(draw.integers(0, 5, draw.integers(0, 60)).tolist() + tail + draw.integers(0, 5, draw.integers(0, 60)).tolist())


def test_documents_do_not_meet():
    same = [np.array([1, 2, 3] * 9), np.array([1, 2, 3] * 9), np.empty(0, np.int64), np.array([3] * 23), np.array([3] * 24)]
    assert [r.tolist() for r in runs.find_runs(same)] == [[[0, 27, 3]], [[0, 27, 3]], [], [], [[0, 24, 1]]]


def expected(doc_id, text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("length(text) < 20000 OR text IS NULL")
    got = sorted(map(tuple, runs.periodic_runs(docs, plant=True).collect()))
    assert got == sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) >= 15


def test_awkward(awkward, no_docs):
    short = awkward.filter("text IS NULL OR length(text) < 10000")
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in runs.periodic_runs(short, plant=True).collect()), key=key)
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in short.collect()), key=key)
    long = [r for r in runs.periodic_runs(awkward).collect() if r["doc_id"] == 4][0]
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 40_000, 977)
    assert runs.periodic_runs(no_docs).collect() == []


def test_collapsed(spark):
    docs = spark.createDataFrame([(1, "a b " * 20 + "été " * 30), (2, "x")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in runs.periodic_runs(docs, collapsed=True).collect()}
    assert rows[1]["text"] == "a b été" and rows[2]["text"] == "x" and rows[2]["runs"] == []
    assert [tuple(r) for r in rows[1]["runs"]] == [(0, 40, 2), (40, 30, 1)]
    assert rows[1]["exponent_milli"] == 30_000
