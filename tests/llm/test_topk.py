import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import topk


def brute(ids, rows, query_id, query, k):
    scored = sorted((-int(np.dot(r.astype(object), query.astype(object))), int(i)) for i, r in zip(ids, rows, strict=True) if i != query_id)
    return [(-s, i) for s, i in scored[:k]]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(1, 4), st.integers(1, 12), st.integers(0, 10**6))
def test_threshold_algorithm(n, width, k, seed):
    draw = np.random.default_rng(seed)
    rows, query = draw.integers(-3, 4, (n, width)), draw.integers(-3, 4, width)
    ids = draw.permutation(n)
    lists = topk.SortedLists(ids, rows.astype(float))
    assert [(int(s), i) for s, i in lists.search(0, query.astype(float), k)] == brute(ids, rows, 0, query, k)


def test_stops_early():
    """With one long list of falling values the search reads a small part of the rows."""
    rows = np.zeros((6400, 2))
    rows[:, 0] = np.arange(6400)
    lists = topk.SortedLists(np.arange(6400), rows)
    lists.order = lists.order.copy()
    lists.order[: 6400 - 200, 0] = -10**9  # reading on would fail
    assert [i for _, i in lists.search(-1, np.array([1.0, 0.0]), 5)] == [6399, 6398, 6397, 6396, 6395]


def test_awkward(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    big = 1e15
    rows = [
        (0, [1.0, 0.5], "x"), (1, [0.25, 0.25], "x"), (2, [0.25, 0.25], "x"), (2, [0.25, 0.25], "x"), (3, [-1.0, 2.0], "x"),
        (4, None, "x"), (5, [None, 1.0], "x"), (6, [math.nan, 1.0], "x"), (7, [math.inf, 1.0], "x"), (8, [1.0], "x"),
        (9, [], "x"), (None, [1.0, 1.0], "x"), (100, [0.0, 0.0], "x"), (200, [big, 1.0], "x"), (300, [], "x"), (400, None, "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 3).collect()
    plain = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, qv in plain:
        if q % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in plain if i != q and len(v) == len(qv))
        want += [(q, rank, i, min(-s, 2**63 - 1)) for rank, (s, i) in enumerate(scored[:3], 1)]
    assert sorted(tuple(r) for r in got if r["query_id"] != 200) == sorted(w for w in want if w[0] != 200)
    none = vectors.limit(0)
    assert topk.top_k(none, none).collect() == [] and topk.top_k(vectors, none).collect() == []
