import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import decontaminate as dc


def naive_tiles(doc, item, least):
    """Greedy string tiling as it is usually written."""
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best, found = least, []
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and free_d[i + k] and free_i[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j, k)]
                elif k == best:
                    found.append((i, j, k))
        marked = False
        for i, j, k in found:
            if all(free_d[i : i + k]) and all(free_i[j : j + k]):
                free_d[i : i + k] = free_i[j : j + k] = [False] * k
                tiles.append((i, j, k))
                marked = True
        if not marked:
            return tiles


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=25), st.integers(1, 5))
def test_tiling(doc, item, least):
    got = dc.tile(np.array(doc, np.uint64), np.array(item, np.uint64), least)
    assert got == naive_tiles(doc, item, least)


def test_search_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in dc.overlaps(docs, bench).collect()}
    items = [(r["item_id"], dc.numbers(dc.tokens(r["text"]))) for r in bench.collect()]
    want = {}
    for r in docs.collect():
        words = dc.numbers(dc.tokens(r["text"]))
        for item_id, item in items:
            if len(np.intersect1d(words, item)) < dc.COVERAGE * len(np.unique(item)) / 2:
                continue  # tiles cannot cover words that are not there
            covered = sum(t[2] for t in dc.tile(words, item))
            if covered >= dc.COVERAGE * len(item):
                want[r["doc_id"], item_id] = covered
    assert got == want and got


def test_reordered_and_clean(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    items = [[word() for _ in range(40)] for _ in range(5)]
    rest = lambda n: [word() for _ in range(n)]
    shuffled = items[0][20:] + rest(30) + items[0][10:20] + rest(9) + items[0][:10]
    loud = [w.upper() + "!!" for w in items[1]]
    half = items[2][:20]
    broken = [w for i, w in enumerate(items[3]) if i % 3]
    docs = [(1, rest(50) + shuffled), (2, loud + rest(20)), (3, rest(40) + half), (4, broken), (5, rest(500)), (6, items[4][:7])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]): r for r in dc.overlaps(docs, bench).collect()}
    assert set(rows) == {(1, 0), (2, 1)}
    assert rows[1, 0]["n_tiles"] == 3 and rows[1, 0]["coverage"] == 1.0
    assert sorted(r["doc_id"] for r in dc.clean(docs, bench).collect()) == [3, 4, 5, 6]


def test_awkward(spark, awkward, no_docs, monkeypatch):
    bench = spark.createDataFrame(
        [(1, "der zweimal vorkommt und gleich"), (2, None), (3, ""), (None, "a row without a number"), (4, "plage"), (4, "plage"), (5, "...")],
        "item_id long, text string",
    )
    got = sorted((r["doc_id"], r["item_id"]) for r in dc.overlaps(awkward, bench).collect())
    assert got == [(5, 1), (5, 1), (7, 4), (7, 4)]
    clean = dc.clean(awkward, bench)
    assert clean.columns == awkward.columns and clean.count() == 8
    assert dc.overlaps(no_docs, bench).collect() == [] and dc.overlaps(awkward, bench.limit(0)).collect() == []
    monkeypatch.setattr(dc, "BLOCK_CHARS", 10)
    assert sorted((r["doc_id"], r["item_id"]) for r in dc.overlaps(awkward, bench).collect()) == got


def test_clean_sends_a_text_once(spark):
    """The whole row goes to Python; a second copy of its text would double what a task holds."""
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x y z"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d e")], "item_id long, text string")
    kept = dc.clean(docs, items)
    assert "__text" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
