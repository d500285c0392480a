import random

import numpy as np
import pytest

from quayside.llm import near_duplicates as nd
from quayside.llm.common import components


def shingles(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(root(i)) if doc_id is not None else None
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in nd.near_duplicates(df).collect()), key=repr)


def families(seed, count, words, copies):
    """Chains and stars of copies with a few words changed each."""
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
        family = [base]
        for _ in range(copies):
            text = list(draw.choice(family))
            for _ in range(draw.choice([0, 1, 1, 2, 3, 4])):
                text[draw.randrange(words)] = f"w{draw.randrange(10**6)}"
            family.append(text)
        rows += [" ".join(t).upper() if draw.random() < 0.3 else "  ".join(t) for t in family]
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_families(spark):
    rows = families(1, 12, 150, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)


def test_hot_bucket(spark, monkeypatch):
    """One large group, tested with the search for shared shingles switched on."""
    monkeypatch.setattr(nd, "UNTESTED_PAIRS", 10)
    monkeypatch.setattr(nd, "BROADCAST_ROWS", 5)
    rows = families(2, 1, 140, 250)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert found(documents) == brute(rows)


def test_awkward(spark, awkward, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    assert found(no_docs) == []
    kept = nd.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([0, 1, 2, 3, 4, 5, 6, 7, None, None], key=repr)


@pytest.mark.parametrize("sieve", [nd.SIEVE, 3])
def test_keep_one(spark, sf_dir, awkward, monkeypatch, sieve):
    """The kept rows of brute force, unchanged; also if most ids share a hash value with dropped ones."""
    monkeypatch.setattr(nd, "SIEVE", sieve)
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), awkward):
        rows = [tuple(r) for r in docs.collect()]
        kept = {(x[0]) for x in brute([(r[0], r[1]) for r in rows]) if x[3]}
        want = sorted({r for r in rows if r[0] in kept and r[0] is not None} | {r for r in rows if r[0] is None}, key=repr)
        assert sorted((tuple(r) for r in nd.keep_one(docs).collect()), key=repr) == want


def test_odd_sketch():
    draw = np.random.default_rng(9)
    for share, spread in ((1.0, 0), (0.9, 0.1), (0.5, 0.25)):
        a = draw.integers(0, 2**63, 4000, dtype=np.uint64)
        b = np.r_[a[: int(4000 * share)], draw.integers(0, 2**63, 4000 - int(4000 * share), dtype=np.uint64)]
        want = int(4000 * share) / (8000 - int(4000 * share))
        bits = sum(int(x).bit_count() for x in (nd.odd_sketch(nd.min_hash(a)) ^ nd.odd_sketch(nd.min_hash(b))).view(np.uint64))
        if share == 1.0:
            assert bits == 0
        differ = -nd.SKETCH_BITS / 4 * np.log(max(1e-9, 1 - 2 * bits / nd.SKETCH_BITS))
        assert abs(1 - differ / nd.SAMPLES - want) <= spread
    assert 60 < nd.most_different_bits() < 150


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 7), (50, 50)]
    edges = spark.createDataFrame(chain, "u long, v long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {3: 3, 7: 3, 9: 3, 50: 50}
    assert components(edges.limit(0)).collect() == []
