import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import scoring
from quayside.llm.recurrent import SPAN, WINDOW, Documents, Network, spans, windows


def words(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute(docs):
    train = Counter()
    for r in docs:
        if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            train.update(words(r["text"]))
    n, v = sum(train.values()), len(train)
    out = []
    for r in docs:
        w = words(r["text"])
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        out.append((r["doc_id"], len(w), sum(train[x] > 0 for x in w), n, base))
    return out


def check(df):
    got = scoring.score_held_out(df).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(brute(df.collect()), key=order)
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=order)
    assert [x[:4] for x in have] == [x[:4] for x in want]
    assert np.allclose([x[4] for x in have], [x[4] for x in want], rtol=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    return got


def test_base(documents):
    got = check(documents)
    assert {r["held_out"] for r in got} == {True, False}


def test_awkward(awkward, no_docs):
    assert len(check(awkward)) == 11
    assert scoring.score_held_out(no_docs).collect() == []
    nothing = scoring.score_documents(awkward, F.lit(False)).collect()
    assert {r["train_tokens"] for r in nothing} == {0} and {r["n_known"] for r in nothing} == {0}


@pytest.mark.parametrize("partitions", [1, 8])
def test_better_than_counts(spark, sf_dir, partitions):
    """Held-out texts are likelier than by the counts, however the table is partitioned."""
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").repartition(partitions)
    held = [r for r in scoring.score_held_out(docs).collect() if r["held_out"]]
    tokens, base, score = (sum(r[k] for r in held) for k in ("n_tokens", "base_score", "score"))
    assert score > base + 0.1 * tokens
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.8


def trained():
    draw = np.random.default_rng(5)
    net = Network(np.arange(70, 0, -1).astype(float))
    ids = [np.append(draw.integers(1, 70, n), 0).astype(np.int32) for n in (0, 3, 40, 200, 7, 90)]
    net.train(iter(ids), 0.01)
    return net, ids


def test_probabilities_add_up():
    net, _ = trained()
    h = np.random.default_rng(0).uniform(-1, 1, (1, net.p["u"].shape[0])).astype(np.float32)
    log = net._words_of(np.repeat(h, 70, axis=0), np.arange(70), None)[0]
    assert abs(np.exp(log).sum() - 1) < 1e-5
    assert net.starts[:3].tolist() == [0, 1, 2] and net.starts[-1] == 70 and (np.diff(net.starts) > 0).all()


def test_state_is_carried():
    """Scores of lanes side by side in windows equal those of each document word by word."""
    net, ids = trained()
    got = net.score(Documents(ids))
    for mine, logs in zip(ids, got, strict=True):
        h, before, want = np.zeros((1, net.p["u"].shape[0]), np.float32), 0, []
        for word in mine:
            h = net._run(net.p["embed"] @ net.p["w"] + net.p["b"], np.array([[before]]), h)[-1].copy()
            want.append(net._words_of(h, np.array([word]), None)[0][0])
            before = word
        assert np.allclose(logs, want, atol=1e-4)
    assert max(map(len, ids)) > 2 * WINDOW


def test_replicas_add_up():
    net, _ = trained()
    other = Network(np.arange(70, 0, -1).astype(float))
    other.load(net.state())
    assert all((other.p[k] == net.p[k]).all() and (other.squares[k] == net.squares[k]).all() for k in net.p)


@pytest.mark.parametrize("lanes", [1, 2, 4, 100])
def test_every_token_is_learned_from(lanes):
    """Lanes are refilled: each document is there once, whole, after the end of the one before it."""
    draw = np.random.default_rng(3)
    ids = [np.append(draw.integers(1, 70, n), 0).astype(np.int32) for n in (0, 3, 5, 20, 31, 40, 70, 95, 200, 0, 1)]
    seen, running, sizes = [], [], []
    for before, target, there, fresh, going in windows(((x, 0) for x in ids), lanes, 32):
        running = [[] for _ in range(before.shape[1])] if going is None else [running[j] for j in going.tolist()]
        assert before.shape[1] == len(running) <= lanes
        sizes.append(int(there.sum()))
        for j, mine in enumerate(running):
            for t in range(32):
                if not there[t, j]:
                    assert not there[t:, j].any()
                    break
                if fresh[t, j]:
                    assert before[t, j] == 0
                    mine.append([])
                    seen.append(mine[-1])
                else:
                    assert before[t, j] == mine[-1][-1]
                mine[-1].append(int(target[t, j]))
    assert sorted(seen) == sorted(x.tolist() for x in ids)
    if lanes == 2:
        assert sizes == sorted(sizes, reverse=True)
    assert Network(np.arange(70, 0, -1).astype(float)).train(iter(ids), 0.01, lanes) == sum(map(len, ids))


def test_spans():
    """Spans of a long document teach each token once, after the state of the window before."""
    ids = np.arange(100, dtype=np.int32)
    cut = list(spans(iter([ids, ids[:5], ids[:40], ids[:41]]), 40, 8))
    assert [(x[0], x[-1], skip) for x, skip in cut] == [(0, 39, 0), (32, 79, 8), (72, 99, 8), (0, 4, 0), (0, 39, 0), (0, 39, 0), (32, 40, 8)]
    assert np.concatenate([x[skip:] for x, skip in cut[:3]]).tolist() == ids.tolist()
    learned = [target[there].tolist() for _, target, there, _, _ in windows(iter(cut), 3, 16)]
    assert sorted(sum(learned, [])) == sorted(np.concatenate([ids, ids[:5], ids[:40], ids[:41]]).tolist())
    long = [np.append(np.random.default_rng(2).integers(1, 70, 3 * SPAN + 7), 0).astype(np.int32)]
    assert Network(np.arange(70, 0, -1).astype(float)).train(iter(long), 0.01) == 3 * SPAN + 8


def test_gradients():
    """Against differences of the likelihood, with documents that begin within a window."""
    net = Network(np.r_[5.0, 40, np.arange(30, 0, -1)])
    net.p = {k: (v.astype(np.float64) + (0.3 * np.random.default_rng(1).standard_normal(v.shape) if k != "ob" else 0)).astype(np.float32) for k, v in net.p.items()}
    draw = np.random.default_rng(8)
    ids = [np.append(draw.integers(1, 32, n), 0).astype(np.int32) for n in (3, 0, 9, 6, 30)]
    before, target, there, fresh, _ = next(windows(((x, 0) for x in ids), 2, 16))
    h = np.zeros((2, net.p["u"].shape[0]), np.float32)
    _, grads = net._gradients(before, target, there, fresh, h)
    grads = {k: v.copy() for k, v in grads.items()}

    def loss():
        states = net._run(net.p["embed"] @ net.p["w"] + net.p["b"], before, h, None, fresh).copy()
        return -net._words_of(states[there], target[there], None)[0].sum()

    for k in net.p:
        at = np.unravel_index(np.abs(grads[k]).argmax(), grads[k].shape)
        old, step = net.p[k][at], np.float32(1e-2)
        values = []
        for sign in (1, -1):
            net.p[k][at] = old + sign * step
            values.append(loss())
        net.p[k][at] = old
        assert abs((values[0] - values[1]) / (2 * step) - grads[k][at]) < 0.02 * abs(grads[k][at]) + 0.01, k


def test_vocabulary_grows(spark):
    """All words above a count that follows from N are known, in about as many classes as a class has words."""
    texts = [" ".join(f"w{i}" for i in range(1500) for _ in range(3)) + f" once{k}" for k in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = scoring.word_counts(scoring._blocks(docs, F.lit(True)))
    known, net, total, distinct, frequent = scoring._network(counts)
    assert total == 9004 and distinct == 1503 and frequent == 9002
    assert scoring.least_count(total) == 6 and len(known) == 1501 and net.words == 1502
    assert 0.15 < net.classes / math.sqrt(net.words) < 1.5 and net.class_of.shape == (net.words,)
    assert scoring.least_count(10**10) == 6250 and scoring.least_count(0) == 2


def test_words(spark):
    """Every byte as a separator or not, empty texts, nulls and bytes that are no UTF-8, in any slices of the texts."""
    odd = [None, "", " ", "  a  B ", "a\x1cb\x1dc\x85d\xa0E", "\x00 A\x00", "".join(map(chr, range(256))), "\n\n", "ÀÉ x É", "q"]
    want = [words(t) for t in odd]
    for texts in (pa.array(odd), pa.array(odd, pa.large_string()), pa.array(["z", *odd]).slice(1), pa.chunked_array([odd[:3], odd[3:]])):
        for size in (1, 20, scoring.SPLIT_BYTES):
            with pytest.MonkeyPatch.context() as m:
                m.setattr(scoring, "SPLIT_BYTES", size)
                names, codes, sizes = scoring._encoded(texts)
            names = names.to_pylist()
            assert len(set(names)) == len(names) and names[0] == b"\n"
            assert [[names[i] for i in x] for x in np.split(codes, np.cumsum(sizes)[:-1])] == want
    assert [len(x) for x in scoring._encoded(pa.chunked_array([], pa.string()))] == [1, 0, 0]
    raw = spark.sql("SELECT 0L doc_id, CAST(unhex('ff41203fFF') AS STRING) text UNION ALL SELECT 1L, 'a b'")
    got = {r["doc_id"]: (r["n_tokens"], r["n_known"]) for r in scoring.score_documents(raw, F.lit(True)).collect()}
    assert got == {0: (3, 3), 1: (3, 3)}


def test_buckets(monkeypatch):
    """The order of words by bucket does not depend on how they are given, with hashes that clash too."""
    found = [b"\n", *(b"w%d" % i for i in range(500))]
    other = found[::-1]
    for clash in (False, True):
        if clash:
            monkeypatch.setattr(scoring, "numbers", lambda x: np.array([len(w) << 60 for w in x], np.uint64))
        joined = []
        for mine in (found, other):
            mine = pa.array(mine, pa.large_binary())
            order, edges = scoring._bucketed(mine, 13)
            assert sorted(order.tolist()) == list(range(501)) and len(edges) == 14
            joined.append(scoring._joined(mine, order, edges))
        assert joined[0] == joined[1]
        assert sorted(w for x in joined[0] if x for w in x.split(b" ")) == sorted(found)


def test_blocks_in_parts(spark, documents, monkeypatch):
    """Blocks that lie in several batches and pieces have the counts of whole ones."""
    monkeypatch.setattr(scoring, "SPLIT_BYTES", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        check(documents)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_steps_reuse_memory():
    """A step's arrays of the size of its window are used again; fresh ones took as long as what was computed into them."""
    draw = np.random.default_rng(4)
    net = Network(np.arange(2000, 0, -1).astype(float))
    tokens, there = draw.integers(0, 2000, (WINDOW, 512)).astype(np.int32), np.ones((WINDOW, 512), bool)
    h, fresh = np.zeros((512, net.p["u"].shape[0]), np.float32), np.zeros((WINDOW, 512), bool)
    net._gradients(tokens, tokens, there, fresh, h)
    tracemalloc.start()
    net._gradients(tokens, tokens, there, fresh, h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * there.size * h.shape[1] * 4
