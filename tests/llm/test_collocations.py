import re
from collections import Counter

import pytest

from quayside.llm import collocations
from quayside.llm.common import table


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n-\r]", low)]


def brute(rows, least, top):
    found = {}
    for lang in {r[0] or "und" for r in rows}:
        f, n = Counter(), 0
        for words in (p for l, t in rows if (l or "und") == lang for p in pieces(t)):
            n += len(words)
            f.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        listed = []
        for p in candidates:
            a = f[p]
            if any(len(q) > len(p) and 100 * f[q] >= 50 * a and p in (q[:2], q[1:]) for q in candidates):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            listed.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        for rank, (s, a, p, l, r, n) in enumerate(sorted(listed)[:top], 1):
            found[lang, rank] = (p.decode(), -a, l, r, n, -s)
    return found


def run(docs, least, top=2000):
    rows = collocations.collocations(docs, least, top).collect()
    assert len({(r["lang"], r["rank"]) for r in rows}) == len(rows)
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows}


@pytest.mark.parametrize("hot", [1 / 2000, 0.0])
def test_brute_force(spark, sf_dir, monkeypatch, hot):
    """With a share of 0 each pair of words that is there twice is dealt out over salts."""
    monkeypatch.setattr(collocations, "HOT_SHARE", hot)
    docs = table(spark, sf_dir, "documents")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    want = brute(rows, 4, 50)
    assert len(want) > 100 and run(docs, 4, 50) == want


def test_small_cases(spark):
    texts = [
        ("en", "The  Big\tcat sat. the big, cat; THE BIG cat"),
        ("en", "the big cat the big cat"),
        (None, "été à été à été à"),
        ("und", "a b:a b!a b?a b\x0ba b\ra b \x1c\xa0x"),
        ("de", None),
        ("fr", ""),
        ("es", " ., \n"),
        ("en", "the big cat the big cat"),
    ]
    docs = spark.createDataFrame([(i, t, l, 0, 0, 0) for i, (l, t) in enumerate(texts)], "doc_id long, text string, lang string, n int, f int, salt int")
    for least in (1, 2, 3):
        assert run(docs, least) == brute(texts, least, 2000)


def test_awkward(awkward, no_docs):
    rows = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert run(awkward, 2) == brute(rows, 2, 2000)
    assert run(no_docs, 1) == {}


def test_blocks(monkeypatch):
    """Windows do not depend on where blocks are cut, nor on the parts of a long text."""
    text = " ".join(f"w{i * i % 7}{'.' if i % 5 == 0 else ''}" for i in range(500)) + " é" * 20

    def counted(hot=None):
        block, total = collocations._Block(), Counter()
        block.add("x", text.encode())
        block.add("x", b"one")
        for batch in block.rows(hot or {}):
            for r in batch.to_pylist():
                words = tuple(r["window"].split(b" "))
                total[words] += r["n"]
                assert (r["salt"] > 0) == (words[:2] in (hot or {}).get("x", ()))
        return total

    whole = counted()
    want = Counter()
    for words in [*pieces(text), ["one"]]:
        padded = [w.encode() for w in words] + [b"", b""]
        want.update(tuple(padded[i : i + 3]) for i in range(len(words)))
    assert whole == want
    hot = {"x": {(b"w1", b"w4"), (b"w1", b"nowhere"), (b"w2", b"")}, "y": {(b"w4", b"w1")}}
    assert counted(hot) == want
    monkeypatch.setattr(collocations, "NUMBERED_WORDS", 6)
    monkeypatch.setattr(collocations, "PART_BYTES", 16)
    assert counted() == counted(hot) == want


def test_exact_scores(spark):
    """Products beyond 64 bits, and quotients that doubles would round up."""
    a = 3_037_000_500
    rows = spark.createDataFrame([(a, a + 1, a + 2), (10**14 - 1, 10**14, 10**14 + 3), (10, 10, 10)], "a long, x long, y long")
    got = [r[0] for r in rows.select(collocations._score("a", "x", "y")).collect()]
    assert got == [1_000_000 * r["a"] ** 2 // (r["x"] * r["y"]) for r in rows.collect()]
