"""Token ids, counts and packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quayside.llm import packing, token_counts
from quayside.llm.queries import op2_token_counts
from quayside.llm.tokens import WordBytes
from quayside.session import work_dir


def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def ids_of(t, text):
    return t.encode(text or "", add_special_tokens=False).ids


def test_ids(documents):
    t, words = tokenizer(), WordBytes()
    odd = ["a  b", "a \n b", "", " x", "x ", "  ", "<|endoftext|> hi", "it's 12 3² \x1c  y　 z", "é \U0001f600 q", "a" * 500]
    for text in odd + [r["text"] for r in documents.limit(60).collect()]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids_of(t, text)


def check_packing(docs, packed, room):
    t = tokenizer()
    want = Counter()
    for r in docs.collect():
        ids = ids_of(t, r["text"]) + [0]
        want[(r["doc_id"], np.array(ids, "<u4").tobytes())] += 1
    rows = packed.collect()
    by_doc = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    for (doc_id, size), parts in by_doc.items():
        wholes = [k for k, n in want.items() if k[0] == doc_id and len(k[1]) == 4 * size for _ in range(n)]
        assert sum(p["length"] for p in parts) == size * len(wholes)
        for whole in set(wholes):
            for p in parts:
                assert any(w[1][4 * p["start"] :][: 4 * p["length"]] == p["ids"] for w in wholes)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
        padding += 0 if at & (at - 1) == 0 else room - at
    return padding, sum(r["length"] for r in rows)


def test_pack(documents):
    padding, total = check_packing(documents, packing.pack(documents), packing.SEQUENCE_TOKENS)
    assert padding <= 0.02 * total


def test_groups(documents):
    padding, total = check_packing(documents, packing.pack(documents, group_pieces=50), packing.SEQUENCE_TOKENS)
    assert padding <= 0.1 * total


def test_pack_awkward(awkward, no_docs):
    check_packing(awkward, packing.pack(awkward), packing.SEQUENCE_TOKENS)
    rows = packing.pack(awkward, ids=False).collect()
    assert sum(r["start"] == 0 for r in rows) == 11
    assert packing.pack(no_docs).collect() == []


def test_first_fit_decreasing():
    draw = np.random.default_rng(3)
    for size in (1, 2, 17, 300):
        lengths = draw.integers(1, 101, size)
        bins, at = packing.first_fit_decreasing(lengths, 100)
        left: list[int] = []
        for i in np.argsort(-lengths, kind="stable"):
            fit = next((b for b, room in enumerate(left) if room >= lengths[i]), len(left))
            if fit == len(left):
                left.append(100)
            assert bins[i] == fit and at[i] == 100 - left[fit]
            left[fit] -= lengths[i]


def totals(rows):
    out = defaultdict(lambda: [0, 0])
    for source, lang, name, n in rows:
        out[source, lang, name][0] += 1
        out[source, lang, name][1] += n
    return {k: tuple(v) for k, v in out.items()}


def test_counts(spark, sf_dir, documents):
    t, want = tokenizer(), []
    for r in documents.collect():
        if r["doc_id"] % 50 == 7:
            continue
        text, lang = (r["text"] + "\n" + r["text"], "rev") if r["doc_id"] % 50 == 11 else (r["text"], r["lang"])
        want += [(r["source"], lang, "byte_bpe_50k/1", len(ids_of(t, text))), (r["source"], lang, "words/1", len(text.encode().split()))]
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in op2_token_counts(spark, sf_dir).collect()}
    assert got == totals(want)


def test_commits(spark, awkward, no_docs):
    path = work_dir(spark, "rollup")
    assert token_counts.rollup(spark, path).collect() == []
    counted = token_counts.count_tokens(awkward, {"words": None})
    assert token_counts.commit(spark, path, "a", token_counts.signed(counted, 1))
    assert not token_counts.commit(spark, path, "a", token_counts.signed(counted, 1))
    assert token_counts.commit(spark, path, "empty", token_counts.signed(token_counts.count_tokens(no_docs), 1))
    got = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in token_counts.rollup(spark, path).collect()}
    assert got[(None, None)] == (2, 0) and got[("b", "de")] == (2, 16) and got[(None, "en")] == (1, 40_000)
    # A batch that failed before its marker is not read, and is written anew.
    broken = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=a/_SUCCESS")
    broken.getFileSystem(spark._jsc.hadoopConfiguration()).delete(broken, False)
    assert token_counts.rollup(spark, path).collect() == []
    assert token_counts.commit(spark, path, "a", token_counts.signed(counted, 1))
    assert token_counts.commit(spark, path, "gone", token_counts.signed(counted, -1))
    assert token_counts.rollup(spark, path).collect() == []


def test_folding_at_any_moment_changes_no_total(spark):
    """Random batches, folds between them, once or twice, and folds that fail or overlap, against plain sums."""
    draw = random.Random(5)
    path, want = work_dir(spark, "rollup"), defaultdict(lambda: [0, 0])

    def state():
        return {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in token_counts.rollup(spark, path).collect()}

    assert not token_counts.fold(spark, path)
    for n in range(8):
        rows = []
        for _ in range(draw.randrange(1, 6)):
            key = (draw.choice(["a", "b", None]), draw.choice(["en", None]), "words")
            rows.append((*key, draw.choice([1, -1]), draw.randrange(-9, 10)))
            want[key][0] += rows[-1][3]
            want[key][1] += rows[-1][4]
        changes = spark.createDataFrame(rows, token_counts.SCHEMA)
        assert token_counts.commit(spark, path, str(n), changes)
        if n % 3 == 1:
            before = {k: v for k, v in want.items() if v != [0, 0]}
            assert state() == before
            assert token_counts.fold(spark, path) and not token_counts.fold(spark, path)
            assert not token_counts.commit(spark, path, str(n), changes)
        assert state() == {k: v for k, v in want.items() if v != [0, 0]}
    # Only the newest totals and the batches since are read.
    _, totals, held = token_counts._totals(spark, path)
    read = {f.split("/")[-2] for f in token_counts.rollup(spark, path).inputFiles()}
    assert held == {f"batch={n}" for n in range(8)} and read == {"sums"}
    # A fold that got no further than its sums does not count.
    totals.unionByName(totals).write.parquet(f"{path}/totals/000000000099-unfinished/sums")
    assert state() == {k: v for k, v in want.items() if v != [0, 0]}
    # Two folds from the same totals, of which the one that counts lacks the last batch.
    token_counts.commit(spark, path, "late", spark.createDataFrame([("z", "en", "words", 1, 4)], token_counts.SCHEMA))
    want["z", "en", "words"] = [1, 4]
    assert token_counts.fold(spark, path)
    number = token_counts._totals(spark, path)[0]
    totals.write.parquet(f"{path}/totals/{number:012d}-zzzzzzzz/sums")
    spark.createDataFrame([(b,) for b in held], "batch string").write.parquet(f"{path}/totals/{number:012d}-zzzzzzzz/batches")
    assert token_counts._totals(spark, path)[2] == held
    assert state() == {k: v for k, v in want.items() if v != [0, 0]}
