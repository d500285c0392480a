"""The stages against plain versions of what they decide."""

import numpy as np
import pytest

import corpus_pipeline
from quayside.llm import decontaminate, language
from quayside.llm.common import stage
from tests.llm.test_near_duplicates import brute
from tests.llm.test_pii import base
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES[:-1]:
        out.append((docs, stage(function(spark, docs, sf_dir), name)))
        assert out[-1][1].columns == docs.columns
        docs = out[-1][1]
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "benchmark_decontamination", "pii_redaction", "token_packing",
    ]


def test_language(kept, spark):
    before, after = kept[0]
    found = by_id(language.identify_held_out(before))
    assert after.count() <= before.count()
    assert set(by_id(after)) == {i for i, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.35}
    junk = spark.createDataFrame([(10**6, "12 34 !!", "en", "a", 8)], before.schema)
    assert 10**6 not in by_id(corpus_pipeline.language_id(spark, before.union(junk), ""))


def test_near(kept):
    before, after = kept[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert set(by_id(after)) == {x[0] for x in brute(rows) if x[3]} and len(by_id(after)) < len(rows)


def test_benchmark(kept, spark, sf_dir):
    before, after = kept[2]
    items = [dc.split() for dc in (" ".join(x.decode() for x in decontaminate.tokens(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())]
    gone = set(by_id(before)) - set(by_id(after))
    for i, r in by_id(before).items():
        text = " " + " ".join(x.decode() for x in decontaminate.tokens(r["text"])) + " "
        if any(f" {' '.join(item)} " in text for item in items):
            assert i in gone
    words = {i: set(decontaminate.tokens(r["text"])) for i, r in by_id(before).items()}
    for i in gone:
        assert any(np.mean([w.encode() in words[i] for w in item]) >= 0.6 for item in items)


def test_pii(kept):
    before, after = kept[3]
    old, new = by_id(before), by_id(after)
    assert set(old) == set(new)
    for i, r in old.items():
        if base(r["text"]):
            assert new[i]["text"] != r["text"] and not base(new[i]["text"]) and new[i]["n_chars"] == len(new[i]["text"])


def test_packing(kept, spark, sf_dir):
    docs = kept[3][1]
    padding, total = check_packing(docs, corpus_pipeline.token_packing(spark, docs, sf_dir), 1024)
    assert padding <= 0.03 * total


def test_run(kept, spark, sf_dir):
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()}
    assert ids == set(by_id(kept[3][1]))


def test_awkward(awkward, spark, sf_dir):
    docs = awkward
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = out
    assert {r["doc_id"] for r in corpus_pipeline.token_packing(spark, docs, sf_dir).collect()} == {0, 4, 5, 7, None}
