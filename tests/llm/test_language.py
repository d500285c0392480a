import numpy as np
from pyspark.sql import functions as F

from quayside.llm import language


def test_held_out(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    found = language.identify_held_out(docs)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"]]
    assert 200 <= len(held) <= 300
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    for r in docs.select("doc_id").limit(20).collect():
        import zlib

        want = zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert next(x for x in rows if x["doc_id"] == r["doc_id"])["held_out"] == want


def test_mixture(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = language.train(docs)
    long = {lang: docs.filter((F.col("lang") == lang) & (F.length("text") > 3000)).first()["text"][:3000] for lang in ("de", "es")}
    share = dict(zip(model.languages, model.mixtures([long["de"] + " " + long["es"]])[0], strict=True))
    assert abs(share["de"] - 0.5) < 0.1 and abs(share["es"] - 0.5) < 0.1 and share["en"] == share["fr"] == 0
    alone = model.mixtures([long["de"], long["de"] + " " + long["es"], long["es"], ""])
    assert np.allclose(alone[1], list(share.values()))
    assert alone[0].max() == 1.0 and alone[3].sum() == 0


def test_shares_are_the_likeliest():
    """The proportions reach the likelihood that a fine search over two languages finds."""
    draw = np.random.default_rng(1)
    model = language.Model(["a", "b"], draw.integers(1, 50, (2, language.CELLS)).astype(float))
    text = "".join(chr(97 + i) for i in draw.integers(0, 26, 400))
    cell, _ = language.trigrams([text])
    p = np.exp(model.log[cell].astype(float))
    share = model._fit(p / p.max(axis=1, keepdims=True), np.ones(len(cell), np.float32), np.zeros(len(cell), int), np.ones((1, 2), bool), 500)[0][0]
    grid = np.linspace(0, 1, 2001)
    best = grid[np.argmax([np.log(p @ [s, 1 - s]).sum() for s in grid])]
    assert abs(share[0] - best) < 0.02


def test_awkward(awkward, no_docs):
    rows = language.identify_held_out(awkward).collect()
    assert len(rows) == 11
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3, 6)] == ["und"] * 4
    assert by_id[1]["score"] == 0 and not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert language.identify_held_out(no_docs).collect() == []
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify_held_out(unlabelled).collect()} == {"und"}
