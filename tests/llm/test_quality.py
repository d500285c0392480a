import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import quality

COLUMNS = ["doc_id", "held_out", "score", "predicted"]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out(tables):
    docs, labels = tables
    rows = quality.score_held_out(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    good, bad = ([r["score"] for r in held if r["quality"] == label] for label in (1, 0))
    assert len(good) > 80 and len(bad) > 10
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.95
    assert np.mean(np.array(good)[:, None] > np.array(bad)) >= 0.97
    # Calibrated: the mean score is about the share of label 1.
    assert abs(np.mean(good + bad) - len(good) / (len(good) + len(bad))) < 0.05


def test_labels_of_held_out_documents_are_not_read(tables):
    docs, labels = tables
    kept = quality.remainder(3) != 1
    turned = labels.withColumn("quality", F.when(kept, F.col("quality")).otherwise(1 - F.col("quality")))
    assert sorted(quality.score_held_out(docs, labels).collect()) == sorted(quality.score_held_out(docs, turned).collect())


def test_other_columns_are_not_read(tables):
    docs, labels = tables
    bare = docs.select("doc_id", "text", F.lit("x").alias("lang"), F.lit("y").alias("source"), F.lit(0).alias("difference"))
    extra = labels.withColumn("toxic", F.lit(0)).withColumn("label", F.lit(1)).withColumn("text", F.lit(""))
    assert sorted(quality.score_held_out(docs, labels).collect()) == sorted(quality.score_held_out(bare, extra).collect())


def test_whole_text_counts():
    model = quality.Classifier(quality.build_dictionary([b"aaa bbb " * 40] * 3), quality.build_dictionary([b"xxx$$$ " * 40] * 3), 10.0, 0.0)
    tail = "$$$ ".join(f"q{i}" for i in range(20_000))
    assert model.difference("aaa bbb " * 500) > 0 > model.difference("xxx$$$ " * 500)
    assert model.difference("aaa bbb " * 500 + "xxx$$$ " * 5000) < model.difference("aaa bbb " * 500 + "xxx$$$ " * 100)
    assert b"".join(quality.pieces_of(tail)) == tail.encode()


def test_calibration_has_the_greatest_likelihood():
    draw = np.random.default_rng(1)
    x = draw.normal(0, 0.02, 4000)
    y = (draw.random(4000) < 1 / (1 + np.exp(-(80 * x + 1.5)))).astype(float)
    slope, offset = quality.calibrate(x, y)
    assert abs(slope - 80) < 12 and abs(offset - 1.5) < 0.2
    loss = lambda a, b: np.logaddexp(0, -(2 * y - 1) * (a * x + b)).sum()
    assert all(loss(slope, offset) <= loss(slope + a, offset + b) + 1e-6 for a in (-1, 0, 1) for b in (-0.05, 0, 0.05))
    separated = quality.calibrate(np.array([-0.1, -0.2, 0.1, 0.3]), np.array([0.0, 0, 1, 1]))
    assert all(np.isfinite(separated))


def test_awkward(spark, awkward):
    labels = spark.createDataFrame(
        [(0, 1), (0, 1), (1, 0), (2, 0), (4, 1), (5, 0), (5, 1), (6, None), (7, 7), (None, 1), (99, 0)], "doc_id long, quality int"
    )
    rows = quality.score_held_out(awkward, labels).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert {r["difference"] for r in rows if r["doc_id"] in (1, 2)} == {0.0}
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)


def test_no_rows(spark, no_docs, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score_held_out(no_docs, none).collect() == []
    assert {r["score"] for r in quality.score_held_out(awkward, none).collect()} == {0.5}
    only = spark.createDataFrame([(0, 1), (4, 1), (7, 1)], "doc_id long, quality int")
    assert {r["predicted"] for r in quality.score_held_out(awkward, only).collect()} == {1}
