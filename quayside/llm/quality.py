"""Quality scores from compression: texts shrink more with a dictionary of their own kind."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import slices, stage
from quayside.llm.language import remainder

#: Bounds of what the classifier is fitted on: labelled documents of the dictionaries (of each label)
#: and of the calibration, chosen by a hash of doc_id; every document is scored.
DICTIONARY_ROWS = 4096
CALIBRATION_ROWS = 16_384
#: Of a document so many pieces at most, and of each label so many in all, go into a dictionary.
DOCUMENT_PIECES = 32
DICTIONARY_PIECES = 8192
DICTIONARY_BYTES = 112 << 10
#: A text is compressed in pieces of so many bytes, so that all of it meets the dictionary.
PIECE_BYTES = 1024
LEVEL = 6
#: Pull of the calibration's slope and offset towards 0, in documents.
PULL = 1e-3


def pieces_of(text: str | None) -> list[bytes]:
    """The text's UTF-8 bytes, cut every PIECE_BYTES; null and empty texts have none."""
    whole = (text or "").encode("utf-8", "surrogatepass")
    return [whole[at : at + PIECE_BYTES] for at in range(0, len(whole), PIECE_BYTES)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary of the samples; too few of them are themselves its content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


@dataclass
class Classifier:
    """Dictionaries of good and bad text, and the logistic curve over the difference of sizes."""

    good: bytes
    bad: bytes
    slope: float = 0.0
    offset: float = 0.0

    def __getstate__(self) -> dict:
        return {"good": self.good, "bad": self.bad, "slope": self.slope, "offset": self.offset}

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        kind = zstandard.DICT_TYPE_AUTO if content else zstandard.DICT_TYPE_RAWCONTENT
        made = zstandard.ZstdCompressionDict(content, dict_type=kind)
        if content:
            made.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=made, compression_params=params)

    @cached_property
    def _pair(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return self._compressor(self.good), self._compressor(self.bad)

    def difference(self, text: str | None) -> float:
        """How much smaller the whole text gets with the good dictionary, from -1 to 1; 0 if empty."""
        good, bad = self._pair
        g = b = 0
        for piece in pieces_of(text):
            g += len(good.compress(piece))
            b += len(bad.compress(piece))
        return (b - g) / (b + g) if b + g else 0.0

    def score(self, difference: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * difference + self.offset))))


def calibrate(differences: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve with the greatest likelihood, by Newton's method."""
    # Differences are a few hundredths, so they are measured in their own spread.
    spread = float(np.sqrt((differences**2).mean())) or 1.0
    x = np.column_stack([differences / spread, np.ones(len(differences))])
    weights = np.zeros(2)
    value = lambda w: float(np.logaddexp(0, -(2 * labels - 1) * (x @ w)).sum() + PULL * (w @ w) / 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700)))
        slope = x.T @ (p - labels) + PULL * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + PULL * np.eye(2)
        step, size, now = np.linalg.solve(curve, slope), 1.0, value(weights)
        while size > 1e-6 and value(weights - size * step) > now:
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(weights[0]) / spread, float(weights[1])


def _fold(salt: str) -> Column:
    return F.xxhash64(F.lit(salt), F.col("doc_id"))


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, label) of the rows for the dictionaries and for the calibration.

    The rows are chosen among the labels, so the texts meet a list of bounded size.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter(learn & F.col("label").isin(0, 1)).groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
    known = stage(known.select("doc_id", "label", (F.pmod(_fold("half"), F.lit(2)) == 0).alias("first")), "labels")
    pick = lambda rows, n: rows.orderBy(_fold("pick"), "doc_id").limit(n)
    ours = known.filter("first")
    one = pick(ours.filter("label = 1"), DICTIONARY_ROWS).union(pick(ours.filter("label = 0"), DICTIONARY_ROWS))
    two = pick(known.filter("NOT first"), CALIBRATION_ROWS)
    # A text without a doc_id has no label.
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = lambda rows: plain.join(F.broadcast(rows.select("doc_id", "label")), "doc_id")
    return joined(one), joined(two)


def _samples(rows: DataFrame) -> dict[int, list[bytes]]:
    """Pieces of text of each label: of a document a few, chosen by their hash, so that none prevails."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            labels, found, order = [], [], []
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                hashed = sorted((xxhash.xxh3_64_intdigest(x, seed=i) >> 1, x) for i, x in enumerate(pieces_of(text)))
                for number, piece in hashed[:DOCUMENT_PIECES]:
                    labels.append(label)
                    found.append(piece)
                    order.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), pa.array(found, pa.binary()), pa.array(order, pa.int64())], ["label", "piece", "n"]
            )

    cut_up = stage(rows.select("text", "label").mapInArrow(cut, "label int, piece binary, n long"), "pieces")
    take = lambda label: cut_up.filter(F.col("label") == label).orderBy("n", "piece").limit(DICTIONARY_PIECES)
    return {label: [bytes(r["piece"]) for r in take(label).select("piece").collect()] for label in (0, 1)}


def _differences(rows: DataFrame, model: Classifier, columns: list[str]) -> DataFrame:
    """`columns` of the rows with the normalised difference of the sizes of their texts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = shared.value
        for batch in slices(batches):
            found = [ours.difference(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(found, pa.float64())], [*columns, "difference"])

    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(*columns, "text").mapInArrow(measure, f"{fields}, difference double")


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Classifier:
    """Dictionaries from one half of the labelled rows that `learn` (over doc_id) allows, the curve from the other.

    What is fitted on is bounded by the parameters above. A doc_id with both labels has none.
    Without texts of both labels all scores are the share of label 1 (0.5 without any label).
    """
    first, second = _labelled(docs, labels, learn)
    samples = _samples(first)
    # Dictionaries of like size, or the label with more text would seem closer to everything.
    least = min(map(len, samples.values()))
    model = Classifier(build_dictionary(samples[1][:least]), build_dictionary(samples[0][:least]))
    if not least:
        model = Classifier(b"", b"")
    seen = _differences(second, model, ["label"]).collect()
    if seen:
        x, y = np.array([r["difference"] for r in seen]), np.array([r["label"] for r in seen], np.float64)
        model.slope, model.offset = calibrate(x, y)
    return model


def score_quality(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, difference, score (0 to 1) and predicted (1 if score >= 0.5) of each row of `docs`.

    Whole texts are compressed, in pieces, once with each dictionary; difference is
    (bad - good) / (bad + good) of the sizes and score its place on the calibrated curve. Null and
    empty texts have the difference 0. Each row gives one row, also repeated ones and those without
    a doc_id; no rows give none. Other columns are ignored.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    curve = F.lit(model.slope) * F.col("difference") + F.lit(model.offset)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), curve))))
    scored = _differences(plain, model, ["doc_id"]).withColumn("score", score)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels of documents whose remainder modulo 3 is not 1 and scores all documents."""
    model = train(docs, labels, remainder(3) != 1)
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    return score_quality(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "difference")
