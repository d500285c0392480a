"""Language proportions of documents by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.llm.common import slices

#: Letter trigrams are counted in so many cells; this bounds the model at any corpus size.
CELLS = 1 << 16
#: Most languages a model may have; more raise an error. With CELLS it bounds what is broadcast.
MAX_LANGUAGES = 256
#: Added to each cell, so that unseen trigrams have a likelihood in every language.
SMOOTHING = 0.5
ITERATIONS = 12
#: Rounds after which a language without LEAST_SHARE is out of the question.
SCREENING = 4
#: Another language is taken in if it gains more than PENALTY * log(trigrams) of log-likelihood.
PENALTY = 4.0
#: A language below this share is not taken in.
LEAST_SHARE = 0.02
#: Characters that are worked on together in a task; a longer document is worked on alone.
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each letter with its two neighbours, and the text that it is from.

    Letters are lower-case; other characters and the ends of a text count as spaces.
    """
    padded = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x27D4EB2F)
    keep = letter[1:-1]
    owner = np.repeat(np.arange(len(padded), dtype=np.uint32), [len(t) for t in padded])
    return (mixed[keep] >> np.uint32(16)), owner[1:-1][keep]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about CHUNK_CHARS, with the number of the first."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text or "") > CHUNK_CHARS:
            yield start, held
            start, held, size = i, [], 0
        held.append(text or "")
        size += len(held[-1])
    if held:
        yield start, held


class Model:
    """Log-likelihoods of the trigram cells in each language."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        smooth = counts + SMOOTHING
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()

    def mixtures(self, texts: list[str]) -> np.ndarray:
        """The share of each language in each text, over the set of languages that is selected.

        A set's likelihood is that of the mixture whose proportions expectation-maximisation
        finds. The search starts from the best single language. Where the mixture of all
        languages has a second one of a least share, the sets of the 2, 3, ... largest of its
        shares are tried, and that with the largest penalised likelihood is selected. Texts
        without a trigram have no share.
        """
        n, m = len(texts), len(self.languages)
        cell, owner = trigrams(texts)
        shares = np.zeros((n, m))
        if not len(cell) or not m:
            return shares
        key = np.sort((owner << np.uint32(16)) | cell)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times = np.diff(np.r_[first, len(key)]).astype(np.float32)
        owner, log = (key[first] >> np.uint32(16)).astype(np.int64), self.log[key[first] & np.uint32(CELLS - 1)]
        totals = np.bincount(owner, times, n)
        single = _sums(log * times[:, None], owner, n)
        best = single.argmax(axis=1)
        shares[np.arange(n), best] = 1.0
        shares[totals == 0] = 0.0
        if m == 1:
            return shares
        score = single.max(axis=1)
        cost = PENALTY * np.log(np.maximum(totals, 2))
        # Likelihoods relative to the row's best stay within range.
        top = log.max(axis=1)
        rel = np.exp(log - top[:, None])
        base = np.bincount(owner, times * top, n)
        # A few rounds over all languages show the texts in which a second one may have a part.
        everything, _ = self._fit(rel, times, owner, np.ones((n, m), bool), SCREENING)
        open_ = (everything >= LEAST_SHARE).sum(axis=1) > 1
        if not open_.any():
            return shares
        number = np.cumsum(open_) - 1
        mine = open_[owner]
        rel, times, owner = rel[mine], times[mine], number[owner[mine]]
        held = np.flatnonzero(open_)
        everything[held], _ = self._fit(rel, times, owner, np.ones((len(held), m), bool))
        rank = np.argsort(np.argsort(-everything[held], axis=1, kind="stable"), axis=1, kind="stable")
        chosen, score = shares[held], score[held]
        for size in range(2, m + 1):
            allowed = (rank < size) & (everything[held] >= LEAST_SHARE)
            fitted, reached = self._fit(rel, times, owner, allowed)
            gain = base[held] + reached - cost[held] * (size - 1)
            better = (gain > score) & (allowed.sum(axis=1) == size)
            chosen[better], score = fitted[better], np.where(better, gain, score)
            if not better.any():
                break
        shares[held] = chosen
        return shares

    @staticmethod
    def _fit(
        rel: np.ndarray, times: np.ndarray, owner: np.ndarray, allowed: np.ndarray, rounds: int = ITERATIONS
    ) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the allowed languages of each text, and the likelihood with them."""
        n = len(allowed)
        share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
        for _ in range(rounds):
            part = rel * share.astype(np.float32)[owner]
            part *= (times / part.sum(axis=1))[:, None]
            share = _sums(part, owner, n)
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-30)
        inner = np.log(np.einsum("ij,ij->i", rel, share.astype(np.float32)[owner]))
        return share, np.bincount(owner, times * inner, n)


def _sums(rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each owner; owners are in order."""
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    out = np.zeros((n, rows.shape[1]))
    out[owner[starts]] = np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
    return out


def train(labelled: DataFrame) -> Model:
    """A model from all rows of `labelled` (text, lang) with a text and a lang.

    Each task adds up the trigrams of its rows; per language and cell one row leaves it, and the
    sums have at most languages * CELLS rows.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs = batch["lang"].to_pylist()
            for start, texts in _chunks(batch["text"].to_pylist()):
                cell, owner = trigrams(texts)
                names, which = np.unique(langs[start : start + len(texts)], return_inverse=True)
                found = np.bincount(which[owner] * CELLS + cell.astype(np.int64), minlength=len(names) * CELLS).reshape(-1, CELLS)
                for name, row in zip(names.tolist(), found, strict=True):
                    sums[name] = sums.get(name, 0) + row
            if len(sums) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, row in sums.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(row[used], pa.int64())],
                ["lang", "cell", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, cell int, n long")
    sums = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums["lang"].to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(names), CELLS))
    number = {name: i for i, name in enumerate(names)}
    at = np.array([number[x] for x in sums["lang"].to_pylist()], np.int64)
    counts[at, sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return Model(names, counts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """__row (all columns of `docs`), lang_pred, score and languages, from each row's text alone.

    lang_pred has the largest share of the selected languages (ties: the first by name) and score
    is that share; languages lists the selected ones as name:share, largest first. Texts that are
    null or have no letter, and all texts if the model has no language, are `und` with score 0. A
    text with letters always has a trigram. Each row gives one row, in place and without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, names = shared.value, shared.value.languages
        for batch in slices(batches):
            rows, letters = batch["__row"], batch["lettered"].to_pylist()
            for start, texts in _chunks(batch["text"].to_pylist()):
                best, score, sets = [], [], []
                for share, lettered in zip(fitted.mixtures(texts), letters[start : start + len(texts)], strict=True):
                    known = lettered and bool(names)
                    order = np.argsort(-share, kind="stable")
                    best.append(names[order[0]] if known else UNKNOWN)
                    score.append(min(1.0, float(share[order[0]])) if known else 0.0)
                    sets.append(",".join(f"{names[j]}:{share[j]:.3f}" for j in order if share[j] > 0) if known else "")
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(start, len(texts)), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.string())],
                    ["__row", "lang_pred", "score", "languages"],
                )

    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("__row"),
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    schema = StructType([rows.schema["__row"]])
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("languages", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(predict, schema)


def remainder(modulus: int) -> F.Column:
    """crc32 of the doc_id's decimal text, modulo `modulus`; -1 without a doc_id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learns from the documents whose remainder modulo 4 is not 2 and predicts all of them."""
    model = train(docs.filter(remainder(4) != 2))
    # Only the text is read here; lang and source are not there to be used.
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return identify(held, model).select(
        F.col("__row.doc_id").alias("doc_id"), "lang_pred", "score", "languages"
    ).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "languages"
    )


def keep_identified(docs: DataFrame, least_share: float) -> DataFrame:
    """The rows of `docs`, with all their columns, that have a language with at least this share."""
    found = identify(docs, train(docs.filter(remainder(4) != 2)))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_share)).select("__row.*")
