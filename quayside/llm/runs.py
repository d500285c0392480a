"""Periodic runs of words, found by internal pattern matching within each document."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import numbers, rolling, slices

#: A run has at least so many words and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Level of the shortest blocks, of 2 ** FIRST_LEVEL words. A run has LEAST_WORDS * 2 / 3 words or
#: more before its last period, which hold an aligned block of that length.
FIRST_LEVEL = 3
#: Words of documents that are worked on together; a longer document is worked on alone.
TOGETHER_WORDS = 1 << 17


class SuffixArray:
    """Suffixes of several sequences in order, with the ranks of all substrings of 2 ** k words.

    `ranks[k][i]` is the place of the first suffix that begins with the same 2 ** k words as suffix
    i, so the suffixes that do are the slots from there on; it is equal for equal substrings only.
    Words of different sequences differ, so no two substrings are equal across a sequence's end.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.n = n
        slots = np.argsort(words, kind="stable").astype(np.int64)
        self.order = slots
        first = np.r_[True, np.diff(words[slots]) != 0] if n else np.empty(0, bool)
        starts = np.flatnonzero(first)
        rank = np.empty(n, np.int32)
        rank[slots] = np.repeat(starts, np.diff(np.r_[starts, n]))
        self.ranks = [rank]
        # Slots whose suffix shares its first words with another one.
        open_slots = np.flatnonzero(~first | ~np.r_[first[1:], True]) if n else np.empty(0, np.int64)
        length = 1
        while len(open_slots):
            rank = self.ranks[-1].copy()
            places = self.order[open_slots]
            after = places + length
            key = self.ranks[-1][places].astype(np.int64) * (n + 1)
            key += np.where(after < n, self.ranks[-1][np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
            by_key = np.argsort(key, kind="stable")
            places, key = places[by_key], key[by_key]
            self.order[open_slots] = places
            new = np.r_[True, np.diff(key) != 0]
            group = np.flatnonzero(new)
            rank[places] = np.repeat(open_slots[group], np.diff(np.r_[group, len(key)]))
            self.ranks.append(rank)
            open_slots = open_slots[~new | ~np.r_[new[1:], True]]
            length *= 2

    def group_ends(self, level: int) -> np.ndarray:
        """For each slot that begins a group of equal substrings of this level, the slot behind it."""
        sizes = np.bincount(self.ranks[level], minlength=self.n)
        return np.arange(self.n) + sizes

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from places a and b (a < b) on."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            x, y = a + found, b + found
            inside = y < self.n
            same = inside & (self.ranks[level][np.where(inside, x, 0)] == self.ranks[level][np.where(inside, y, 0)])
            # A place outside is compared with itself above, which `inside` leaves out.
            found += same.astype(np.int64) << level
        return found

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal before places a and b (a < b), going backwards."""
        found = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            x, y = a - found - (1 << level), b - found - (1 << level)
            inside = x >= 0
            same = inside & (self.ranks[level][np.where(inside, x, 0)] == self.ranks[level][np.where(inside, y, 0)])
            found += same.astype(np.int64) << level
        return found


class WaveletTree:
    """Answers, for a range of slots, which is the next greater or smaller value in it.

    The bits of the values are kept level by level, the highest first; each level deals the
    values with a 0 before those with a 1, as a wavelet tree whose nodes lie side by side.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.zeros.append(np.r_[0, np.cumsum(1 - one)].astype(np.int32))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of slots lo to hi (exclusive) are less than `limit`."""
        lo, hi, found = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(lo), np.int64)
        over = limit >= (1 << self.bits)
        whole = np.where(over, hi - lo, 0)
        limit = np.clip(limit, 0, (1 << self.bits) - 1)
        for depth, zeros in enumerate(self.zeros):
            one = ((limit >> (self.bits - 1 - depth)) & 1).astype(bool)
            z_lo, z_hi = zeros[lo], zeros[hi]
            found += np.where(one, z_hi - z_lo, 0)
            lo, hi = np.where(one, zeros[-1] + lo - z_lo, z_lo), np.where(one, zeros[-1] + hi - z_hi, z_hi)
        return np.where(over, whole, found)

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest value (from 0) of slots lo to hi; there must be one."""
        lo, hi, n = lo.astype(np.int64), hi.astype(np.int64), n.astype(np.int64)
        value = np.zeros(len(lo), np.int64)
        for zeros in self.zeros:
            z_lo, z_hi = zeros[lo], zeros[hi]
            one = n >= z_hi - z_lo
            n = np.where(one, n - (z_hi - z_lo), n)
            value = value * 2 + one
            lo, hi = np.where(one, zeros[-1] + lo - z_lo, z_lo), np.where(one, zeros[-1] + hi - z_hi, z_hi)
        return value


def _progressions(tree: WaveletTree, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second value of slots lo to hi that are in [start, end); -1 where there is none."""
    before, until = tree.below(lo, hi, start), tree.below(lo, hi, end)
    first = np.full(len(lo), -1, np.int64)
    second = first.copy()
    for out, number in ((first, 0), (second, 1)):
        have = np.flatnonzero(until - before > number)
        out[have] = tree.nth(lo[have], hi[have], before[have] + number)
    return first, second


def _candidates(array: SuffixArray, tree: WaveletTree) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs such that each run has its place and period among them.

    A run of period q has an aligned block of 2 ** k words, q < 2 ** (k + 1), that lies in it
    together with the same block q words further on. So the block's occurrences at distances
    below 2 ** (k + 1) are looked up, in four neighbouring windows of half a block each. The
    occurrences in such a window are a progression. A single one gives its distance. Of several,
    the step p is a period of the block, and so a candidate; a run of another period that holds the
    block holds two different stretches of period p, around the block and around the window's
    occurrences, whose starts or ends are that period apart.
    """
    places, periods = [], []
    for level in range(FIRST_LEVEL, len(array.ranks)):
        size = 1 << level
        block = np.arange(0, array.n, size, dtype=np.int64)
        lo = array.ranks[level][block].astype(np.int64)
        hi = array.group_ends(level)[lo]
        again = hi - lo > 1
        block, lo, hi = block[again], lo[again], hi[again]
        if not len(block):
            continue
        for window in range(4):
            start = block + 1 + window * (size // 2)
            first, second = _progressions(tree, lo, hi, start, start + size // 2)
            one = (first >= 0) & (second < 0)
            places.append(block[one])
            periods.append(first[one] - block[one])
            many = second >= 0
            b, f, step = block[many], first[many], (second - first)[many]
            mine, other = _stretch(array, b, step), _stretch(array, f, step)
            places += [b, b, b]
            periods += [step, other[0] - mine[0], other[1] - mine[1]]
    place = np.concatenate(places) if places else np.empty(0, np.int64)
    period = np.concatenate(periods) if periods else np.empty(0, np.int64)
    good = (period > 0) & (place + period < array.n)
    return place[good], period[good]


def _stretch(array: SuffixArray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around `place` whose words `period` apart are equal."""
    further = np.minimum(place + period, array.n - 1)
    start = place - array.common_before(place, further)
    return start, further + array.common(place, further)


def find_runs(sequences: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each sequence of word numbers, as rows of start, length and period in that order.

    A run is a stretch with smallest period q and at least max(24, 3 q) words that cannot be longer
    with that period.
    """
    out = [np.empty((0, 3), np.int64) for _ in sequences]
    if not sum(map(len, sequences)):
        return out
    at = np.r_[0, np.cumsum([len(s) for s in sequences])]
    flat = np.concatenate(sequences).astype(np.int64)
    owner = np.repeat(np.arange(len(sequences)), np.diff(at))
    array = SuffixArray(owner * (flat.max() + 1) + flat)
    if len(array.ranks) <= FIRST_LEVEL:
        return out
    place, period = _candidates(array, WaveletTree(array.order))
    place, period = np.unique(np.column_stack([place, period]), axis=0).T if len(place) else (place, period)
    start, end = _stretch(array, place, period)
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    found = np.unique(np.column_stack([start, end - start, period])[long], axis=0)
    if not len(found):
        return out
    # Multiples of the smallest period give the same stretch again, later in this order.
    found = found[np.r_[True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1)]]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    of = owner[found[:, 0]]
    for i in np.unique(of).tolist():
        mine = found[of == i].copy()
        mine[:, 0] -= at[i]
        out[i] = mine
    return out


def kept_words(length: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: those in a run after its first period do not."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def greatest(runs: np.ndarray) -> tuple[int, int, int]:
    """Start, length and period of the run with the most periods, exactly compared; the first of equal ones."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


def _repeating(words: np.ndarray) -> bool:
    """Whether any block of the shortest kind is there twice; without that there is no run."""
    blocks = rolling(words, 1 << FIRST_LEVEL)
    return len(np.unique(blocks)) < len(blocks)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, with the tail of each tenth document (by crc32 of its doc_id) made periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


FOUND = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(docs: DataFrame, collapsed: bool = False, plant: bool = False) -> DataFrame:
    """Each document's runs and what is left of it when every run keeps its first period only.

    Words are parted by ASCII white space and numbered from 0. A run is a stretch of words with
    smallest period q, of at least max(24, 3 q) words, that no neighbouring word extends. Returned are
    doc_id, n_runs, the start, length, period and exponent_milli (1000 length / period, rounded down)
    of the run with the most periods (ties: smallest start, then period; nulls without a run), and
    the SHA-256 of all runs (`start,length,period` lines by start, then period) and of the kept
    words, joined by spaces. With `collapsed` the kept words themselves are a last column, `text`,
    and the runs a column `runs`. With `plant`, the test query's periodic tails are put in first.

    Null and empty texts have no words and no run. Each row gives one row, also repeated ones and
    those without a doc_id; no rows give none. Other columns are ignored.

    One pass without a shuffle. A task holds documents of TOGETHER_WORDS words, or one longer one,
    and O(n log n) numbers for those in which any eight words come twice.
    """
    schema = FOUND + (", text string, runs array<struct<start: long, length: long, period: long>>" if collapsed else "")

    def rows(doc_ids: list, words: list[list[bytes]], known: list[np.ndarray]) -> pa.RecordBatch:
        runs = find_runs(known)
        columns: dict[str, list] = {name.split()[0]: [] for name in FOUND.split(", ")}
        texts, lists = [], []
        for doc_id, mine, found in zip(doc_ids, words, runs, strict=True):
            best = greatest(found) or (None, None, None)
            lines = "".join(f"{s},{length},{p}\n" for s, length, p in found.tolist())
            if len(found):
                mine = [w for w, stays in zip(mine, kept_words(len(mine), found).tolist(), strict=True) if stays]
            left = b" ".join(mine)
            columns["doc_id"].append(doc_id)
            columns["n_runs"].append(len(found))
            for name, value in zip(("start", "length", "period"), best, strict=True):
                columns[name].append(value)
            columns["exponent_milli"].append(None if best[0] is None else 1000 * best[1] // best[2])
            columns["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
            columns["collapsed_sha256"].append(hashlib.sha256(left).hexdigest())
            if collapsed:
                texts.append(left.decode("utf-8", "replace"))
                lists.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()])
        kinds = [pa.string() if name.endswith("256") else pa.int64() for name in columns]
        arrays = [pa.array(values, kind) for values, kind in zip(columns.values(), kinds, strict=True)]
        names = list(columns)
        if collapsed:
            run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            arrays += [pa.array(texts, pa.string()), pa.array(lists, pa.list_(run))]
            names += ["text", "runs"]
        return pa.RecordBatch.from_arrays(arrays, names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, words, known, size = [], [], [], 0
        for batch in slices(batches, 256):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                mine = (text or b"").split()
                if plant:
                    mine = planted(doc_id, mine)
                if size and size + len(mine) > TOGETHER_WORDS:
                    yield rows(doc_ids, words, known)
                    doc_ids, words, known, size = [], [], [], 0
                doc_ids.append(doc_id)
                words.append(mine)
                known.append(_numbered(mine))
                size += len(mine)
        if doc_ids:
            yield rows(doc_ids, words, known)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return plain.mapInArrow(find, schema)


def _numbered(words: list[bytes]) -> np.ndarray:
    """Numbers of the words in a document that may have a run; otherwise none."""
    if len(words) < LEAST_WORDS or not _repeating(numbers(words)):
        return np.empty(0, np.int64)
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))

