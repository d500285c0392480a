"""Benchmark passages in documents, also reordered ones, by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quayside.llm.common import groups_of, numbers, rolling, slices

#: Tokens of the shortest tile.
MIN_TILE = 4
#: An item is in a document if tiles cover this share of its tokens.
COVERAGE = 0.6
#: Characters of benchmark text that are sent to the tasks at a time; a larger benchmark takes more passes.
BLOCK_CHARS = 8 << 20

_SPLIT = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation; other characters are kept."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def tile(doc: np.ndarray, item: np.ndarray, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length), in the order of marking.

    The longest match of unmarked tokens is marked again and again until none of `min_tile`
    tokens is left; ties go to the first in the item, then in the document. Rounds search by
    running Karp-Rabin from a length down: windows of unmarked tokens with equal hashes are
    grown to their full length and compared, and marked if they reach the length searched for.
    """
    marked_doc, marked_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    while True:
        matches = _longest(doc, item, marked_doc, marked_item, min_tile)
        if not matches:
            return tiles
        for i, j, size in matches:
            if not (marked_doc[i : i + size].any() or marked_item[j : j + size].any()):
                marked_doc[i : i + size] = marked_item[j : j + size] = True
                tiles.append((i, j, size))


def _longest(doc, item, marked_doc, marked_item, min_tile) -> list[tuple[int, int, int]]:
    """All matches of unmarked tokens that have the largest length."""
    open_doc = np.flatnonzero(_free(marked_doc, min_tile))
    open_item = np.flatnonzero(_free(marked_item, min_tile))
    if not len(open_doc) or not len(open_item):
        return []
    hash_doc, hash_item = rolling(doc, min_tile)[open_doc], rolling(item, min_tile)[open_item]
    order = np.argsort(hash_doc, kind="stable")
    left = np.searchsorted(hash_doc[order], hash_item, "left")
    right = np.searchsorted(hash_doc[order], hash_item, "right")
    best, found = min_tile, []
    for j, a, b in zip(open_item.tolist(), left.tolist(), right.tolist(), strict=True):
        for i in open_doc[order[a:b]].tolist():
            if i and j and doc[i - 1] == item[j - 1] and not marked_doc[i - 1] and not marked_item[j - 1]:
                continue  # the match begins further left, where it is longer
            size = 0
            most = min(len(doc) - i, len(item) - j)
            while size < most and doc[i + size] == item[j + size] and not (marked_doc[i + size] or marked_item[j + size]):
                size += 1
            if size > best:
                best, found = size, [(i, j, size)]
            elif size == best:
                found.append((i, j, size))
    return found


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Whether the window of `length` from each position has no marked token."""
    if len(marked) < length:
        return np.zeros(0, bool)
    total = np.r_[0, np.cumsum(marked)]
    return total[length:] == total[:-length]


class Index:
    """Benchmark items with the hashes of their shared-token seeds."""

    def __init__(self, items: list[tuple[int, str]], min_tile: int) -> None:
        self.ids = [i for i, _ in items]
        self.words = [numbers(tokens(t)) for _, t in items]
        self.min_tile = min_tile
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        lengths = [min(min_tile, len(w)) for w in self.words]
        for length in sorted({x for x in lengths if x}):
            mine = [i for i, x in enumerate(lengths) if x == length]
            seeds = [rolling(self.words[i], length) for i in mine]
            flat = np.concatenate(seeds)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(mine, [len(s) for s in seeds])[order]
            position = np.concatenate([np.arange(len(s)) for s in seeds])[order]
            self.by_length[length] = flat[order], owner, position

    def search(self, texts: list[str | None], coverage: float) -> list[tuple[int, int, float, int, int]]:
        """(text, item_id, coverage, covered tokens, tiles) of each item that a text holds."""
        words = [tokens(t) for t in texts]
        ends = np.cumsum([len(w) for w in words])
        values = numbers(list(chain.from_iterable(words)))
        out = []
        for length, (seeds, owner, position) in self.by_length.items():
            windows = rolling(values, length)
            # A bitmap of the seeds' last bits passes few other windows on to the exact test.
            near = np.zeros(1 << 20, bool)
            near[seeds & np.uint64((1 << 20) - 1)] = True
            at = np.flatnonzero(near[windows & np.uint64((1 << 20) - 1)])
            at = at[seeds[np.minimum(np.searchsorted(seeds, windows[at]), len(seeds) - 1)] == windows[at]]
            text = np.searchsorted(ends, at, "right")
            inside = at + length <= ends[text]
            at, text = at[inside], text[inside]
            for t in np.unique(text).tolist():
                first = int(ends[t]) - len(words[t])
                mine = values[first : int(ends[t])]
                for i, part in self._shared(np.unique(windows[at[text == t]]), seeds, owner, position):
                    item = self.words[i]
                    covered = np.zeros(len(item) + length, bool)
                    for start in part.tolist():
                        covered[start : start + length] = True
                    # Tiles lie within shared seeds, so these positions bound what tiling can cover.
                    if covered.sum() < coverage * len(item):
                        continue
                    tiles = tile(mine, item, length)
                    size = sum(x[2] for x in tiles)
                    if size >= coverage * len(item):
                        out.append((t, self.ids[i], size / len(item), size, len(tiles)))
        return out

    @staticmethod
    def _shared(windows, seeds, owner, position) -> Iterator[tuple[int, np.ndarray]]:
        """The items that share a seed with the windows, and where in the item."""
        left, right = np.searchsorted(seeds, windows, "left"), np.searchsorted(seeds, windows, "right")
        rows = np.concatenate([np.arange(a, b) for a, b in zip(left.tolist(), right.tolist(), strict=True)])
        for i in np.unique(owner[rows]).tolist():
            yield i, position[rows[owner[rows] == i]]


FOUND = "doc_id long, item_id long, coverage double, covered long, n_tiles long"


def overlaps(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE) -> DataFrame:
    """The items that each document holds: doc_id, item_id, coverage, covered (tokens), n_tiles.

    Documents and items are lower-case words without punctuation. For items that share enough
    seeds of `min_tile` words with a document, greedy string tiling marks the longest common
    passages, whatever their order; an item is held if its tiles cover `coverage` of its words.
    Items of fewer words than `min_tile` must be there whole. Null and empty texts hold nothing
    and are held by nothing; items without item_id are left out. Repeated documents and items
    give repeated rows. Other columns are ignored.

    The benchmark is sent to the tasks in blocks of at most BLOCK_CHARS characters and one item,
    with one pass over the documents for each; nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [rows.mapInArrow(_searcher(index, coverage), FOUND) for index in _indexes(benchmark, min_tile)]
    return reduce(DataFrame.unionByName, found)


def _indexes(benchmark: DataFrame, min_tile: int) -> list:
    """Broadcast indexes of the benchmark, block by block."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id IS NOT NULL AND length(text) > 0")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = groups_of(size, BLOCK_CHARS // 2)
    out = []
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        out.append(spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in part.collect()], min_tile)))
    return out


def _searcher(index, coverage: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        for batch in slices(batches):
            doc_ids = batch["doc_id"].to_pylist()
            out = [(doc_ids[t], *hit) for t, *hit in held.search(batch["text"].to_pylist(), coverage)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "coverage", "covered", "n_tiles"],
            )

    return search


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text holds no item of the benchmark."""

    def filtered(rows: DataFrame, index) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                held = np.zeros(batch.num_rows, bool)
                # The text goes to Python once, within its row.
                texts = batch["__row"].field("text") if plain else batch["__text"]
                held[[t for t, *_ in index.value.search(texts.to_pylist(), coverage)]] = True
                yield batch.select(["__row"]).filter(pa.array(~held))

        marked = rows if plain else rows.withColumn("__text", F.col("__row.text").cast("string"))
        return marked.mapInArrow(keep, rows.schema)

    plain = docs.schema["text"].dataType == StringType()
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("__row"))
    return reduce(filtered, _indexes(benchmark, min_tile), rows).select("__row.*")
