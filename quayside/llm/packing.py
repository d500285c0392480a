"""Packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import groups_of, slices, stage
from quayside.llm.tokens import VOCABULARY, largest_id, word_bytes

SEQUENCE_TOKENS = 1024
GROUP_PIECES = 4096
END = np.zeros(1, "<u4").tobytes()
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """A tournament of bins by free room: finds the first bin with enough of it."""

    def __init__(self, bins: int, room: int) -> None:
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def place(self, need: int) -> int:
        """Takes `need` from the first bin that has it, and returns that bin."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < need:
                node += 1
        room[node] -= need
        bin_no = node - self.leaves
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
        return bin_no


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and where it starts there; longer pieces go first, ties in order."""
    bins, at = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths >= room).sum())
    bins[order[:full]] = np.arange(full)
    used = [0] * len(lengths)
    tree = CapacityTree(max(1, len(lengths) - full), room)
    for i in order[full:].tolist():
        need = int(lengths[i])
        bin_no = tree.place(need)
        bins[i], at[i] = full + bin_no, used[bin_no]
        used[bin_no] += need
    return bins, at


def _stored(vocabulary: str) -> str:
    return "<u2" if largest_id(vocabulary) < 1 << 16 else "<u4"


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, room: int = SEQUENCE_TOKENS, ids: bool = True) -> DataFrame:
    """The pieces of at most `room` tokens that each document is cut into, written out once.

    With `ids`, a column `ids` has the token ids as little-endian unsigned numbers, of 16 bits
    where all ids of the vocabulary fit and of 32 otherwise.
    """
    narrow = _stored(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_bytes(vocabulary)
        for batch in slices(batches):
            doc_ids, starts, lengths, crcs, totals, contents = [], [], [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                whole = words.encode(text) + END
                for at in range(0, len(whole), 4 * room):
                    part = whole[at : at + 4 * room]
                    doc_ids.append(doc_id)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    totals.append(len(whole) // 4)
                    if ids:
                        contents.append(np.frombuffer(part, "<u4").astype(narrow).tobytes())
            columns = [pa.array(x, pa.int64()) for x in (doc_ids, starts, lengths, crcs, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                columns.append(pa.array(contents, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(plain.mapInArrow(cut, PIECE + (", ids binary" if ids else "")), "pieces")


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    room: int = SEQUENCE_TOKENS,
    group_pieces: int = GROUP_PIECES,
    ids: bool = True,
) -> DataFrame:
    """Packs the tokens of all documents into sequences of `room`, first fit decreasing.

    A document's tokens end with id 0 and are cut every `room` tokens. The pieces are dealt at
    random into groups of about `group_pieces`; each group is packed on its own, longest piece
    first, into the first sequence with enough room. A row per piece says where it lies;
    `ids` has the token ids as little-endian unsigned 32-bit numbers; they are stored and shuffled
    in 16 bits where the vocabulary fits. `sequence_tokens` is what its sequence holds and `padded_tokens` its stored length: `room`,
    or its own length where that is a power of two.

    Null and empty texts are a document of one token. Every row is packed, also repeated rows
    and rows without a doc_id. No rows give no rows. Other columns are ignored.
    """
    cut = pieces(docs, vocabulary, room, ids)
    count = groups_of(cut.count(), group_pieces)
    # The pieces are written out, so a row's number stays the same if a task is repeated; it keeps
    # rows that are equal in everything else apart.
    dealt = cut.withColumn(
        "__group",
        F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(count)),
    )

    narrow = _stored(vocabulary)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bins, at = first_fit_decreasing(lengths, room)
        held = np.bincount(bins, lengths)[bins].astype(np.int64)
        whole = (held & (held - 1)) == 0
        if ids:
            group["ids"] = [np.frombuffer(x, narrow).astype("<u4").tobytes() for x in group["ids"]]
        return group.drop(columns="__group").assign(
            sequence_id=group["__group"].to_numpy(np.int64) * 2**32 + bins,
            offset=at,
            sequence_tokens=held,
            padded_tokens=np.where(whole, held, room),
            doc_id=group["doc_id"].astype("Int64"),
        )

    schema = PIECE + (", ids binary" if ids else "")
    return dealt.groupBy("__group").applyInPandas(
        fill, schema + ", sequence_id long, offset long, sequence_tokens long, padded_tokens long"
    )
