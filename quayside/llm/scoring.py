"""Log-likelihood of whole documents under word counts and under a recurrent network."""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import numbers, slices, stage
from quayside.llm.language import remainder
from quayside.llm.recurrent import RATES, SPAN, Documents, Network
from quayside.session import work_dir

#: Stands for the end of a text; no word has this byte.
END = b"\n"
#: The network's numbers for the end of a text and for all words that it does not know.
END_ID, OTHER_ID = 0, 1
#: The network knows the words that occur at least sqrt(N) / RARITY times, and twice, in N training
#: tokens. At most RARITY * sqrt(N) words do, so it grows with the input, but more slowly.
RARITY = 16
#: Rows of a block: its documents are scored together with the counts of its words.
BLOCK_ROWS = 4096
#: Bytes of texts that are split into words together.
SPLIT_BYTES = 16_000_000
#: Words are counted in as many buckets as there are blocks, but not in fewer than this.
LEAST_BUCKETS = 8
COUNTS = (
    "block long, bucket int, buckets int, mark long, counts binary, total long, distinct long, words array<binary>, sizes array<long>"
)
#: Tokens that a replica of the network learns from, in ROUNDS rounds with an average after each, and how
#: many there are at least for each number of its state, so that replicas stay smaller than what they learn from.
TASK_TOKENS = 4_000_000
STATE_TOKENS = 12
ROUNDS = 4
#: Few documents are gone through again, until so many tokens are learned from, but not more often than this.
LEAST_TOKENS = 1_000_000
MOST_PASSES = 3
#: Replicas are added up in groups of so many until so many are left; of large ones in smaller groups.
FAN_IN = 64
#: Bytes of replicas that are added up together.
FAN_IN_BYTES = 128_000_000

_COUNTED = pa.schema(
    [
        ("block", pa.int64()), ("bucket", pa.int32()), ("buckets", pa.int32()), ("mark", pa.int64()), ("counts", pa.binary()),
        ("total", pa.int64()), ("distinct", pa.int64()), ("words", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())),
    ]
)


def _pieces(texts: pa.Array | pa.ChunkedArray) -> Iterator[pa.Array]:
    """The texts in slices of about SPLIT_BYTES, or of one larger text."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SPLIT_BYTES, "right")))
        piece = texts.slice(at, to - at)
        yield pa.concat_arrays(piece.chunks) if isinstance(piece, pa.ChunkedArray) else piece
        at = to


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and how many each text has.

    Words lie between ASCII white space and are in ASCII lower case; null has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
    # White space at the beginning or end of a text leaves an empty word there, which is none.
    real = pc.greater(pc.binary_length(words), 0)
    there = real.to_numpy(zero_copy_only=False)
    if not there.all():
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~there], minlength=len(sizes))
        words = words.filter(real)
    return words.cast(pa.large_binary()), sizes


def _ended(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of words with END_ID after each text, and the sizes with it."""
    sizes = sizes + 1
    out = np.full(len(codes) + len(sizes), END_ID, codes.dtype)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = codes
    return out, sizes


def _merged(parts: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The end and the distinct words of lists of words, and the places in it of each list's words."""
    every = pa.concat_arrays([pa.array([END], pa.large_binary()), *parts])
    if len(parts) == 1:
        return every, [np.arange(1, len(every), dtype=np.int32)]
    found = every.dictionary_encode()
    return found.dictionary, np.split(found.indices.to_numpy(), np.cumsum([1, *map(len, parts)])[:-1])[1:]


def _encoded(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, the end first, and all of them as places in it; an end follows each text."""
    pieces = [(words.dictionary_encode(), sizes) for words, sizes in map(_split, _pieces(texts))]
    if not pieces:
        return pa.array([END], pa.large_binary()), np.empty(0, np.int32), np.empty(0, np.int64)
    words, places = _merged([found.dictionary for found, _ in pieces])
    out = [_ended(at[found.indices.to_numpy()], sizes) for at, (found, sizes) in zip(places, pieces, strict=True)]
    codes, sizes = (np.concatenate(x) for x in zip(*out, strict=True))
    return words, codes, sizes


def _blocks(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, text, training and block: rows that lie together, so that blocks need no shuffle."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    ).withColumn("block", F.expr(f"monotonically_increasing_id() div {BLOCK_ROWS}"))


def _bucketed(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of words by bucket, and where each bucket begins; the same for the same words, however they are given."""
    inside = words.to_numpy(zero_copy_only=False)
    hashed = numbers(inside)
    order = np.argsort(hashed)
    if (np.diff(hashed[order]) == 0).any():  # words of one hash by themselves
        order = np.array(sorted(range(len(inside)), key=lambda i: (hashed[i], inside[i])), np.int64)
    bucket = (hashed[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return order, np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _joined(words: pa.Array, order: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """The words of each bucket in a row; no word has a space, nor has the end."""
    listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), words.take(pa.array(order)))
    return pc.binary_join(listed, pa.scalar(b" ", pa.large_binary())).to_pylist()


def word_counts(blocks: DataFrame) -> DataFrame:
    """The counts in all training documents of the words of each block, and of the words by themselves.

    Rows with a block have `counts`, those of the block's words in one bucket by hash, in the order that
    `_bucketed` gives; `mark` tells whether words are the same. Rows without a block have the total of a
    bucket, its distinct words and, as `words` and `sizes`, its words that occur twice or more, and the end.

    A block's distinct words travel to their buckets together, compressed, with the block's counts, and
    only counts come back. There are about as many buckets as blocks, so a bucket is about as large as a block.
    """
    buckets = max(LEAST_BUCKETS, math.ceil(blocks.count() / BLOCK_ROWS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, sizes = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            words, places = _merged(parts)
            n = np.zeros(len(words), np.int64)
            for at, mine in zip(places, sizes, strict=True):
                n[0] += mine[0]
                n[at] += mine[1:]  # a word is there once
            order, edges = _bucketed(words, buckets)
            joined, n = _joined(words, order, edges), n[order]
            used = [k for k in range(buckets) if edges[k] < edges[k + 1]]
            pack = zstandard.ZstdCompressor(level=1).compress
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(used), pa.int64()),
                    pa.array(used, pa.int32()),
                    pa.array([pack(joined[k]) for k in used], pa.binary()),
                    pa.array([pack(n[edges[k] : edges[k + 1]].tobytes()) for k in used], pa.binary()),
                ],
                ["block", "bucket", "words", "n"],
            )

        for batch in slices(batches, BLOCK_ROWS):
            blocks = batch["block"].to_numpy()
            edges = np.flatnonzero(np.r_[True, np.diff(blocks) != 0, True]).tolist() if len(blocks) else []
            for a, b in pairwise(edges):
                if (mine := int(blocks[a])) != block:
                    if block is not None:
                        yield from flush()
                    block, parts, sizes = mine, [], []
                training = batch["training"].slice(a, b - a).to_numpy(zero_copy_only=False)
                for piece in _pieces(batch["text"].slice(a, b - a)):
                    words, codes, lengths = _encoded(piece)
                    learned, training = training[: len(piece)], training[len(piece) :]
                    parts.append(words[1:])
                    # Words of other texts are known to the block, with no count of their own.
                    sizes.append(np.bincount(codes[np.repeat(learned, lengths)], minlength=len(words)))
        if block is not None:
            yield from flush()

    def add(rows: pa.Table) -> pa.Table:
        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        number: dict[bytes, int] = {}
        places, marks, parts = [], [], []
        for packed, n in zip(rows["words"].to_pylist(), rows["n"].to_pylist(), strict=True):
            joined = unpack(packed)
            words = joined.split(b" ")
            places.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            marks.append(crc32(joined))
            parts.append(np.frombuffer(unpack(n), np.int64))
        c = np.zeros(len(number), np.int64)
        for at, n in zip(places, parts, strict=True):
            c[at] += n  # a word is there once
        bucket, blocks = rows["bucket"][0].as_py(), rows["block"].to_pylist()
        often = [(w, k) for w, k in zip(number, c.tolist(), strict=True) if k > 1 or (k and w == END)]
        out = [
            {"block": b, "mark": m, "counts": pack(c[at].tobytes())} for b, m, at in zip(blocks, marks, places, strict=True)
        ]
        out.append({"total": int(c.sum()), "distinct": int((c > 0).sum()), "words": [w for w, _ in often], "sizes": [k for _, k in often]})
        return pa.Table.from_pylist([{"bucket": bucket, "buckets": buckets} | r for r in out], schema=_COUNTED)

    local = blocks.mapInArrow(count, "block long, bucket int, words binary, n binary")
    return stage(local.groupBy("bucket").applyInArrow(add, COUNTS), "word-counts")


def least_count(total: int) -> int:
    """How often a word occurs in `total` training tokens for the network to know it."""
    return max(2, math.ceil(math.sqrt(total) / RARITY))


def _network(counts: DataFrame) -> tuple[dict[bytes, int], Network, int, int, int]:
    """The numbers of the words that the network knows, its first parameters, N, V and the known words' count."""
    buckets = counts.filter("block IS NULL")
    total, distinct = buckets.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct"))).first()
    words = buckets.select(F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("sizes").alias("c"))).alias("w")).select("w.*")
    common = words.filter((F.col("word") != F.lit(END)) & (F.col("c") >= least_count(total))).collect()
    common.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    ends = words.filter(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    known = {END: END_ID} | {bytes(r["word"]): i for i, r in enumerate(common, 2)}
    sizes = [r["c"] for r in common]
    frequency = np.array([ends, total - ends - sum(sizes), *sizes], np.float64)
    return known, Network(frequency), total, distinct, ends + sum(sizes)


def _numbers(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The network's number of each word, of the `known` ones in the order of their numbers."""
    at = pc.index_in(words, known).fill_null(-1).to_numpy()
    return np.where(at < 0, OTHER_ID, np.where(at == END_ID, at, at + 1)).astype(np.int32)


def _dealt(blocks: DataFrame, known: dict[bytes, int], parts: int) -> str:
    """Where the training documents lie as word numbers, dealt at random into rounds and parts.

    The deal depends on the documents alone, not on how they are partitioned or read.
    """
    spark = blocks.sparkSession
    names = spark.sparkContext.broadcast(pa.array(list(known), pa.large_binary()))
    kind = np.uint16 if len(known) < 1 << 16 else np.int32

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ids(texts: pa.Array) -> Iterator[bytes]:
            for piece in _pieces(texts):
                words, sizes = _split(piece)
                codes, sizes = _ended(_numbers(words, names.value).astype(kind), sizes)
                yield from (x.tobytes() for x in np.split(codes, np.cumsum(sizes)[:-1]))

        for batch in slices(batches, BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays(
                [batch["round"], batch["part"], batch["place"], pa.array(ids(batch["text"]), pa.binary())], ["round", "part", "place", "ids"]
            )

    place = F.xxhash64("doc_id", "text")
    chosen = blocks.filter("training").select(
        F.pmod(place, F.lit(ROUNDS)).cast("int").alias("round"),
        F.pmod(F.shiftright(place, 16), F.lit(parts)).cast("int").alias("part"),
        place.alias("place"),
        "text",
    )
    path = work_dir(spark, "word-numbers")
    numbered = chosen.mapInArrow(number, "round int, part int, place long, ids binary")
    numbered.write.partitionBy("round").option("compression", "zstd").parquet(path)
    return path


def _in_order(rows: pa.Table, kind: type) -> list[np.ndarray]:
    """The documents in an order of their own, those of many tokens first, so that all lanes end at about a time."""
    order = np.argsort(rows["place"].to_numpy(), kind="stable")
    ids = [np.frombuffer(rows["ids"][i].as_py(), kind).astype(np.int32) for i in order.tolist()]
    return sorted((x for x in ids if len(x) >= SPAN), key=len, reverse=True) + [x for x in ids if len(x) < SPAN]


def _train(blocks: DataFrame, known: dict[bytes, int], network: Network, total: int) -> None:
    """Each round, replicas learn from the round's documents, one for each part; their mean is the next start.

    There are as many replicas as there are TASK_TOKENS in the `total` training tokens, or fewer of more for
    a large network, so how the table is partitioned makes no difference, and each learns from every window of its documents. They count by the
    tokens they learned from. They are added up in the cluster, FAN_IN at a time and no more than
    FAN_IN_BYTES, so the driver gets FAN_IN of them at most.
    """
    if not total:
        return
    spark = blocks.sparkSession
    parts = max(1, round(total / max(TASK_TOKENS, STATE_TOKENS * len(network.state()))))
    path = _dealt(blocks, known, parts)
    fan_in = max(2, min(FAN_IN, FAN_IN_BYTES // (4 * len(network.state()))))
    kind = np.uint16 if len(known) < 1 << 16 else np.int32
    rounds = ROUNDS * min(MOST_PASSES, max(1, math.ceil(LEAST_TOKENS / total)))
    for number in range(rounds):
        rate = RATES[0] * (RATES[1] / RATES[0]) ** (number / max(1, rounds - 1))
        start = spark.sparkContext.broadcast(network)

        def learn(rows: pa.Table) -> pa.Table:
            mine = copy.deepcopy(start.value)  # noqa: B023
            learned = mine.train(iter(_in_order(rows, kind)), rate)  # noqa: B023
            return pa.table({"task": pa.array([rows["part"][0].as_py()], pa.int64()), "learned": [learned], "params": [mine.state().tobytes()]})

        mine = spark.read.parquet(path).filter(F.col("round") == number % ROUNDS).select("part", "place", "ids")
        learned = mine.repartition(parts, "part").groupBy("part").applyInArrow(learn, "task long, learned long, params binary")
        replicas = stage(learned, "replicas")
        while (count := replicas.count()) > fan_in:
            grouped = replicas.withColumn("task", F.pmod(F.xxhash64("task"), F.lit(max(1, -(-count // fan_in)))))
            replicas = stage(grouped.groupBy("task").applyInArrow(_added, "task long, learned long, params binary"), "replicas")
        rows = replicas.collect()
        if rows:
            network.load(_mean([r["params"] for r in rows], [r["learned"] for r in rows]))


def _mean(params: list, learned: list[int]) -> np.ndarray:
    """The mean of replicas, each by the tokens it learned from."""
    return sum(np.frombuffer(x, np.float32) * np.float64(n) for x, n in zip(params, learned, strict=True)) / sum(learned)


def _added(rows: pa.Table) -> pa.Table:
    learned = rows["learned"].to_pylist()
    mean = _mean([x.as_buffer() for x in rows["params"]], learned).astype(np.float32)
    return pa.table({"task": [rows["task"][0].as_py()], "learned": [sum(learned)], "params": [mean.tobytes()]})


SCORED = (
    "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_documents(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score and score of each row of `docs`.

    `training` says which rows are learned from. Tokens are the words of a text in ASCII lower
    case and one end. base_score adds up log10((c + 1) / (N + V + 1)) of the tokens' counts in the
    training rows; score is the log10-probability of the whole text under a gated recurrent
    network. The network predicts the words of `least_count` or more; another word has the probability of
    "another word" there times its share, (c + 1) / (n + v + 1), of the counts of all such words.

    Null texts are empty: one token, the end. Each row gives one row; repeated rows count as often
    as they are there. No rows give none, and without training rows every count is 0. Other
    columns are ignored.

    Counts cover all documents. They come back to the documents by block: one shuffle of the
    blocks' distinct words by hash, one of their counts and of the texts by block. The network learns in
    replicas, one for each TASK_TOKENS training tokens, from every window of every training document;
    the word numbers of these are shuffled once.
    """
    blocks = _blocks(docs, training)
    counts = word_counts(blocks)
    known, network, total, distinct, frequent = _network(counts)
    _train(blocks, known, network, total)
    inner = len(known) - 1  # the known words but the end
    rest_words = max(0, distinct - inner - 1)
    names = pa.array(list(known), pa.large_binary())
    shared = docs.sparkSession.sparkContext.broadcast((names, network, total, distinct, total - frequent, rest_words))

    def score(texts: pa.Table, counted: pa.Table) -> pa.Table:
        names, net, n, v, rest, rest_v = shared.value
        words, codes, sizes = _encoded(texts["text"])
        order, edges = _bucketed(words, counted["buckets"][0].as_py() if counted.num_rows else 1)
        joined = _joined(words, order, edges)
        c, unpack = np.full(len(words), -1, np.int64), zstandard.ZstdDecompressor().decompress
        for k, mark, packed in zip(*(counted[x].to_pylist() for x in ("bucket", "mark", "counts")), strict=True):
            if mark != crc32(joined[k]):
                raise RuntimeError("the rows were dealt out to blocks differently before")
            c[order[edges[k] : edges[k + 1]]] = np.frombuffer(unpack(packed), np.int64)
        if (c < 0).any():
            raise RuntimeError("a block lacks counts of its words")
        base = np.log10((c + 1) / (n + v + 1))
        net_id = _numbers(words, names)
        extra = np.where(net_id == OTHER_ID, np.log10((c + 1) / (rest + rest_v + 1)), 0.0)
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": []}
        ids, shares = [], []
        ends = np.cumsum(sizes).tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            at = codes[a:b]
            out["n_tokens"].append(b - a)
            out["n_known"].append(int(np.count_nonzero(c[at])))
            out["base_score"].append(float(base[at].sum()))
            ids.append(net_id[at])
            shares.append(float(extra[at].sum()))
        logs = net.score(Documents(ids))
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "training": texts["training"],
                "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "n_known": pa.array(out["n_known"], pa.int64()),
                "train_tokens": pa.array([n] * len(ids), pa.int64()),
                "base_score": pa.array(out["base_score"], pa.float64()),
                "score": pa.array([float(x.sum()) / np.log(10) + s for x, s in zip(logs, shares, strict=True)], pa.float64()),
            }
        )

    dealt = counts.filter("block IS NOT NULL").select("block", "bucket", "buckets", "mark", "counts")
    return blocks.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(score, SCORED)


def score_held_out(docs: DataFrame) -> DataFrame:
    """Learns from the documents whose remainder modulo 7 is not 2 and scores all of them."""
    return score_documents(docs, remainder(7) != 2).select(
        "doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
