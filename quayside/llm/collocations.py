"""Phrases whose words go together: windows are counted once, shorter phrases are sums over them."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import slices, stage

#: Words of the longest phrase, and of a window.
ORDER = 3
LEAST_COUNT = 10
#: A candidate is dropped if a longer one around it has this share (in percent) of its occurrences.
ABSORBED_PERCENT = 50
TOP = 2000
#: Windows that are counted together inside a task.
BLOCK_WINDOWS = 1 << 22
#: Three numbers of so many different words fit 63 bits. A block with more (of one very long text)
#: is counted in segments of half as many windows.
NUMBERED_WORDS = 1 << 21
#: Counted windows that a task after the shuffle gets.
TASK_WINDOWS = 1 << 20
#: Bytes of a text that become words at a time.
PART_BYTES = 1 << 22
#: Rows of about so many documents tell which pairs of words begin the most windows.
SAMPLE_ROWS = 4_000
#: A pair that begins this share of the sample's windows is dealt out over SALTS parts. There are no
#: more than 1 / HOT_SHARE of them, so their list is small.
HOT_SHARE = 1 / 2000
SALTS = 64
#: Parts in which each language's best phrases are found before the last ranking.
RANK_PARTS = 32
UNKNOWN = "und"

#: ASCII capitals in lower case, tabs as spaces, and an end of a piece for each separating character.
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 10
)
WORDS = [f"w{i}" for i in range(1, ORDER + 1)]


class _Block:
    """Word numbers of documents of a few languages; 0 ends a piece."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {b"\n": 0}
        self.found: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        plain, at = text.translate(_TABLE), 0
        mine = self.found.setdefault(lang, [])
        while at < len(plain):
            # A part ends after white space, so that no word is cut.
            end = at + PART_BYTES
            while end < len(plain) and plain[end - 1] not in b" \n":
                end += 1
            words = plain[at:end].replace(b"\n", b" \n ").split(b" ")
            number = self.number.setdefault
            ids = np.array([number(w, len(self.number)) for w in words if w], np.int64)
            mine.append(ids)
            self.size += len(ids)
            at = end
        mine.append(np.zeros(ORDER - 1, np.int64))

    def rows(self, hot: dict[str, set[tuple[bytes, bytes]]]) -> Iterator[pa.RecordBatch]:
        """Each window with its count in the block, in order of its words; an empty word is padding."""
        names = np.array([b"", *list(self.number)[1:]], object)
        number = {name: i for i, name in enumerate(names.tolist())} if hot else {}
        for lang, parts in self.found.items():
            ids = np.concatenate(parts)
            segment = len(ids) if len(names) < NUMBERED_WORDS else NUMBERED_WORDS // 2
            for at in range(0, len(ids) - ORDER + 1, segment):
                known, local = np.unique(ids[at : at + segment + ORDER - 1], return_inverse=True)
                if known[0] != 0:  # so that 0 is padding here too
                    known, local = np.r_[0, known], local + 1
                lead = [local[i : len(local) - ORDER + 1 + i].copy() for i in range(ORDER)]
                for i in range(1, ORDER):
                    lead[i][lead[i - 1] == 0] = 0
                key = np.zeros(len(lead[0]), np.int64)
                for column in lead:
                    key = key * len(known) + column
                key, n = np.unique(key[lead[0] > 0], return_counts=True)
                pairs = [(number[a], number[b]) for a, b in hot.get(lang, ()) if a in number and b in number]
                place = np.searchsorted(known, np.array(pairs, np.int64).reshape(-1, 2)).clip(max=len(known) - 1)
                there = (known[place] == np.array(pairs, np.int64).reshape(-1, 2)).all(axis=1)
                frequent = place[there, 0] * len(known) + place[there, 1]
                for first in range(0, len(key), 50_000):
                    yield self._batch(lang, names[known], key[first : first + 50_000], n[first : first + 50_000], frequent)

    def _batch(self, lang: str, names: np.ndarray, key: np.ndarray, n: np.ndarray, frequent: np.ndarray) -> pa.RecordBatch:
        pair, third = key // len(names), key % len(names)
        salt = np.zeros(len(key), np.int32)
        for i in np.flatnonzero(np.isin(pair, frequent)).tolist():
            salt[i] = 1 + zlib.crc32(names[third[i]]) % SALTS
        words = [pa.array(names[x], pa.binary()) for x in (pair // len(names), pair % len(names), third)]
        joined = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(key), pa.string()), joined, pa.array(salt), pa.array(n, pa.int64())],
            ["lang", "window", "salt", "n"],
        )


def windows(docs: DataFrame, hot: dict[str, set[tuple[bytes, bytes]]] | None = None) -> DataFrame:
    """lang, window, salt and n: the windows of each task's documents, counted there.

    There is a window for each word: it and the next two of its piece, with padding (an empty
    word) behind the piece's end, joined by spaces. Windows of a `hot` pair get a salt by their third word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot or {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in slices(batches, 256):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                block.add(lang, text)
                if block.size >= BLOCK_WINDOWS:
                    yield from block.rows(shared.value)
                    block = _Block()
        yield from block.rows(shared.value)

    plain = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").cast("binary").alias("text")
    ).filter("length(text) > 0")
    return plain.mapInArrow(count, "lang string, window binary, salt int, n long").withColumn("window", F.col("window").cast("string"))


def _frequent(docs: DataFrame) -> tuple[dict[str, set[tuple[bytes, bytes]]], int]:
    """Pairs that begin many windows, by language, and about how many counted windows there are.

    A sample tells both. They only say how the work is dealt out; the counts are the same.
    """
    total = docs.count()
    if not total:
        return {}, 0
    share = min(1.0, SAMPLE_ROWS / total)
    begun = windows(docs.sample(share, seed=7)).groupBy("lang", F.substring_index("window", " ", 2).alias("pair")).agg(F.count("*").alias("m"))
    begun = stage(begun, "pairs")
    rows = begun.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    hot: dict[str, set[tuple[bytes, bytes]]] = {}
    for r in begun.filter(F.col("m") >= max(2, rows * HOT_SHARE)).collect():
        hot.setdefault(r["lang"], set()).add(tuple(r["pair"].encode().split(b" ")))
    return hot, math.ceil(rows / share)


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """lang, w1, w2, w3, words and f: every phrase of 1 to 3 words with f >= least; n of a language has words = 0.

    Only windows are shuffled and counted. A window that is too rare gives up its last word, and
    one whose first pair is too rare also the second; what is left is summed up by ROLLUP over
    ever shorter prefixes, which gives the counts of shorter phrases.
    """
    hot, expected = _frequent(docs)
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(expected / TASK_WINDOWS))
    near, pair = ["pair", "lang", "salt"], F.substring_index("window", " ", 2)
    # Dealt by pair of words and sorted once, windows and pairs are counted without a further shuffle.
    dealt = windows(docs, hot).repartition(partitions, pair, "lang", "salt")
    dealt = dealt.select(pair.alias("pair"), "lang", "salt", F.substring_index("window", " ", -1).alias("w3"), "n")
    dealt = dealt.sortWithinPartitions(*near, "w3")
    counted = dealt.withColumn("in_pair", F.sum("n").over(Window.partitionBy(*near)))
    counted = counted.withColumn("in_window", F.sum("n").over(Window.partitionBy(*near, "w3")))
    # A salted pair is in several parts, so its sum here says nothing; it stays.
    rare = (F.col("salt") == 0) & (F.col("in_pair") < least)
    kept = counted.select(
        "lang",
        F.substring_index("pair", " ", 1).alias("w1"),
        F.when(rare, "").otherwise(F.substring_index("pair", " ", -1)).alias("w2"),
        F.when(rare | (F.col("in_window") < least), "").otherwise(F.col("w3")).alias("w3"),
        "n",
    )
    summed = kept.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The level has a bit for each column that is summed over, the last column first.
    length = F.when(F.col("level") == 0, 3).when(F.col("level") == 1, 2).when(F.col("level") == 3, 1).when(F.col("level") == 7, 0)
    last = F.when(F.col("level") == 0, F.col("w3")).when(F.col("level") == 1, F.col("w2")).otherwise(F.lit("-"))
    found = summed.withColumn("words", length).filter(
        F.col("words").isNotNull() & (last != "") & ((F.col("f") >= least) | (F.col("words") == 0))
    )
    return stage(found.select("lang", *WORDS, "words", "f"), "phrases")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact up to counts of 18 digits that stay below 10^16 as a product's root."""
    wide = lambda x: f"CAST({x} AS DECIMAL(19, 0))"
    return F.expr(f"1000000BD * {wide(a)} * {wide(a)} div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's best phrases of 2 or 3 words.

    Words are parted by spaces and tabs within pieces, pieces by `.,;:!?` and line ends; ASCII
    capitals count as lower case. A phrase is a candidate if it occurs a >= least times within
    pieces. Of its cuts into a left part (l times) and a right part (r times) the one with the lowest
    floor(1000000 a a / (l r)) counts, of equal ones the one with the shorter left part. A
    candidate is dropped if a longer candidate around it occurs at least half as often. The first
    `top` by score, then a (both from the greatest), then phrase are returned.

    Null and empty texts have no words, a null language is "und", repeated rows count each time,
    and no rows give none. Other columns are ignored.
    """
    counts = phrase_counts(docs, least)
    of = lambda n: counts.filter(F.col("words") == n)
    one = of(1).select("lang", "w1", "f")
    two = of(2).select("lang", "w1", "w2", "f")
    three = of(3).select("lang", *WORDS, F.col("f").alias("a"))
    head, tail = one.toDF("lang", "w1", "head"), one.toDF("lang", "w2", "tail")

    longer = three.select("lang", "w1", "w2", "a").union(three.select("lang", "w2", "w3", "a"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("a").alias("around"))
    pairs = two.withColumnRenamed("f", "a").join(longer, ["lang", "w1", "w2"], "left")
    pairs = pairs.filter(F.col("around").isNull() | (100 * F.col("around") < ABSORBED_PERCENT * F.col("a")))
    pairs = pairs.join(head, ["lang", "w1"]).join(tail, ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a",
        F.col("head").alias("l"), F.col("tail").alias("r"),
    )
    pairs = pairs.withColumn("score", _score("a", "l", "r"))

    cuts = (
        three.join(head, ["lang", "w1"])
        .join(two.toDF("lang", "w2", "w3", "tail2"), ["lang", "w2", "w3"])
        .join(two.toDF("lang", "w1", "w2", "head2"), ["lang", "w1", "w2"])
        .join(one.toDF("lang", "w3", "tail"), ["lang", "w3"])
        .withColumn("early", _score("a", "head", "tail2"))
        .withColumn("late", _score("a", "head2", "tail"))
    )
    first = F.col("early") <= F.col("late")
    triples = cuts.select(
        "lang", F.concat_ws(" ", *WORDS).alias("phrase"), "a",
        F.when(first, F.col("head")).otherwise(F.col("head2")).alias("l"),
        F.when(first, F.col("tail2")).otherwise(F.col("tail")).alias("r"),
        F.least("early", "late").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part first, so that no task ranks all phrases of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ranked = pairs.unionByName(triples).withColumn("part", part)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = F.broadcast(of(0).select("lang", F.col("f").alias("n")))  # a row per language
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT lang, unnest(string_split_regex(low, '[.,;:!?\n-\r]')) AS piece FROM (SELECT coalesce(lang, 'und') AS lang,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)),
w AS MATERIALIZED (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS pos FROM (SELECT lang, row_number() OVER () AS id,
      list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p)),
g AS MATERIALIZED (SELECT lang, w1, lead(w1) OVER (PARTITION BY id ORDER BY pos) AS w2, lead(w1, 2) OVER (PARTITION BY id ORDER BY pos) AS w3 FROM w),
f AS MATERIALIZED (SELECT lang, phrase, count(*) AS f FROM (
      SELECT lang, w1 AS phrase FROM g UNION ALL SELECT lang, w1 || ' ' || w2 FROM g UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 FROM g)
      WHERE phrase IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE f >= 10 AND contains(phrase, ' ')),
parts AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS k FROM c),
cut AS (SELECT c.lang, c.phrase, a, len(w) AS size, k, x.f AS l, y.f AS r,
      CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
   FROM parts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : k], ' ')
   JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, inner_phrase, max(a) AS a FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase
   FROM c WHERE len(w) = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase,
   b.a, b.l, b.r, CAST(n.n AS BIGINT) AS n, b.score
FROM best b JOIN n USING (lang) LEFT JOIN around o ON o.lang = b.lang AND o.inner_phrase = b.phrase
WHERE o.a IS NULL OR 100 * o.a < 50 * b.a QUALIFY rank <= 2000"""
