"""Near-duplicate groups: MinHash bands propose, odd sketches screen, full shingle sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import components, numbers, rolling, slices, stage

SHINGLE_WORDS = 5
#: Documents are linked if 100 * shared shingles >= THRESHOLD * shingles in either.
THRESHOLD = 85
#: Bands of ROWS samples each: a pair at the threshold shares none with probability
#: (1 - 0.85 ** 5) ** 25 = 4e-7, a closer pair with less.
BANDS = 25
ROWS = 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
SKETCH_LONGS = SKETCH_BITS // 64
#: A pair goes on to the full sets if its sketches put it less than this below the threshold: six
#: standard deviations of the estimate there.
MARGIN = 0.25
#: Up to so many (doc_id, class) pairs are broadcast to fetch texts; beyond, texts are shuffled.
BROADCAST_ROWS = 200_000
#: Above so many untested pairs in its buckets a round first finds which shingles are shared at all.
UNTESTED_PAIRS = 200_000
#: Dropped ids are told apart by so many hash values before texts are shuffled; no more rows are broadcast.
SIEVE = 1 << 21

_SEEDS = np.random.default_rng(20240501)
_FACTORS = _SEEDS.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _SEEDS.integers(0, 2**63, SAMPLES, dtype=np.uint64)
SKETCHED = "doc_id long, n_shingles long, cls binary, bands array<long>, sketch array<long>"


def most_different_bits() -> int:
    """Bits in which two sketches may differ for a pair that goes on to the full sets."""
    changed = SAMPLES * (1 - THRESHOLD / 100 + MARGIN)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * changed / SKETCH_BITS)))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles, in ASCII lower case.

    A text of fewer words than a shingle has one, its whole word sequence; one without words none.
    """
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    values = numbers(list(chain.from_iterable(words)))
    windows = rolling(values, SHINGLE_WORDS)
    out, start = [], 0
    for mine in words:
        n = len(mine)
        if n >= SHINGLE_WORDS:
            out.append(np.unique(windows[start : start + n - SHINGLE_WORDS + 1]))
        elif n:
            out.append(rolling(values[start : start + n], n) + np.uint64(n))
        else:
            out.append(np.empty(0, np.uint64))
        start += n
    return out


def class_of(shingles: np.ndarray) -> bytes | None:
    """Documents with the same set are of one class; an empty set is of none."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def min_hash(shingles: np.ndarray) -> np.ndarray:
    """For each of SAMPLES orders the least value in the set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):
        part = shingles[start : start + 512, None] * _FACTORS + _OFFSETS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """A bitmap with the parity of how many samples fall on each bit, as 64-bit numbers.

    Samples that two sets share cancel out in the exclusive or of their sketches, so its set bits
    tell how many differ, the more precisely the fewer they are.
    """
    mixed = (samples ^ (np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    bits = np.bincount((mixed >> np.uint64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    rows = samples.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i in range(ROWS):
        key = (key ^ rows[:, i]) * np.uint64(0x9FB21C651E98DF25)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """A narrow row per document: size and class of its shingle set, band keys and odd sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            sets = shingle_sets(batch["text"].to_pylist())
            samples = [min_hash(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.binary()),
                    pa.array([None if m is None else band_keys(m) for m in samples], pa.list_(pa.int64())),
                    pa.array([None if m is None else odd_sketch(m) for m in samples], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "cls", "bands", "sketch"],
            )

    return _plain(docs).mapInArrow(sketch, SKETCHED)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets (cls, shingles) of the classes in `wanted` (rep, cls), from their texts."""
    count = wanted.count()
    ids = wanted.select(F.col("rep").alias("doc_id"), F.col("cls").alias("want"))
    texts = _plain(docs).join(F.broadcast(ids) if count <= BROADCAST_ROWS else ids, "doc_id")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            want, sets = batch["want"].to_pylist(), shingle_sets(batch["text"].to_pylist())
            # Other rows may have the doc_id too; only the class that was asked for counts.
            mine = [(w, s.tobytes()) for w, s in zip(want, sets, strict=True) if class_of(s) == w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in mine], pa.binary()), pa.array([s for _, s in mine], pa.binary())], ["cls", "shingles"]
            )

    return texts.mapInArrow(compute, "cls binary, shingles binary").dropDuplicates(["cls"])


def _alike(n_a: Column, n_b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """Whether sizes and sketches leave a pair a chance to be linked."""
    bits = sum((F.bit_count(sketch_a[i].bitwiseXOR(sketch_b[i])) for i in range(SKETCH_LONGS)), F.lit(0))
    return (100 * F.least(n_a, n_b) >= THRESHOLD * F.greatest(n_a, n_b)) & (bits <= most_different_bits())


def _screened(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of `pairs` (u, v: classes) that sizes and sketches leave, with the documents to read."""
    side = lambda x: classes.select(
        F.col("cls").alias(x), F.col("rep").alias(f"rep_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")
    )
    near = pairs.join(side("u"), "u").join(side("v"), "v")
    near = near.filter(_alike(F.col("n_u"), F.col("n_v"), F.col("s_u"), F.col("s_v")))
    return near.select("u", "v", "rep_u", "rep_v")


def _links(docs: DataFrame, near: DataFrame) -> DataFrame:
    """Those of the screened pairs that reach the threshold on their full sets, written out."""
    near = stage(near, "near-pairs")
    ends = near.select(F.col("rep_u").alias("rep"), F.col("u").alias("cls")).union(near.select("rep_v", "v")).distinct()
    sets = stage(_sets(docs, stage(ends, "near-classes")), "shingle-sets", "none")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch["a"], batch["b"], strict=True):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= THRESHOLD * (len(a) + len(b) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    both = (
        near.select("u", "v")
        .join(sets.select(F.col("cls").alias("u"), F.col("shingles").alias("a")), "u")
        .join(sets.select(F.col("cls").alias("v"), F.col("shingles").alias("b")), "v")
    )
    return stage(both.mapInArrow(confirm, "u binary, v binary"), "links")


def _may_link(docs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The classes of `rows` (cls) with enough shingles that another one of them has too.

    A pair at the threshold shares 85 % of either's shingles, so a class of which more than 15 %
    are in no other class has no link to any of them.
    """
    mine = rows.select("cls").distinct().join(classes.select("cls", "rep", "n"), "cls")
    mine = stage(mine, "untested")
    sets = _sets(docs, mine.select("rep", "cls"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [np.frombuffer(s.as_buffer(), np.int64) for s in batch["shingles"]]
            names = list(chain.from_iterable([c] * len(s) for c, s in zip(batch["cls"].to_pylist(), found, strict=True)))
            values = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(values, pa.int64())], ["cls", "shingle"])

    each = sets.mapInArrow(split, "cls binary, shingle long")
    once = each.groupBy("shingle").agg(F.count("*").alias("m"), F.min("cls").alias("cls")).filter("m = 1")
    own = once.groupBy("cls").agg(F.count("*").alias("own"))
    counted = mine.join(own, "cls", "left").withColumn("s", F.col("n") - F.coalesce("own", F.lit(0)))
    return counted.filter(100 * F.col("s") >= THRESHOLD * F.col("n")).select("cls", "s")


def _untested(docs: DataFrame, classes: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Screened pairs of one bucket that no link has joined yet and that were not tested."""
    comp = F.coalesce("label", "cls")
    rest = members.filter("cls <> center").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", comp)
    rest = stage(rest.select("key", "cls", "comp"), "untested-members")
    mixed = rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
    mixed = stage(mixed.filter("lo <> hi").select("key", "m"), "mixed-buckets")
    rest = stage(rest.join(mixed, "key"), "mixed-members")
    pairs = mixed.agg(F.sum(F.col("m") * (F.col("m") - 1) / 2)).first()[0] or 0
    if pairs > UNTESTED_PAIRS:
        rest = stage(rest.join(_may_link(docs, classes, rest), "cls"), "mixed-members")
    else:
        rest = rest.withColumn("s", F.lit(None).cast("long"))
    rest = rest.join(classes.select("cls", "rep", "n", "sketch", "bands"), "cls").withColumn("s", F.coalesce("s", "n"))
    rest = stage(rest, "mixed-members")
    a, b = rest.alias("a"), rest.alias("b")
    # Two sets share no more than the shingles of either that are in any other set at all.
    most = F.least("a.s", "b.s")
    near = _alike(F.col("a.n"), F.col("b.n"), F.col("a.sketch"), F.col("b.sketch"))
    # A pair comes out of its first common bucket only. If one is the center there, it was tested.
    first = F.array_min(F.array_intersect("a.bands", "b.bands")) == F.col("a.key")
    near &= 100 * most >= THRESHOLD * (F.col("a.n") + F.col("b.n") - most)
    near &= first
    return (
        a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.cls") < F.col("b.cls")) & (F.col("a.comp") != F.col("b.comp")) & near)
        .select(F.col("a.cls").alias("u"), F.col("b.cls").alias("v"), F.col("a.rep").alias("rep_u"), F.col("b.rep").alias("rep_v"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of `docs`.

    A document's set are its distinct shingles of five words (white-space separated, ASCII lower
    case). Documents are linked if they share 85 % of the shingles in either, and component_id is
    the smallest doc_id that links lead to; kept marks the document with that doc_id.

    Texts that are null or without words have an empty set and are linked with nothing. Rows
    without doc_id are kept, with component_id null. Repeated rows are linked and all say the
    same; rows that share a doc_id but not the text are documents of their own. Other columns
    are ignored.

    Documents with equal sets are one class, so exact copies cost nothing further. Each class is
    filed in 25 buckets by bands of MinHash samples. In a bucket, every class is paired with one
    center, which is in the most and largest buckets, rather than with all others; odd sketches
    screen the pairs and the full sets confirm them. Pairs of a bucket that this leaves in
    different components are then tested as well, so no link is lost that shares a bucket.
    """
    rows = stage(sketches(docs), "sketches")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(
        usable.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    filed = classes.select(F.explode("bands").alias("key"), "cls")
    buckets = stage(filed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    filed = stage(filed.join(buckets, "key"), "bucket-members")
    degree = filed.groupBy("cls").agg(F.sum("size").alias("degree"))
    centers = filed.join(degree, "cls").groupBy("key").agg(F.max(F.struct("degree", "cls"))["cls"].alias("center"))
    members = stage(filed.join(stage(centers, "centers"), "key").select("key", "cls", "center"), "bucket-centers")

    stars = members.filter("cls <> center").select(F.least("cls", "center").alias("u"), F.greatest("cls", "center").alias("v"))
    links = _links(docs, _screened(classes, stage(stars.distinct(), "star-pairs")))
    labels = components(links)
    more = stage(_untested(docs, classes, members, labels), "untested-pairs")
    if not more.isEmpty():
        labels = components(links.union(_links(docs, more)))

    grouped = classes.select("cls", "rep").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    grouped = stage(grouped.select("cls", "rep", F.coalesce("label", "cls").alias("label")), "grouped")
    least = stage(grouped.groupBy("label").agg(F.min("rep").alias("component_id")), "components")
    found = stage(grouped.join(least, "label").select("cls", "component_id"), "class-components")
    ids = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("cls")).alias("cls"))
    component = F.coalesce("component_id", "doc_id")
    return ids.join(found, "cls", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that are kept; equal rows stay once.

    Rows without a doc_id and rows of null or wordless texts are kept; of rows with one doc_id and
    text one stays. No rows give none. The texts of most rows that stay are not shuffled: only those
    whose doc_id has a hash value in common with a dropped or repeated one meet the list of these.
    Among very many dropped ids that is most rows, which costs time and no result.
    """
    counted = near_duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.sum(F.col("kept").cast("long")).alias("kept"))
    special = stage(counted.filter("kept <> 1").select(F.col("doc_id").alias("id"), (F.col("kept") > 1).alias("repeated")), "dropped")
    value = F.pmod(F.xxhash64("id"), F.lit(SIEVE)).alias("value")
    values = F.broadcast(special.select(value).distinct())  # SIEVE rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("value", F.when(F.col("id").isNotNull(), value))
    found = rows.join(values, "value", "left_semi").join(special, "id", "left")
    repeated = found.filter("repeated").withColumn("text", F.col("row.text")).dropDuplicates(["id", "text"])
    kept = rows.join(values, "value", "left_anti").select("row")
    kept = kept.union(found.filter("repeated IS NULL").select("row")).union(repeated.select("row"))
    return kept.select("row.*")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
r AS (SELECT doc_id, doc_id AS seen FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
k AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""
