"""Offset bookkeeping on ranges.

Sets of offsets are kept as disjoint, non-adjacent inclusive ranges per key. No step
orders all offsets of one topic partition in one task: work is cut into blocks of
consecutive offsets, and only ranges that touch a block edge meet again afterwards.
Watermarks and assignments, a row per topic partition, are broadcast: a join by partition
would bring all ranges of one into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTITION = ("topic", "partition")
BLOCK = 1 << 15


def _pieces(grouped: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """Ranges of groups that hold the sorted starts `s` and the sorted ends `e` of a block's parts.

    A range ends where as many parts have ended as have begun, so the two lists are compared
    place by place. Ranges inside a block are done; those that touch a block edge meet in one
    group per key, at most two from each block.
    """
    s, e = F.col("s"), F.col("e")
    starts = F.filter(s, lambda x, i: F.coalesce(F.get(e, i - 1) < x - 1, F.lit(True)))
    ends = F.filter(e, lambda x, i: F.coalesce(F.get(s, i + 1) > x + 1, F.lit(True)))
    found = F.explode(F.arrays_zip(starts.alias("start"), ends.alias("end"))).alias("r")
    pieces = grouped.select(*keys, found).select(*keys, "r.start", "r.end")
    at_edge = (F.pmod(F.col("start"), F.lit(block)) == 0) | (
        F.pmod(F.col("end"), F.lit(block)) == block - 1
    )
    order = Window.partitionBy(*keys).orderBy("start")
    stitched = (
        pieces.where(at_edge)
        .withColumn("fresh", F.col("start") != F.lag("end", 1).over(order) + 1)
        .withColumn("run", F.count_if(F.coalesce("fresh", F.lit(True))).over(order))
        .groupBy(*keys, "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("run")
    )
    return pieces.where(~at_edge).unionByName(stitched)


def offset_ranges(
    records: DataFrame, keys: Sequence[str] = PARTITION, block: int = BLOCK
) -> DataFrame:
    """Distinct offsets of each key as ranges: `keys, start, end`.

    Offsets are first gathered per key and block, which combines before the shuffle and
    is bounded by the block whatever the number of records or duplicates.
    """
    o = F.sort_array(F.collect_set(F.col("offset").cast("bigint")))
    grouped = records.groupBy(*keys, F.floor(F.col("offset") / block).alias("block")).agg(o.alias("s"))
    return _pieces(grouped.withColumn("e", F.col("s")), keys, block)


def merge_ranges(
    ranges: DataFrame, keys: Sequence[str] = PARTITION, block: int = BLOCK
) -> DataFrame:
    """Union of possibly overlapping or adjacent ranges `keys, start, end`."""
    floor = lambda name: F.floor(F.col(name) / block)
    cut = ranges.select(
        *keys, "start", "end", F.explode(F.sequence(floor("start"), floor("end"))).alias("block")
    ).select(
        *keys,
        "block",
        F.greatest("start", F.col("block") * block).alias("start"),
        F.least("end", (F.col("block") + 1) * block - 1).alias("end"),
    )
    # Copies of a range collapse before the shuffle: a group holds distinct ranges of a block,
    # each as one number.
    first = F.col("block") * block
    packed = (F.col("start") - first) * block + (F.col("end") - first)
    sets = cut.groupBy(*keys, "block").agg(F.collect_set(packed).alias("p"))
    listed = sets.select(
        *keys,
        F.sort_array(F.transform("p", lambda x: F.floor(x / block) + first)).alias("s"),
        F.sort_array(F.transform("p", lambda x: x % block + first)).alias("e"),
    )
    return _pieces(listed, keys, block)


def _listed(ranges: DataFrame, group: Sequence) -> DataFrame:
    """Sorted starts `s` and sorted ends `e` of each group's ranges."""
    lists = [F.sort_array(F.collect_list(c)).alias(c[0]) for c in ("start", "end")]
    return ranges.groupBy(*group).agg(*lists)


def file_offsets(planned: DataFrame, block: int = BLOCK) -> DataFrame:
    """Offset ranges each file holds per topic partition."""
    return offset_ranges(planned, ("shard", "stream_id", "file_seq", *PARTITION), block)


def uploaded_offsets(manifest: DataFrame, block: int = BLOCK) -> DataFrame:
    """Union of the offset ranges of all released files in a manifest."""
    released = manifest.where(F.col("status").isin("uploaded", "released"))
    exploded = released.select(F.explode("offsets").alias("r"))
    return merge_ranges(exploded.select("r.topic", "r.partition", "r.start", "r.end"), block=block)


def committable(
    uploaded: DataFrame, watermarks: DataFrame, assignment: DataFrame | None = None
) -> DataFrame:
    """Partitions whose watermark advances: `topic, partition, watermark, commit_offset`.

    The commit offset is the first one from the watermark on that is not uploaded.
    `uploaded` holds merged ranges, so that is the end of the one range around the
    watermark. Partitions without a watermark or outside the assignment are left out.
    """
    if assignment is not None:
        uploaded = uploaded.join(F.broadcast(assignment.select(*PARTITION)), list(PARTITION), "left_semi")
    here = (F.col("start") <= F.col("watermark")) & (F.col("watermark") <= F.col("end"))
    return (
        uploaded.join(F.broadcast(watermarks), list(PARTITION))
        .where(here)
        .select(*PARTITION, "watermark", (F.col("end") + 1).alias("commit_offset"))
    )


def advance(watermarks: DataFrame, committed: DataFrame) -> DataFrame:
    """Watermarks after a commit."""
    commits = committed.select(*PARTITION, "commit_offset")
    return watermarks.join(commits, list(PARTITION), "left").select(
        *PARTITION, F.coalesce("commit_offset", "watermark").alias("watermark")
    )


def outstanding(
    uploaded: DataFrame, watermarks: DataFrame, assignment: DataFrame | None = None
) -> DataFrame:
    """Uploaded ranges still to be tracked, given the watermarks after the commit.

    What lies below the watermark goes; partitions outside the assignment go too; ranges
    of a partition without a watermark stay.
    """
    if assignment is not None:
        uploaded = uploaded.join(F.broadcast(assignment.select(*PARTITION)), list(PARTITION), "left_semi")
    kept = uploaded.join(F.broadcast(watermarks), list(PARTITION), "left")
    return kept.where(F.col("watermark").isNull() | (F.col("end") >= F.col("watermark"))).select(
        *PARTITION, F.greatest("start", "watermark").alias("start"), "end"
    )


def offset_backlog(tracked: DataFrame) -> DataFrame:
    """Size of the tracking state: eight bytes for each uploaded, uncommitted offset."""
    held = F.coalesce(F.sum(F.col("end") - F.col("start") + 1), F.lit(0))
    return tracked.agg(held.alias("offsets_held"), (held * 8).alias("offsets_size_b"))


def _with_previous(ranges: DataFrame, block: int) -> DataFrame:
    """`previous`, where the range before in the same partition ends, and `start` of disjoint ranges.

    Ranges are ordered within blocks of their starts, and one row per block is ordered
    across blocks.
    """
    blocks = _listed(ranges, [*PARTITION, F.floor(F.col("start") / block).alias("block")])
    after = F.filter("s", lambda _, i: i > 0)
    pairs = F.transform(after, lambda x, i: F.struct(F.get("e", i).alias("previous"), x.alias("start")))
    across = Window.partitionBy(*PARTITION).orderBy("start")
    heads = blocks.select(*PARTITION, F.col("s")[0].alias("start"), F.element_at("e", -1).alias("tail"))
    firsts = heads.select(*PARTITION, F.lag("tail").over(across).alias("previous"), "start")
    inside = blocks.select(*PARTITION, F.explode(pairs).alias("r")).select(*PARTITION, "r.previous", "r.start")
    return inside.unionByName(firsts)


def commit_gaps(uploaded: DataFrame, watermarks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Missing ranges at or above the watermark that hold back later uploaded offsets."""
    tracked = outstanding(uploaded, watermarks)
    gap_start = F.coalesce(F.col("previous") + 1, F.col("watermark"))
    gaps = _with_previous(tracked, block).join(F.broadcast(watermarks), list(PARTITION)).select(
        *PARTITION, gap_start.alias("gap_start"), (F.col("start") - 1).alias("gap_end")
    )
    return gaps.where(F.col("gap_end") >= F.col("gap_start")).withColumn(
        "missing", F.col("gap_end") - F.col("gap_start") + 1
    )


def observed_next(uploaded: DataFrame, consumed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Uploaded ranges with the offsets the source never delivered filled in.

    Compacted topics and transaction markers leave holes that would stall `committable`
    for good. `consumed` are the merged ranges of offsets that were delivered; a hole
    between two of them counts as uploaded.
    """
    holes = (
        _with_previous(consumed, block)
        .where(F.col("previous").isNotNull())
        .select(
            *PARTITION,
            (F.col("previous") + 1).alias("start"),
            (F.col("start") - 1).alias("end"),
        )
    )
    return merge_ranges(uploaded.select(*PARTITION, "start", "end").unionByName(holes), block=block)
