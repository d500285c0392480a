"""Packing streams into files bounded by size and age.

The rule is sequential per (shard, stream): where a file ends depends on where it began.
Streams of ordinary size take one shuffle and one streaming pass. A stream too large for
one task is cut into slices by range; each slice is summarised as a transfer of the state
that enters it, the transfers are chained, and all slices are then packed in parallel with
the state they really get. Both ways give the same files.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.packing import (
    Cursor,
    Cursors,
    Entries,
    SealRules,
    Transfer,
    compose,
    spans,
    transfer,
    walk,
)
from quayside.schema import ARRIVAL_ORDER
from quayside.session import shared_dir

KEYS = ("shard", "stream_id")

# Records of one slice: about 0.4 GB of narrow columns in a Python worker.
SLICE_ROWS = 8_000_000


def seal_rules(df: DataFrame, target_bytes: int, max_age_ms: int | None = None) -> SealRules:
    """Rules whose tick grid starts with the first record of `df`."""
    if max_age_ms is None:
        return SealRules(target_bytes)
    first = df.agg(F.unix_micros(F.min(F.col("timestamp").cast("timestamp")))).first()[0]
    return SealRules(target_bytes, max_age_ms, first or 0)


def lane(shards: int = 1, segment_offsets: int | Column | None = None) -> Column:
    """The `shard` column: which packing instance a record belongs to.

    `shards` instances share the topic partitions. With `segment_offsets` an instance also
    restarts, closing its files, each time a partition passes that many offsets. Lanes
    depend on the record alone, so they are the same in every rerun, and no lane holds
    more than that many records of one topic partition.
    """
    shard = F.pmod(F.col("partition"), F.lit(shards)).cast("bigint")
    if segment_offsets is None:
        return shard
    return shard + F.floor(F.col("offset") / segment_offsets) * shards


def arrival_columns(df: DataFrame) -> list[str]:
    """Columns to sort by: time, then `arrival_seq` if present, else the record's address."""
    return ["t", "arrival_seq"] if "arrival_seq" in df.columns else ["t", *ARRIVAL_ORDER[1:]]


def narrow(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """What packing needs of a record, without its bytes."""
    wide = df.withColumn("t", F.unix_micros(F.col("timestamp").cast("timestamp")))
    if "shard" not in df.columns:
        wide = wide.withColumn("shard", F.lit(0).cast("bigint"))
    names = [*KEYS, *arrival_columns(df), "line_bytes"]
    return wide.select(*names, *[c for c in extra if c not in names])


def group_starts(batch: pa.RecordBatch | pa.Table, keys: Sequence[str] = KEYS) -> np.ndarray:
    """Row numbers where a new key begins, and the row count at the end."""
    n = batch.num_rows
    changed = np.zeros(max(n - 1, 0), dtype=bool)
    for key in keys:
        column = batch.column(key)
        changed |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [n]])


def _identity(batch: pa.RecordBatch, row: int) -> str:
    return f"{batch.column('shard')[row].as_py()}|{batch.column('stream_id')[row].as_py()}"


class _Packer:
    """Feeds sorted batches through `spans`, one stream after the other."""

    def __init__(self, rules: SealRules, stream: str | None = None, at: Cursor = Cursor()):
        self.rules, self.stream, self.at = rules, stream, at

    def feed(self, batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
        t = batch.column("t").to_numpy(zero_copy_only=False)
        size = batch.column("line_bytes").to_numpy(zero_copy_only=False)
        starts = group_starts(batch)
        for lo, hi in zip(starts[:-1], starts[1:]):
            stream = _identity(batch, lo)
            if stream != self.stream:
                self.stream, self.at = stream, Cursor()
            found, self.at = spans(t[lo:hi], size[lo:hi], self.at, self.rules)
            yield lo, found


def _number_records(packer: _Packer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            seq = np.empty(batch.num_rows, "i8")
            for lo, found in packer.feed(batch):
                for s in found:
                    seq[lo + s.start : lo + s.stop] = s.seq
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(seq)], names=[*batch.schema.names, "file_seq"]
            )


_FILES = (
    "shard BIGINT, stream_id STRING, file_seq BIGINT, record_count BIGINT, line_count BIGINT, "
    "raw_size_b BIGINT, created_us BIGINT, seal_reason STRING, sealed_us BIGINT"
)


def _describe_files(packer: _Packer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_FILES`, one for each piece of a file that lies in one batch."""
    names = [c.split()[0] for c in _FILES.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column("line_bytes").to_numpy(zero_copy_only=False)
        lines, done = np.cumsum(size > 0), np.cumsum(size)
        upto = lambda sums, i: int(sums[i - 1]) if i else 0
        rows = []
        for lo, found in packer.feed(batch):
            shard, stream = batch.column("shard")[lo].as_py(), batch.column("stream_id")[lo].as_py()
            for s in found:
                a, b = lo + s.start, lo + s.stop
                counted = (b - a, upto(lines, b) - upto(lines, a), upto(done, b) - upto(done, a))
                rows.append((shard, stream, s.seq, *counted, s.created, s.reason, s.sealed_us))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, pa.string() if n in ("stream_id", "seal_reason") else pa.int64())
                for n, c in zip(names, columns)
            ],
            names=names,
        )


def _whole_streams(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, *order)


# Transfers as rows: kind 0 is the slice itself, 1 its size entries, 2 its age entries.
_TRANSFERS = (
    "slice INT, kind INT, at BIGINT, pos BIGINT, open BOOLEAN, filled BIGINT, created BIGINT, "
    "files BIGINT, first STRING, last STRING, opens_us BIGINT"
)
_STATES = "slice INT, stream STRING, open BOOLEAN, filled BIGINT, created BIGINT, files BIGINT"


def _transfer_batches(index: int, x: Transfer) -> Iterator[pa.RecordBatch]:
    head = Entries(np.array([x.total]), np.array([x.rows]), Cursors.of(x.fresh))
    for kind, e in enumerate([head, x.size, x.age]):
        if e is None or not len(e.at):
            continue
        n, named = len(e.at), kind == 0
        columns = [
            pa.array(np.full(n, index, "i4")),
            pa.array(np.full(n, kind, "i4")),
            *(pa.array(c) for c in (e.at, e.pos, e.exit.open, e.exit.filled, e.exit.created, e.exit.files)),
            pa.array([x.first if named else None] * n, pa.string()),
            pa.array([x.last if named else None] * n, pa.string()),
            pa.array([x.opens_us if named else None] * n, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _TRANSFERS.split(", ")])


def _summarise_slice(rules: SealRules, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transfer of the slice in this partition, from the records of its last stream."""
    first = last = None
    t, size = [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        lo = int(group_starts(batch)[-2])
        index, first = batch.column("slice")[0].as_py(), first or _identity(batch, 0)
        if lo or _identity(batch, lo) != last:
            t, size, last = [], [], _identity(batch, lo)
        t.append(batch.column("t").to_numpy(zero_copy_only=False)[lo:])
        size.append(batch.column("line_bytes").to_numpy(zero_copy_only=False)[lo:])
    if first is not None:
        x = transfer(first, last, np.concatenate(t), np.concatenate(size), rules)
        yield from _transfer_batches(index, x)


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Transfer]]:
    """Reads rows sorted by (block, slice, kind, pos) back as (block, slice, Transfer)."""

    def build(block, index, parts):
        rows = {k: pa.Table.from_batches(v) for k, v in parts.items()}

        def entries(kind):
            if kind not in rows:
                return Entries(np.zeros(0, "i8"), np.zeros(0, "i8"), Cursors.of())
            c = {n: rows[kind].column(n).to_numpy() for n in ("at", "pos", "open", "filled", "created", "files")}
            return Entries(c["at"], c["pos"], Cursors(c["open"].astype(bool), c["filled"], c["created"], c["files"]))

        head, meta = entries(0), rows[0].slice(0, 1).to_pylist()[0]
        x = Transfer(
            meta["first"], meta["last"], int(head.pos[0]), int(head.at[0]), meta["opens_us"], head.exit.one()
        )
        if x.single:
            x.size, x.age = entries(1), entries(2)
        return block, index, x

    held, parts = None, {}
    for batch in batches:
        starts = group_starts(batch, ("block", "slice", "kind")) if batch.num_rows else [0]
        for lo, hi in zip(starts[:-1], starts[1:]):
            block, index, kind = (batch.column(c)[lo].as_py() for c in ("block", "slice", "kind"))
            if held not in (None, (block, index)):
                yield build(*held, parts)
                parts = {}
            held = (block, index)
            parts.setdefault(kind, []).append(batch.slice(lo, hi - lo))
    if held is not None:
        yield build(*held, parts)


def _by_block(items: Iterator[tuple[int, int, Transfer]]) -> Iterator[tuple[int, Iterator]]:
    for block, group in groupby(items, key=lambda item: item[0]):
        yield block, ((index, x) for _, index, x in group)


def _chained(tables: DataFrame, slices: int, rules: SealRules) -> DataFrame:
    """The state that enters each slice, from the transfers of all slices.

    Two levels: blocks of about sqrt(slices) slices are composed in parallel, the block
    transfers are walked in order, then each block is walked from the state it gets. No
    task holds more than one transfer or reads more than about sqrt(slices) of them.
    """
    width = isqrt(slices) + 1

    def sorted_by_block(df: DataFrame) -> DataFrame:
        return df.repartition("block").sortWithinPartitions("block", "slice", "kind", "pos")

    def compose_blocks(batches):
        for block, items in _by_block(_transfers(batches)):
            yield from _transfer_batches(block, compose((x for _, x in items), rules))

    def state_batch(rows):
        columns = list(zip(*((i, stream, *at) for i, stream, at in rows)))
        kinds = (pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=[c.split()[0] for c in _STATES.split(", ")],
        )

    def walk_blocks(batches):
        for _, items in _by_block(_transfers(batches)):
            yield state_batch(walk(items, rules, None, Cursor()))

    blocked = sorted_by_block(tables.withColumn("block", F.floor(F.col("slice") / width).cast("int")))
    blocks = blocked.mapInArrow(compose_blocks, _TRANSFERS)
    top = sorted_by_block(blocks.withColumn("block", F.lit(0))).mapInArrow(walk_blocks, _STATES)
    # One state per block: about sqrt(slices) rows.
    entering = {r.slice: (r.stream, Cursor(r.open, r.filled, r.created, r.files)) for r in top.collect()}

    def walk_slices(batches):
        for block, items in _by_block(_transfers(batches)):
            yield state_batch(walk(items, rules, *entering[block]))

    return blocked.mapInArrow(walk_slices, _STATES)


def _seal(rows: DataFrame, order: Sequence[str], rules: SealRules, emit, schema: str, slice_rows: int) -> DataFrame:
    """Runs `emit` over the streams in arrival order, in as many slices as their size asks for.

    Stream sizes come from an aggregate that combines before its shuffle. Only rows that are
    cut into slices, and so read several times, are written out.
    """
    sizes = rows.groupBy(*KEYS).count().agg(F.max("count").alias("largest"), F.sum("count").alias("all"))
    largest, total = sizes.first()
    if (largest or 0) <= slice_rows:
        return _whole_streams(rows, order).mapInArrow(lambda it: emit(_Packer(rules), it), schema)

    shared_dir(rows.sparkSession)
    count = ceil(total / slice_rows)
    # Range bounds come from a sample, so the slices are fixed before they are read twice.
    slices = (
        rows.repartitionByRange(count, *KEYS, *order)
        .sortWithinPartitions(*KEYS, *order)
        .withColumn("slice", F.spark_partition_id())
        .checkpoint()
    )
    tables = slices.mapInArrow(lambda it: _summarise_slice(rules, it), _TRANSFERS).checkpoint()
    # One small row per slice of `slice_rows` records.
    states = {
        r.slice: (r.stream, Cursor(r.open, r.filled, r.created, r.files))
        for r in _chained(tables, count, rules).collect()
    }
    shared = rows.sparkSession.sparkContext.broadcast(states)

    def pack(batches):
        packer = None
        for batch in batches:
            if batch.num_rows:
                packer = packer or _Packer(rules, *shared.value[batch.column("slice")[0].as_py()])
                yield from emit(packer, [batch.drop_columns(["slice"])])

    return slices.mapInArrow(pack, schema)


def assign_files(
    routed: DataFrame, rules: SealRules, extra: Sequence[str] = (), slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Each record with the number of its file: narrow columns, `extra` ones and `file_seq`."""
    rows = narrow(routed, extra)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return _seal(
        rows, arrival_columns(routed), rules, _number_records, f"{schema}, file_seq BIGINT", slice_rows
    )


def plan_files(
    routed: DataFrame,
    rules: SealRules,
    finalize: bool = True,
    now_us: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per file: counts, bytes, creation and seal time and the reason it was sealed.

    The last file of a stream is sealed as `final`, or left `open` with `finalize=False`
    unless a tick up to `now_us` finds it old enough.
    """
    pieces = _seal(narrow(routed), arrival_columns(routed), rules, _describe_files, _FILES, slice_rows)
    files = pieces.groupBy(*KEYS, "file_seq").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("line_count").alias("line_count"),
        F.sum("raw_size_b").alias("raw_size_b"),
        F.min("created_us").alias("created_us"),
        F.max("seal_reason").alias("seal_reason"),
        F.max("sealed_us").alias("sealed_us"),
    )
    if finalize:
        return files.withColumn("seal_reason", F.coalesce("seal_reason", F.lit("final")))
    if now_us is None or rules.max_age_ms is None:
        return files.withColumn("seal_reason", F.coalesce("seal_reason", F.lit("open")))
    due = due_us(F.col("created_us"), rules)
    aged = F.col("seal_reason").isNull() & (due <= now_us)
    return files.withColumns(
        {
            "sealed_us": F.when(aged, due).otherwise(F.col("sealed_us")),
            "seal_reason": F.when(aged, "dormant").otherwise(F.coalesce("seal_reason", F.lit("open"))),
        }
    )


def in_full_files(planned: DataFrame, rules: SealRules) -> DataFrame:
    """The rows of `assign_files` whose file reached the target.

    Summed over each file's own rows, so that the packing pass below runs once.
    """
    written = F.sum("line_bytes").over(Window.partitionBy(*KEYS, "file_seq"))
    return planned.withColumn("raw_size_b", written).where(F.col("raw_size_b") >= rules.target_bytes).drop("raw_size_b")


def due_us(created_us: Column, rules: SealRules) -> Column:
    """First tick at which a file created then is old enough."""
    age = created_us + rules.max_age_ms * 1000 - rules.t0_us
    ticks = -F.floor(-age / rules.tick_us)
    return F.lit(rules.t0_us) + ticks * rules.tick_us
