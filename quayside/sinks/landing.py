"""Landing: zstd JSON lines files, one stream per file, and the ledger that describes them.

One pass over the records packs, compresses, stores and accounts. Its output rows are the
ledger of the batch, written by the executors: a manifest row for each file and the
undecodable or unconfigured records. Files that no ledger row names are not part of the
landed data: readers go by the ledger, so what a failed batch left behind is not read.

Everything a job writes is below its run id, and it overwrites only what itself wrote: many
jobs can land under one path, at a time or one after the other.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.functions import decode as d
from quayside.functions.envelope import envelope_line
from quayside.functions.keys import landed_key, landed_suffix
from quayside.functions.metrics import ratio_text
from quayside.functions.routing import stream_id
from quayside.operators.packing import Cursor, SealRules, spans
from quayside.operators.records import judge
from quayside.operators.seal import KEYS, arrival_columns, group_starts, lane
from quayside.operators.topics import assign_config
from quayside.schema import HEADERS, OFFSET_RANGES
from quayside.sinks.objects import is_local, open_store, put

MIB = 1024 * 1024

# Arrow batches are bounded by bytes, since single records can be tens of megabytes. Small
# ones let both sides reuse their memory instead of mapping fresh pages for each batch.
ARROW_BATCH_BYTES = 4 * MIB
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

MANIFEST = (
    f"shard BIGINT, stream_id STRING, file_seq BIGINT, object_key STRING, record_count BIGINT, "
    f"line_count BIGINT, raw_size_b BIGINT, compressed_size_b BIGINT, compression_ratio STRING, "
    f"seal_reason STRING, created_us BIGINT, sealed_us BIGINT, status STRING, "
    f"failed_attempts BIGINT, offsets {OFFSET_RANGES}"
)
_REJECT = (
    "STRUCT<topic: STRING, partition: INT, offset: BIGINT, timestamp: TIMESTAMP, value: BINARY, "
    f"headers: {HEADERS.simpleString()}, error_class: STRING, message: STRING>"
)
LEDGER = f"kind STRING, {MANIFEST}, reject {_REJECT}"
_RANGE = {"topic": pa.string(), "partition": pa.int32(), "start": pa.int64(), "end": pa.int64()}
# What an unfinished file of the previous batch hands on to the next.
_SEED = (
    "STRUCT<object_key: STRING, file_seq: BIGINT, record_count: BIGINT, line_count: BIGINT, "
    f"raw_size_b: BIGINT, created_us: BIGINT, offsets: {OFFSET_RANGES}>"
)


@dataclass(frozen=True)
class LandingOptions:
    """How to land.

    `distribution="keyed"` shuffles records to their (shard, stream); "source" packs each
    input task's records where they are, without a shuffle, as if the task were an
    instance that owns that part of the input. `shards` and `segment_offsets` are those of
    `lane`. Shards spread a stream over instances; segments also end files after so many
    offsets, whatever their size, and are only cut if asked for. Topic configuration may
    then set its own. One single instance, as for small inputs, is `shards=1`.
    """

    target_bytes: int = 50 * MIB
    max_age_ms: int | None = None
    t0_us: int = 0
    compression_level: int = 3
    max_retries: int = 3
    distribution: str = "keyed"
    shards: int = 32
    segment_offsets: int | None = None
    tasks: int | None = None
    on_unknown: str = "quarantine"
    on_error: str = "quarantine"
    escape_keys: bool | None = None

    def __post_init__(self):
        if self.distribution not in ("keyed", "source"):
            raise ValueError("distribution is 'keyed' or 'source'")
        if not {self.on_unknown, self.on_error} <= {"fail", "quarantine"}:
            raise ValueError("on_unknown and on_error are 'fail' or 'quarantine'")

    @property
    def rules(self) -> SealRules:
        return SealRules(self.target_bytes, self.max_age_ms, self.t0_us)


def _blank(kind: str, lists: str) -> F.Column:
    """A struct whose fields are null but for an empty list.

    Before each row Spark asks an Arrow batch for its size, and a list column then goes through all
    rows since its last list that was not null: null structs with lists would make that quadratic.
    """
    return F.from_json(F.lit(f'{{"{lists}": []}}'), kind)


def _rows_to_land(records: DataFrame, config: DataFrame, options: LandingOptions) -> DataFrame:
    """Everything the pass needs of a record. `reject` and `seed` are blank where there is none.

    One projection above the judged records: each further one would copy the value.
    """
    value, decoder, headers = F.col("value"), F.col("decoder"), F.col("headers")
    outcome = F.col("outcome")
    unknown = decoder.isNull()
    undecodable = ~unknown & (outcome == "decode_error")
    rejected = unknown | undecodable
    line = envelope_line(d.body(value, decoder), headers, "\n")
    message = F.when(
        unknown, F.concat(F.lit("missing topic configuration for '"), "topic", F.lit("'"))
    ).otherwise(d.error_message(F.col("topic"), F.col("partition"), F.col("offset"), decoder))
    fails = (unknown & F.lit(options.on_unknown == "fail")) | (
        undecodable & F.lit(options.on_error == "fail")
    )
    reject = F.struct(
        "topic",
        "partition",
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        "value",
        "headers",
        F.when(unknown, "Configuration").otherwise("Serialization").alias("error_class"),
        F.when(fails, F.raise_error(message)).otherwise(message).alias("message"),
    )
    segment = F.lit(options.segment_offsets)
    if options.segment_offsets is not None and "segment_offsets" in config.columns:
        segment = F.coalesce("segment_offsets", segment)
    shard = lane(options.shards, None if options.segment_offsets is None else segment)
    if options.distribution == "source":
        shard = F.spark_partition_id().cast("bigint")
    # Rejected records belong to no stream; they need no order and are spread evenly.
    scattered = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(4096))
    return judge(assign_config(records, config)).select(
        shard.alias("shard"),
        F.when(~rejected, stream_id(F.col("router"), F.col("topic"), headers)).alias("stream_id"),
        F.when(rejected, scattered).otherwise(F.lit(0)).alias("spread"),
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("t"),
        *[c for c in arrival_columns(records) if c not in ("t", "topic", "partition", "offset")],
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.when(~unknown & (outcome == "ok"), line).alias("payload"),
        F.when(rejected, reject).otherwise(_blank(_REJECT, "headers")).alias("reject"),
        _blank(_SEED, "offsets").alias("seed"),
    )


def _seeds(opened: DataFrame, columns: list[str], like: DataFrame) -> DataFrame:
    fields = ("object_key", "file_seq", "record_count", "line_count", "raw_size_b", "created_us", "offsets")
    filled = {"shard": F.col("shard"), "stream_id": F.col("stream_id"), "spread": F.lit(0).cast("bigint")}
    filled["t"] = F.col("created_us")
    filled["seed"] = F.struct(*fields).cast(_SEED)
    types = dict(like.dtypes)
    return opened.select(
        *[filled.get(c, F.lit(None)).cast(types[c]).alias(c) for c in columns]
    )


def object_metadata(lines: int, raw: int, compressed: int) -> dict[str, str]:
    """What an object says of itself."""
    # The names.
    return {
        "record_count": str(lines),
        "raw_size_bytes": str(raw),
        "compression_ratio": ratio_text(raw, compressed),
    }


Range = tuple[str, int, int, int]


def merged(ranges: Iterable[Range]) -> list[Range]:
    """Union of inclusive ranges `(topic, partition, first, last)`, in order."""
    out: list[Range] = []
    for topic, partition, first, last in sorted(ranges):
        if out and out[-1][:2] == (topic, partition) and first <= out[-1][3] + 1:
            out[-1] = (topic, partition, out[-1][2], max(last, out[-1][3]))
        else:
            out.append((topic, partition, first, last))
    return out


class _OpenFile:
    """Contents and bookkeeping of the file being filled."""

    def __init__(self, compressor: zstandard.ZstdCompressor):
        # A compressor is costly to set up: small files share that of their task.
        self.compressor = compressor
        self.buffer = io.BytesIO()
        self.writer = None
        self.records = self.lines = self.raw = 0
        self.topics: dict[str, int] = {}
        self.addresses: list[np.ndarray] = []
        self.offsets: list[np.ndarray] = []
        self.ranges: list[dict] = []

    def write(self, lines: memoryview, count: int) -> None:
        if self.writer is None:
            self.writer = self.compressor.stream_writer(self.buffer, closefd=False)
        self.writer.write(lines)
        self.lines += count
        self.raw += len(lines)

    def resume(self, seed: dict, content: bytes) -> None:
        """Takes over an unfinished file: its frames stay, new lines go into a new frame."""
        self.buffer.write(content)
        self.records, self.lines, self.raw = (seed[k] for k in ("record_count", "line_count", "raw_size_b"))
        self.ranges = seed["offsets"] or []

    def add_offsets(self, topics: list[str], codes: np.ndarray, partitions: np.ndarray, offsets: np.ndarray):
        self.records += len(offsets)
        number = lambda code: self.topics.setdefault(topics[code], len(self.topics))
        first = int(codes[0])
        if (codes == first).all():
            own = np.int64(number(first))
        else:
            used, place = np.unique(codes, return_inverse=True)
            own = np.array([number(c) for c in used.tolist()], "i8")[place]
        self.addresses.append(own << 32 | partitions)
        self.offsets.append(offsets.copy())

    def finish(self) -> bytes:
        if self.writer is not None:
            self.writer.close()
            self.writer = None
        return self.buffer.getvalue()

    def offset_ranges(self) -> list[Range]:
        """Ranges of the file's offsets, in order; all topic partitions are sorted at once."""
        found: list[Range] = []
        if self.offsets:
            address, offset = np.concatenate(self.addresses), np.concatenate(self.offsets)
            order = np.lexsort((offset, address))
            address, offset = address[order], offset[order]
            fresh = (address[1:] != address[:-1]) | (offset[1:] - offset[:-1] > 1)
            cut = np.flatnonzero(fresh) + 1
            starts, ends = np.append(0, cut), np.append(cut, len(offset)) - 1
            names = list(self.topics)
            for a, start, end in zip(address[starts].tolist(), offset[starts].tolist(), offset[ends].tolist()):
                found.append((names[a >> 32], a & 0xFFFFFFFF, start, end))
        held = [(r["topic"], r["partition"], r["start"], r["end"]) for r in self.ranges]
        return merged(found + held) if held else sorted(found)


def _range_lists(lists: list[list[Range]]) -> pa.Array:
    """The `offsets` column: a list of ranges for each file."""
    fields = zip(*[r for ranges in lists for r in ranges]) if any(lists) else [()] * len(_RANGE)
    flat = [pa.array(f, t) for f, t in zip(fields, _RANGE.values())]
    bounds = np.cumsum([0, *map(len, lists)], dtype="i4")
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(flat, list(_RANGE)))


class _Lander:
    """Packs sorted rows of one task into files; yields ledger batches."""

    def __init__(self, path: str, run_id: str, batch_id: int, sealed_us: int, options: LandingOptions, finalize: bool, now_us: int | None, schema: pa.Schema):
        self.store, root = open_store(path)
        self.root, self.run_id, self.batch_id, self.sealed_us = root, run_id, batch_id, sealed_us
        self.options, self.rules, self.schema = options, options.rules, schema
        self.finalize, self.now_us = finalize, now_us
        self.escape = is_local(path) if options.escape_keys is None else options.escape_keys
        self.key, self.at, self.file = None, Cursor(), None
        self.compressor = zstandard.ZstdCompressor(level=options.compression_level)
        self.rows: list[dict] = []

    def run(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = pc.struct_field(batch.column("reject"), "error_class").is_valid()
            if rejected.true_count:
                yield self._ledger({"kind": ["reject"] * rejected.true_count, "reject": batch.column("reject").filter(rejected)})
                batch = batch.filter(pc.invert(rejected))
            if batch.num_rows:
                self._take(batch)
            if self.rows:
                yield self._flush()
        self._leave()
        if self.rows:
            yield self._flush()

    def _take(self, batch: pa.RecordBatch) -> None:
        payload = batch.column("payload")
        kind = "i8" if pa.types.is_large_binary(payload.type) else "i4"
        _, bounds, data = payload.buffers()
        bounds = np.frombuffer(bounds, kind)[payload.offset : payload.offset + len(payload) + 1].astype("i8")
        data = memoryview(data) if data is not None else memoryview(b"")
        size = np.diff(bounds)
        t = batch.column("t").to_numpy(zero_copy_only=False)
        topics = batch.column("topic").dictionary_encode()
        codes = topics.indices.fill_null(0).to_numpy(zero_copy_only=False)
        names = topics.dictionary.to_pylist()
        partitions = batch.column("partition").fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
        offsets = batch.column("offset").fill_null(0).to_numpy(zero_copy_only=False)
        seeds = batch.column("seed")
        seeded = pc.struct_field(seeds, "file_seq").is_valid().to_pylist()
        starts = group_starts(batch)
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            key = (batch.column("shard")[lo].as_py(), batch.column("stream_id")[lo].as_py())
            if key != self.key:
                self._leave()
                self.key, self.at = key, Cursor()
            if seeded[lo]:
                self._resume(seeds[lo].as_py())
                lo += 1
            found, self.at = spans(t[lo:hi], size[lo:hi], self.at, self.rules)
            for s in found:
                a, b = lo + s.start, lo + s.stop
                if self.file is None:
                    self.file = _OpenFile(self.compressor)
                if bounds[b] > bounds[a]:
                    self.file.write(data[bounds[a] : bounds[b]], int(np.count_nonzero(size[a:b])))
                if b > a:
                    self.file.add_offsets(names, codes[a:b], partitions[a:b], offsets[a:b])
                if s.reason:
                    self._seal(s.seq, s.created, s.reason, s.sealed_us)

    def _resume(self, seed: dict) -> None:
        self.file = _OpenFile(self.compressor)
        content = b""
        if seed["object_key"]:
            with self.store.open_input_stream(f"{self.root}/open/{seed['object_key']}", compression=None) as source:
                content = source.read()
        self.file.resume(seed, content)
        self.at = Cursor(True, seed["raw_size_b"], seed["created_us"], seed["file_seq"] + 1)

    def _leave(self) -> None:
        """The end of a stream's records: its last file is sealed or stays open."""
        if self.key is None or not self.at.open:
            return
        seq, created = self.at.files - 1, self.at.created
        if self.finalize:
            self._seal(seq, created, "final", None)
        elif self.now_us is not None and (due := int(self.rules.due(np.int64(created)))) <= self.now_us:
            self._seal(seq, created, "dormant", due)
        else:
            self._seal(seq, created, "open", None)

    def _seal(self, seq: int, created: int, reason: str, sealed_us: int | None) -> None:
        file, (shard, stream) = self.file, self.key
        content, name, failed = file.finish(), None, 0
        if file.lines:
            suffix = landed_suffix(stream, self.run_id, self.batch_id, shard, seq)
            if reason == "open":
                folder, name = "open", f"{batch_folder(self.run_id, self.batch_id)}/{suffix}"
            else:
                folder, name = "objects", landed_key(stream, self.sealed_us, suffix, self.escape)
            about = object_metadata(file.lines, file.raw, len(content))
            target = f"{self.root}/{folder}/{name}"
            failed = put(self.store, target, content, self.options.max_retries, metadata=about)
        # A file of skipped records only has no object; its offsets are released all the same.
        status = "open" if reason == "open" else "uploaded" if file.lines else "released"
        self.rows.append(
            {
                "kind": "manifest", "shard": shard, "stream_id": stream, "file_seq": seq,
                "object_key": name, "record_count": file.records, "line_count": file.lines,
                "raw_size_b": file.raw, "compressed_size_b": len(content),
                "compression_ratio": ratio_text(file.raw, len(content)) if file.lines else None,
                "seal_reason": reason, "created_us": created,
                "sealed_us": self.sealed_us if sealed_us is None else sealed_us,
                "status": status, "failed_attempts": failed, "offsets": file.offset_ranges(),
            }
        )
        self.file = None

    def _flush(self) -> pa.RecordBatch:
        columns = {k: [row[k] for row in self.rows] for k in self.rows[0]}
        columns["offsets"] = _range_lists(columns["offsets"])
        n, self.rows = len(self.rows), []
        return self._ledger({**columns, "reject": pa.nulls(n, self.schema.field("reject").type)})

    def _ledger(self, columns: dict) -> pa.RecordBatch:
        n = len(columns["kind"])
        arrays = []
        for f in self.schema:
            c = columns.get(f.name)
            if c is None:
                c = pa.nulls(n, f.type)
            elif isinstance(c, list):
                c = pa.array(c, f.type)
            arrays.append(c if c.type == f.type else c.cast(f.type))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


def land(
    records: DataFrame,
    config: DataFrame,
    path: str,
    options: LandingOptions = LandingOptions(),
    batch_id: int = 0,
    sealed_us: int | None = None,
    finalize: bool = True,
    now_us: int | None = None,
    opened: DataFrame | None = None,
    run_id: str | None = None,
    arrived_us: int | None = None,
) -> str:
    """Lands one batch under `path` and returns its run id.

    A job without `run_id` gets a new one, so it never replaces what another job landed. To
    repeat a batch, give the same `run_id`, `batch_id` and `sealed_us` (which names the
    objects). With `finalize=False` the last file of a stream stays open unless `now_us`
    finds it old enough, and `opened` (the open manifest rows of the batch before) is carried
    on. Ages count from the records' timestamps, or from `arrived_us` if that is given.
    """
    spark = records.sparkSession
    run_id = uuid.uuid4().hex if run_id is None else run_id
    folder = batch_folder(run_id, batch_id)
    if sealed_us is None:
        sealed_us = spark.sql("SELECT unix_micros(current_timestamp())").first()[0]
    rows = _rows_to_land(records, config, options)
    if opened is not None:
        if options.distribution != "keyed":
            raise ValueError("open files are carried only with distribution='keyed'")
        rows = rows.unionByName(_seeds(opened, rows.columns, rows))
    keys = [*KEYS, "spread"]
    if options.distribution == "keyed":
        rows = rows.repartition(options.tasks, *keys) if options.tasks else rows.repartition(*keys)
    # The carried file of a stream comes before its records.
    rows = rows.sortWithinPartitions(
        *keys, F.col("seed.file_seq").isNull(), *arrival_columns(records)
    ).drop("spread")
    if arrived_us is not None:
        rows = rows.withColumn("t", F.lit(arrived_us).cast("bigint"))
    schema = to_arrow_schema(spark.createDataFrame([], LEDGER).schema)

    def pack(batches):
        return _Lander(path, run_id, batch_id, sealed_us, options, finalize, now_us, schema).run(batches)

    ledger = rows.mapInArrow(pack, LEDGER)
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(ARROW_BATCH_BYTES))
    try:
        writer = ledger.write.mode("overwrite").partitionBy("kind")
        writer.parquet(f"{path}/ledger/{folder}")
    finally:
        spark.conf.set(_BATCH_BYTES, before)
    return run_id


def batch_folder(run_id: str, batch_id: int) -> str:
    """Where a batch of a run keeps its rows, below a folder of the landing path."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError("a run id is made of letters, digits, '_' and '-'")
    return f"run_id={run_id}/batch_id={batch_id}"


def _ledger(spark: SparkSession, path: str, batch_id: int | None, run_id: str | None) -> DataFrame:
    schema = f"{LEDGER}, run_id STRING, batch_id BIGINT"
    reader = spark.read.schema(schema).option("basePath", f"{path}/ledger")
    if run_id is not None and batch_id is not None:
        return reader.parquet(f"{path}/ledger/{batch_folder(run_id, batch_id)}")
    found = reader.parquet(f"{path}/ledger")
    wanted = {"run_id": run_id, "batch_id": batch_id}
    for name, value in wanted.items():
        found = found if value is None else found.where(F.col(name) == value)
    return found


def manifest(spark: SparkSession, path: str, batch_id: int | None = None, run_id: str | None = None) -> DataFrame:
    """A row for each landed file, of all runs and batches or some."""
    columns = [c.strip().split(" ")[0] for c in MANIFEST.replace(OFFSET_RANGES, "X").split(",")]
    rows = _ledger(spark, path, batch_id, run_id).where("kind = 'manifest'")
    return rows.select("run_id", "batch_id", *columns)


def quarantined(spark: SparkSession, path: str, batch_id: int | None = None, run_id: str | None = None) -> DataFrame:
    """Rejected records with the reason, of all runs and batches or some."""
    rows = _ledger(spark, path, batch_id, run_id).where("kind = 'reject'")
    return rows.select("run_id", "batch_id", "reject.*")


def vacuum(spark: SparkSession, path: str, before_us: int) -> int:
    """Removes objects that no ledger row names and that were written before then; their number.

    A running batch has objects that its ledger does not name yet, so `before_us` must lie before
    the start of every batch that still runs. Spark lists the folder, without reading contents,
    and the executors delete. Names that begin with a dot or an underscore are left alone.
    """
    store, root = open_store(path)
    if store.get_file_info(f"{root}/objects").type == fs.FileType.NotFound:
        return 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/objects")
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    old = files.where(F.unix_micros("modificationTime") < before_us)
    old = old.select(F.substr("path", F.lit(len(folder) + 2)).alias("object_key"))
    named = manifest(spark, path).where("status = 'uploaded'").select("object_key")

    def remove(batches):
        store, root = open_store(path)
        for batch in batches:
            for key in batch["object_key"].to_pylist():
                # A task that runs again finds some gone already.
                if store.get_file_info(f"{root}/objects/{key}").type != fs.FileType.NotFound:
                    store.delete_file(f"{root}/objects/{key}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["removed"])

    removed = old.join(named, "object_key", "left_anti").mapInArrow(remove, "removed BIGINT")
    return removed.agg(F.coalesce(F.sum("removed"), F.lit(0))).first()[0]


def write_quarantine(errors: DataFrame, path: str) -> None:
    """Appends rejected records of a job of one's own."""
    errors.write.mode("append").parquet(path)


def write_partitioned(processed: DataFrame, path: str, codec: str = "gzip") -> None:
    """Lines in plain Spark text files: stream and day as folders, no packing, no Python.

    Rows are brought together per folder, and folders too large for a task are split.
    """
    written = processed.where(F.col("outcome") == "ok").select(
        F.array_join(F.split("stream_id", "\x1f"), "/").alias("stream"),
        F.to_date(F.timestamp_micros(F.unix_micros(F.col("timestamp").cast("timestamp")))).alias(
            "ingest_year_month_day"
        ),
        F.col("line").cast("string").alias("value"),
    )
    folders = ("stream", "ingest_year_month_day")
    (
        written.hint("rebalance", *folders)
        .write.mode("append")
        .partitionBy(*folders)
        .option("compression", codec)
        .text(path)
    )


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Lines of `write_partitioned` with their stream and day."""
    schema = "value STRING, stream STRING, ingest_year_month_day DATE"
    return spark.read.schema(schema).text(path).withColumnRenamed("value", "line")
