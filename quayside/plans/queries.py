"""The registered queries: each operator applied to whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from quayside.functions.headers import header_value
from quayside.functions.keys import object_key, object_prefix
from quayside.functions.metrics import compression_ratio
from quayside.functions.routing import (
    SCHEMA_NAME_HEADER,
    SCHEMA_VERSION_HEADER,
    STATUS_CODE_HEADER,
    UNKNOWN_SCHEMA_NAME,
    UNKNOWN_SCHEMA_VERSION,
    UNKNOWN_STATUS_CODE,
    stream_parts,
)
from quayside.operators import lifecycle, offsets, stats
from quayside.operators.packing import SealRules
from quayside.operators.records import consumed, decode, decode_errors, dropped_headers, envelope, process, route
from quayside.operators.seal import assign_files, in_full_files, lane, plan_files, seal_rules
from quayside.operators.topics import assign_config, unconfigured
from quayside.schema import RECORD
from quayside.session import work_dir
from quayside.sinks.landing import (
    LandingOptions,
    land,
    manifest,
    quarantined,
    read_partitioned,
    write_partitioned,
)
from quayside.sinks.snapshots import landed_files, write_snapshot
from quayside.sources.landed import read_landed
from quayside.sources.records import read_record_file_stream
from quayside.sources.replay import replay_config, replay_events
from quayside.streaming.landing import commit_log, drain, start_landing
from quayside.streaming.offset_log import append_offsets, offsets_after
from quayside.streaming.open_files import drain_open_files, start_open_files
from quayside.streaming.reports import RunReport, run_reports

TARGET = 1000
MAX_AGE_MS = 86_400_000
DAY = 86_400.0
BATCHES = 3
STEPS = 10


def _us(name: str) -> F.Column:
    return F.unix_micros(name).alias(f"{name}_us")


def _processed(spark: SparkSession, sf_dir: str, offsets: bool = False) -> DataFrame:
    return process(replay_events(spark, sf_dir, offsets), replay_config(spark))


def _consumed(spark: SparkSession, sf_dir: str, offsets: bool = False) -> DataFrame:
    return consumed(_processed(spark, sf_dir, offsets))


# --- records -----------------------------------------------------------------------------


def records_scan(spark, sf_dir):
    return replay_events(spark, sf_dir, offsets=True).select(
        "topic",
        "partition",
        "offset",
        "arrival_seq",
        F.octet_length("value").alias("value_bytes"),
        F.size("headers").alias("header_count"),
    )


def topic_assign(spark, sf_dir):
    assigned = assign_config(replay_events(spark, sf_dir), replay_config(spark, ("topic-signup",)))
    return assigned.select("arrival_seq", "topic", "decoder", "router")


def unknown_topics(spark, sf_dir):
    config = replay_config(spark, without=("topic-signup",))
    return unconfigured(replay_events(spark, sf_dir), config).select("arrival_seq", "topic")


def decode_outcomes(spark, sf_dir):
    decoded = decode(assign_config(replay_events(spark, sf_dir), replay_config(spark)))
    return decoded.select("arrival_seq", "outcome", F.col("body").cast("string").alias("body"))


def decode_error_rows(spark, sf_dir):
    decoded = decode(assign_config(replay_events(spark, sf_dir, True), replay_config(spark)))
    return decode_errors(decoded).select("topic", "partition", "offset", "message")


def header_lookup(spark, sf_dir):
    def looked_up(key, default):
        return F.coalesce(header_value(F.col("headers"), key), F.lit(default)).alias(key)

    return replay_events(spark, sf_dir).select(
        "arrival_seq",
        looked_up(SCHEMA_NAME_HEADER, UNKNOWN_SCHEMA_NAME),
        looked_up(SCHEMA_VERSION_HEADER, UNKNOWN_SCHEMA_VERSION),
        looked_up(STATUS_CODE_HEADER, UNKNOWN_STATUS_CODE),
    )


def _routed_by(router):
    def query(spark, sf_dir):
        assigned = assign_config(replay_events(spark, sf_dir), replay_config(spark))
        return route(assigned.where(F.col("router") == router)).select("arrival_seq", "stream_id")

    return query


def header_audit(spark, sf_dir):
    """Conversation texts as header values: which would be dropped from an envelope."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    header = F.struct(F.col("role").alias("key"), F.col("text").cast("binary").alias("value"))
    records = turns.select("conv_id", "turn", F.array(header).alias("headers"))
    return dropped_headers(records).select(
        "conv_id", "turn", F.col("header.key").alias("key"), "reason"
    )


def envelope_lines(spark, sf_dir):
    return (
        _processed(spark, sf_dir)
        .where("outcome = 'ok'")
        .select(
            "arrival_seq",
            F.col("line").cast("string").alias("line"),
            F.contains(F.col("body").cast("string"), F.lit("\n")).alias("has_newline"),
        )
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plain records; schema name and version are source and language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    header = lambda key, name: F.struct(
        F.lit(key).alias("key"), F.col(name).cast("binary").alias("value")
    )
    records = docs.select(
        F.lit("documents").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.col("doc_id").alias("arrival_seq"),
        F.timestamp_micros("doc_id").alias("timestamp"),
        F.col("text").cast("binary").alias("value"),
        F.array(header("schema_name", "source"), header("schema_version", "lang")).alias("headers"),
        F.lit("string").alias("decoder"),
        F.lit("topic_version").alias("router"),
    )
    return envelope(route(decode(records)))


def document_envelopes(spark, sf_dir):
    """Large bodies, spliced verbatim: newlines in them break the one-line form."""
    return _documents(spark, sf_dir).select(
        F.col("arrival_seq").alias("doc_id"),
        "stream_id",
        "line_bytes",
        F.col("line").cast("string").alias("line"),
        F.contains(F.col("body").cast("string"), F.lit("\n")).alias("has_newline"),
    )


def object_prefixes(spark, sf_dir):
    catalog = stats.stream_catalog(_consumed(spark, sf_dir)).select("stream_id")
    return catalog.select("stream_id", object_prefix(stream_parts(F.col("stream_id"))).alias("prefix"))


def object_keys(spark, sf_dir):
    """Keys of one file per stream, sealed at the last arrival; suffix by hash of the stream."""
    last = _consumed(spark, sf_dir).groupBy("stream_id").agg(F.max("timestamp").alias("at"))
    suffix = F.substring(F.sha2("stream_id", 256), 1, 8)
    key = object_key(stream_parts(F.col("stream_id")), F.col("at"), suffix)
    return last.select("stream_id", key.alias("object_key"))


def ratio_texts(spark, sf_dir):
    """Ratio texts of order totals taken as sizes, in cents against whole units."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    raw = F.round(F.col("o_totalprice") * 100).cast("bigint")
    compressed = F.col("o_custkey") * 10_000
    return orders.select("o_orderkey", compression_ratio(raw, compressed).alias("ratio"))


# --- aggregates --------------------------------------------------------------------------


def stream_totals(spark, sf_dir):
    totals = stats.stream_totals(_consumed(spark, sf_dir))
    return totals.select("*", _us("first_arrival")).drop("first_arrival")


def stream_catalog(spark, sf_dir):
    return stats.stream_catalog(_consumed(spark, sf_dir))


def stream_partitions(spark, sf_dir):
    return stats.stream_partitions(_consumed(spark, sf_dir, offsets=True))


def initial_watermarks(spark, sf_dir):
    return stats.initial_watermarks(replay_events(spark, sf_dir, offsets=True))


def window_stats(spark, sf_dir):
    report = stats.window_stats(_consumed(spark, sf_dir), "1 day", DAY)
    return report.select("*", _us("window_start")).drop("window_start")


def order_windows(spark, sf_dir):
    """Order volume per reporting window of 30 days, with rates."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.floor("o_totalprice").alias("line_bytes"),
    )
    report = stats.window_stats(orders, "30 days", 30 * DAY)
    return report.select("*", _us("window_start")).drop("window_start")


def run_stats(spark, sf_dir):
    records = _consumed(spark, sf_dir)
    files = plan_files(records, seal_rules(records, TARGET, MAX_AGE_MS)).withColumn(
        "status", F.lit("uploaded")
    )
    first, last = records.agg(F.min("timestamp"), F.max("timestamp")).first()
    return stats.run_stats(files, F.lit(first), F.lit(last))


def window_file_stats(spark, sf_dir):
    files = plan_files(_consumed(spark, sf_dir), SealRules(TARGET)).where("seal_reason = 'size'")
    report = stats.window_file_stats(files.withColumn("status", F.lit("uploaded")), "1 day", DAY)
    return report.select("*", _us("window_start")).drop("window_start")


# --- sealing -----------------------------------------------------------------------------


def size_seal(spark, sf_dir):
    return plan_files(_consumed(spark, sf_dir), SealRules(TARGET))


def age_seal(spark, sf_dir):
    records = _consumed(spark, sf_dir)
    return plan_files(records, seal_rules(records, TARGET, MAX_AGE_MS))


def size_seal_sharded(spark, sf_dir):
    lanes = _consumed(spark, sf_dir, offsets=True).withColumn("shard", lane(2, 150))
    return plan_files(lanes, SealRules(TARGET))


def size_seal_sliced(spark, sf_dir):
    """One single stream of all records, cut into slices that are packed in parallel."""
    records = _consumed(spark, sf_dir).withColumn("stream_id", F.lit("all"))
    return plan_files(records, SealRules(20 * TARGET), slice_rows=2_000)


def document_seal(spark, sf_dir):
    return plan_files(_documents(spark, sf_dir), SealRules(50 * TARGET))


def order_seal(spark, sf_dir):
    """Orders as records of 15 streams, sealed by size and by an age of 30 days."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    body = F.format_string('{"customer":%d,"status":"%s"}', "o_custkey", "o_orderstatus")
    records = orders.select(
        F.concat_ws("\x1f", "o_orderpriority", "o_orderstatus").alias("stream_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_orderkey").alias("arrival_seq"),
        (F.octet_length(body) + 1).cast("bigint").alias("line_bytes"),
    )
    return plan_files(records, seal_rules(records, TARGET, 30 * MAX_AGE_MS))


def _unfinished(spark, sf_dir) -> DataFrame:
    return plan_files(_consumed(spark, sf_dir), SealRules(TARGET), finalize=False)


def open_streams(spark, sf_dir):
    return lifecycle.open_streams(_unfinished(spark, sf_dir))


def _now_us(records: DataFrame) -> F.Column:
    return F.lit(records.agg(F.unix_micros(F.max("timestamp"))).first()[0])


def dormant_due(spark, sf_dir):
    now = _now_us(replay_events(spark, sf_dir))
    opened = lifecycle.open_streams(_unfinished(spark, sf_dir))
    return lifecycle.dormant_due(opened, now, MAX_AGE_MS * 1000)


def seal_capacity(spark, sf_dir):
    now = _now_us(replay_events(spark, sf_dir))
    opened = lifecycle.open_streams(_unfinished(spark, sf_dir))
    return lifecycle.dormant_due(opened, now, MAX_AGE_MS * 1000, capacity=10)


def final_seal(spark, sf_dir):
    return size_seal(spark, sf_dir).where("seal_reason = 'final'")


# --- offsets -----------------------------------------------------------------------------


def _planned(spark, sf_dir) -> DataFrame:
    records = _consumed(spark, sf_dir, offsets=True)
    return assign_files(records, SealRules(TARGET), ("topic", "partition", "offset"))


def file_offsets(spark, sf_dir):
    return offsets.file_offsets(_planned(spark, sf_dir))


def _released(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Records of the files sealed by size so far, and those that went to quarantine."""
    records = _processed(spark, sf_dir, offsets=True)
    rules = SealRules(TARGET)
    planned = assign_files(consumed(records), rules, ("topic", "partition", "offset"))
    return in_full_files(planned, rules), records.where("outcome = 'decode_error'")


def _uploaded(spark, sf_dir) -> DataFrame:
    """Offsets released so far: those of files sealed by size and of quarantined records."""
    sealed, rejected = _released(spark, sf_dir)
    address = ["topic", "partition", "offset"]
    ranges = offsets.offset_ranges(sealed.select(*address).unionByName(rejected.select(*address)))
    # A few ranges that several steps read, as the stored ones of a streaming run would be.
    return ranges.checkpoint()


def uploaded_offsets(spark, sf_dir):
    """The same as the union over a manifest: a row per sealed file and one per rejected range."""
    sealed, rejected = _released(spark, sf_dir)
    span = F.struct("topic", "partition", "start", "end")
    files = offsets.file_offsets(sealed).groupBy("shard", "stream_id", "file_seq")
    files = files.agg(F.collect_list(span).alias("offsets"), F.lit("uploaded").alias("status")).select("status", "offsets")
    ranges = offsets.offset_ranges(rejected.select("topic", "partition", "offset"))
    return offsets.uploaded_offsets(files.unionByName(ranges.select(F.lit("released").alias("status"), F.array(span).alias("offsets"))))


def _watermarks(spark, sf_dir) -> DataFrame:
    return stats.initial_watermarks(replay_events(spark, sf_dir, offsets=True)).checkpoint()


def committable(spark, sf_dir):
    return offsets.committable(_uploaded(spark, sf_dir), _watermarks(spark, sf_dir))


def _assignment(spark, sf_dir) -> DataFrame:
    """An instance that owns the lower four partitions of every topic."""
    owned = replay_events(spark, sf_dir).select("topic", "partition").distinct()
    return owned.where("partition < 4")


def committable_owned(spark, sf_dir):
    return offsets.committable(
        _uploaded(spark, sf_dir), _watermarks(spark, sf_dir), _assignment(spark, sf_dir)
    )


def _outstanding(spark, sf_dir) -> DataFrame:
    uploaded, watermarks = _uploaded(spark, sf_dir), _watermarks(spark, sf_dir)
    moved = offsets.advance(watermarks, offsets.committable(uploaded, watermarks))
    return offsets.outstanding(uploaded, moved)


def outstanding(spark, sf_dir):
    return _outstanding(spark, sf_dir)


def offset_backlog(spark, sf_dir):
    return offsets.offset_backlog(_outstanding(spark, sf_dir))


def commit_gaps(spark, sf_dir):
    return offsets.commit_gaps(_uploaded(spark, sf_dir), _watermarks(spark, sf_dir))


def _line_offsets(spark, sf_dir, *extra: F.Column) -> DataFrame:
    """Line items as deliveries of order keys: repeated, out of order and with gaps."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat("l_returnflag", "l_linestatus").alias("topic"),
        (F.col("l_suppkey") % 6).cast("int").alias("partition"),
        F.col("l_orderkey").alias("offset"),
        *extra,
    )


def lineitem_ranges(spark, sf_dir):
    return offsets.offset_ranges(_line_offsets(spark, sf_dir))


def lineitem_commits(spark, sf_dir):
    deliveries = _line_offsets(spark, sf_dir)
    first = deliveries.groupBy("topic", "partition").agg(F.min("offset").alias("watermark"))
    return offsets.committable(offsets.offset_ranges(deliveries), first)


def lineitem_gaps(spark, sf_dir):
    deliveries = _line_offsets(spark, sf_dir)
    first = deliveries.groupBy("topic", "partition").agg(F.min("offset").alias("watermark"))
    return offsets.commit_gaps(offsets.offset_ranges(deliveries).checkpoint(), first)


def observed_commits(spark, sf_dir):
    """Commits that step over offsets the source never delivered."""
    delivered = offsets.offset_ranges(_line_offsets(spark, sf_dir))
    returned = _line_offsets(spark, sf_dir).where(F.col("topic") != "NO")
    uploaded = offsets.observed_next(offsets.offset_ranges(returned), delivered)
    first = _line_offsets(spark, sf_dir).groupBy("topic", "partition").agg(
        F.min("offset").alias("watermark")
    )
    return offsets.committable(uploaded, first)


def revoke_streams(spark, sf_dir):
    """Revoked: all of `topic-click` and the lower three partitions of the other topics."""
    planned = _planned(spark, sf_dir)
    opened = lifecycle.open_streams(_unfinished(spark, sf_dir))
    feeding = planned.join(opened, ["shard", "stream_id", "file_seq"], "left_semi").select(
        "stream_id", "topic", "partition"
    )
    revoked = (
        replay_events(spark, sf_dir)
        .select("topic", "partition")
        .distinct()
        .where("topic = 'topic-click' OR partition < 3")
    )
    return lifecycle.revoked_streams(feeding.distinct(), revoked)


# --- landing -----------------------------------------------------------------------------


def _landed(spark, sf_dir, **options) -> str:
    path = work_dir(spark, "landed")
    records = replay_events(spark, sf_dir, offsets=True)
    land(records, replay_config(spark), path, LandingOptions(target_bytes=TARGET, **options))
    return path


def landed_manifest(spark, sf_dir):
    """The manifest without what the codec decides, and whether it compressed anything."""
    path = _landed(spark, sf_dir, shards=2, segment_offsets=150)
    return manifest(spark, path).select(
        "shard", "stream_id", "file_seq", "record_count", "line_count", "raw_size_b", "created_us",
        "seal_reason", "status", (F.col("compressed_size_b") > 0).alias("compressed"),
        F.aggregate(
            "offsets", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"] + 1
        ).alias("offset_count"),
    )


def landed_roundtrip(spark, sf_dir):
    lines = read_landed(spark, _landed(spark, sf_dir))
    return lines.select("stream_id", F.col("line").cast("string").alias("line"))


def landed_source(spark, sf_dir):
    """Landed without a shuffle: each input task packs its own records."""
    lines = read_landed(spark, _landed(spark, sf_dir, distribution="source"))
    return lines.select("stream_id", F.col("line").cast("string").alias("line"))


def landed_two_runs(spark, sf_dir):
    """A batch job and then a streaming query land under one path."""
    stage, path = work_dir(spark, "stage"), work_dir(spark, "landed")
    config, options = replay_config(spark), LandingOptions(target_bytes=TARGET)
    records = replay_events(spark, sf_dir, offsets=True)
    land(records.where("partition < 3"), config, path, options)
    records.where("partition >= 3").drop("arrival_seq").write.parquet(stage)
    stream = read_record_file_stream(spark, stage)
    start_landing(stream, config, path, f"{stage}-checkpoint", options, {"availableNow": True}).awaitTermination()
    return read_landed(spark, path).select("stream_id", F.col("line").cast("string").alias("line"))


def landed_snapshot(spark, sf_dir):
    """Lines and records per stream after two jobs, by the snapshot made between them and its tail."""
    path, config = work_dir(spark, "landed"), replay_config(spark)
    records = replay_events(spark, sf_dir, offsets=True)
    options = LandingOptions(target_bytes=TARGET, segment_offsets=150)
    land(records.where("partition < 4"), config, path, options)
    write_snapshot(spark, path)
    land(records.where("partition >= 4"), config, path, options)
    files = landed_files(spark, path)
    return files.groupBy("stream_id").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("line_count").alias("line_count"),
        F.sum("raw_size_b").alias("raw_size_b"),
    )


def landed_quarantine(spark, sf_dir):
    rejects = quarantined(spark, _landed(spark, sf_dir))
    return rejects.select("topic", "partition", "offset", "error_class", "message")


def landed_fast(spark, sf_dir):
    path = work_dir(spark, "text")
    write_partitioned(_processed(spark, sf_dir), path)
    return read_partitioned(spark, path)


def _arrivals(spark, sf_dir) -> list[DataFrame]:
    """Records in ranges of arrival numbers, BATCHES at most, from one pass over the table."""
    first, last = replay_events(spark, sf_dir).agg(F.min("arrival_seq"), F.max("arrival_seq")).first()
    step = (last - first) // BATCHES + 1
    piece = F.floor((F.col("arrival_seq") - first) / step).cast("int")
    numbered = replay_events(spark, sf_dir, offsets=True).select(*RECORD.names, piece.alias("piece"))
    folder = work_dir(spark, "pieces")
    numbered.write.partitionBy("piece").parquet(folder)
    pieces = spark.read.schema(numbered.schema).parquet(folder)
    return [pieces.where(F.col("piece") == n).drop("piece") for n in range((last - first) // step + 1)]


def _streamed(spark, sf_dir, carry: bool) -> str:
    """Records as files that arrive in time order, landed by a streaming query."""
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    config, options = replay_config(spark), LandingOptions(target_bytes=TARGET)
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").parquet(stage)
        # Started again, the query takes what came since as its next batch.
        query = start_landing(
            read_record_file_stream(spark, stage), config, path, f"{path}/checkpoint", options, {"availableNow": True}, carry
        )
        query.awaitTermination()
    if carry:
        drain(spark, config, path, query.id, query.lastProgress["batchId"], options)
    return path


def stream_landing(spark, sf_dir):
    """Lines and records per stream after a streaming run, by its ledger."""
    files = manifest(spark, _streamed(spark, sf_dir, carry=False))
    return files.groupBy("stream_id").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("line_count").alias("line_count"),
        F.sum("raw_size_b").alias("raw_size_b"),
    )


def stream_carry(spark, sf_dir):
    """Files of a streaming run that keeps files open across batches."""
    files = manifest(spark, _streamed(spark, sf_dir, carry=True)).where("status <> 'open'")
    return files.select(
        "stream_id", "record_count", "line_count", "raw_size_b", "created_us", "seal_reason"
    )


def _open_files(spark, sf_dir, report: RunReport | None = None) -> str:
    """As `_streamed`, with files open in the state store; not drained if a report is to be kept."""
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    config, options = replay_config(spark), LandingOptions(target_bytes=TARGET, shards=1)
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").parquet(stage)
        query = start_open_files(
            read_record_file_stream(spark, stage), config, path, f"{path}/checkpoint", options,
            {"availableNow": True}, report and report.name,
        )
        query.awaitTermination()
        if report:
            report.wait()
    if report is None:
        drain_open_files(spark, path, f"{path}/checkpoint", query.lastProgress["batchId"], options)
    return path


def stream_open_files(spark, sf_dir):
    """Files of a streaming run that keeps open files in the state store, the last ones drained from it."""
    files = manifest(spark, _open_files(spark, sf_dir)).where("status <> 'open'")
    return files.select(
        "stream_id", "record_count", "line_count", "raw_size_b", "created_us", "seal_reason"
    )


def stream_report(spark, sf_dir):
    """What the batches of a streaming run reported of themselves, added up."""
    path = work_dir(spark, "reports")
    report = RunReport(path, f"report-{uuid.uuid4().hex}")
    spark.streams.addListener(report)
    try:
        _open_files(spark, sf_dir, report)
    finally:
        spark.streams.removeListener(report)
    return run_reports(spark, path).agg(
        *[F.sum(c).alias(c) for c in ("lines_taken", "bytes_taken", "record_count", "raw_size_b", "files_sealed", "rejects")]
    )


def offset_log(spark, sf_dir):
    """Watermarks and ranges that are still tracked after the steps in which line items were delivered."""
    stage, path = work_dir(spark, "stage"), work_dir(spark, "offsets")
    step = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(STEPS)).alias("step")
    _line_offsets(spark, sf_dir, step).write.partitionBy("step").parquet(stage)
    for n in range(STEPS):
        ranges = offsets.offset_ranges(spark.read.parquet(stage).where(F.col("step") == n))
        append_offsets(spark, path, "deliveries", n, ranges, ranges)
    ranges, watermarks = offsets_after(spark, path, "deliveries", STEPS - 1)
    return watermarks.join(ranges, list(offsets.PARTITION), "left")


def stream_commits(spark, sf_dir):
    """Last committed offset per topic partition after a streaming run."""
    log = commit_log(spark, _streamed(spark, sf_dir, carry=True))
    return log.groupBy("topic", "partition").agg(F.max("commit_offset").alias("commit_offset"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "records_scan": records_scan,
    "topic_assign": topic_assign,
    "unknown_topics": unknown_topics,
    "decode_outcomes": decode_outcomes,
    "decode_errors": decode_error_rows,
    "header_lookup": header_lookup,
    "route_schema": _routed_by("topic_version"),
    "route_dlq": _routed_by("dlq"),
    "header_audit": header_audit,
    "envelope_lines": envelope_lines,
    "document_envelopes": document_envelopes,
    "object_prefix": object_prefixes,
    "object_keys": object_keys,
    "ratio_text": ratio_texts,
    "stream_totals": stream_totals,
    "stream_catalog": stream_catalog,
    "stream_partitions": stream_partitions,
    "initial_watermarks": initial_watermarks,
    "window_stats": window_stats,
    "order_windows": order_windows,
    "run_stats": run_stats,
    "window_file_stats": window_file_stats,
    "size_seal": size_seal,
    "age_seal": age_seal,
    "final_seal": final_seal,
    "size_seal_sharded": size_seal_sharded,
    "size_seal_sliced": size_seal_sliced,
    "document_seal": document_seal,
    "order_seal": order_seal,
    "open_streams": open_streams,
    "dormant_due": dormant_due,
    "seal_capacity": seal_capacity,
    "file_offsets": file_offsets,
    "uploaded_offsets": uploaded_offsets,
    "committable": committable,
    "committable_owned": committable_owned,
    "outstanding": outstanding,
    "offset_backlog": offset_backlog,
    "commit_gaps": commit_gaps,
    "observed_commits": observed_commits,
    "lineitem_ranges": lineitem_ranges,
    "lineitem_commits": lineitem_commits,
    "lineitem_gaps": lineitem_gaps,
    "revoke_streams": revoke_streams,
    "landed_manifest": landed_manifest,
    "landed_roundtrip": landed_roundtrip,
    "landed_source": landed_source,
    "landed_two_runs": landed_two_runs,
    "landed_snapshot": landed_snapshot,
    "landed_quarantine": landed_quarantine,
    "landed_fast": landed_fast,
    "stream_landing": stream_landing,
    "stream_carry": stream_carry,
    "stream_commits": stream_commits,
    "offset_log": offset_log,
    "stream_open_files": stream_open_files,
    "stream_report": stream_report,
}
