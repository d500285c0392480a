"""Landing: files, ledger, failures, retries and streaming restarts."""

import glob
import shutil

import numpy as np
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from quayside.operators.packing import SealRules
from quayside.operators.records import consumed, process
from quayside.operators.seal import lane, plan_files
from quayside.schema import RECORD
from quayside.session import work_dir
from quayside.sinks import objects
from quayside.sinks.landing import LandingOptions, _OpenFile, _rows_to_land, land, manifest, quarantined, vacuum
from quayside.sources.landed import read_landed
from quayside.sources.records import _kafka_options, read_record_file_stream, read_record_files
from quayside.sources.replay import replay_config, replay_events
from quayside.sources.synthetic import BENCH_GROUPS, Profile, SMALL, synthesize_records
from quayside.operators.topics import suggest_segments, topic_config
from quayside.streaming.landing import commit_log, drain, land_batch, start_landing


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return replay_events(spark, sf_dir, offsets=True).cache()


@pytest.fixture(scope="module")
def config(spark):
    return replay_config(spark)


def lines(spark, path):
    return read_landed(spark, path).select("stream_id", F.col("line").cast("string").alias("line"))


def expected_lines(records, config):
    done = process(records, config).where("outcome = 'ok'")
    return done.select("stream_id", F.col("line").cast("string").alias("line"))


@pytest.mark.parametrize("distribution", ["keyed", "source"])
def test_every_record_is_in_one_file(spark, records, config, distribution):
    path = work_dir(spark, "test")
    land(records, config, path, LandingOptions(target_bytes=600, distribution=distribution))
    assert rows(lines(spark, path)) == rows(expected_lines(records, config))
    ranges = manifest(spark, path).select(F.explode("offsets").alias("r")).select("r.*")
    held = ranges.select("topic", "partition", F.explode(F.sequence("start", "end")).alias("offset"))
    rejected = quarantined(spark, path).select("topic", "partition", "offset")
    assert rows(held.unionByName(rejected)) == rows(records.select("topic", "partition", "offset"))


def test_manifest_is_the_plan(spark, records, config):
    path = work_dir(spark, "test")
    land(records, config, path, LandingOptions(target_bytes=600, shards=3, segment_offsets=20))
    plan = plan_files(consumed(process(records, config)).withColumn("shard", lane(3, 20)), SealRules(600))
    columns = ["shard", "stream_id", "file_seq", "record_count", "line_count", "raw_size_b", "created_us", "seal_reason"]
    landed = manifest(spark, path)
    assert rows(landed.select(*columns)) == rows(plan.select(*columns))
    for r in landed.where("status = 'uploaded'").limit(5).collect():
        content = open(f"{path}/objects/{r.object_key}", "rb").read()
        text = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        assert (len(content), len(text), text.count(b"\n")) == (r.compressed_size_b, r.raw_size_b, r.line_count)
    assert landed.where("line_count = 0 AND object_key IS NOT NULL").isEmpty()


def test_repeating_a_batch_changes_nothing(spark, records, config):
    path = work_dir(spark, "test")
    options = LandingOptions(target_bytes=600)
    land(records, config, path, options, batch_id=4, sealed_us=1_700_000_000_000_000, run_id="one")
    before, files = rows(manifest(spark, path)), sorted(glob.glob(f"{path}/objects/**/*.zst", recursive=True))
    land(records, config, path, options, batch_id=4, sealed_us=1_700_000_000_000_000, run_id="one")
    assert rows(manifest(spark, path)) == before
    assert sorted(glob.glob(f"{path}/objects/**/*.zst", recursive=True)) == files


def test_rejects_or_fails(spark, records, config):
    partial = replay_config(spark, without=("topic-view",))
    path = work_dir(spark, "test")
    land(records, partial, path, LandingOptions(target_bytes=600))
    by_class = {r.error_class: r["count"] for r in quarantined(spark, path).groupBy("error_class").count().collect()}
    assert by_class["Configuration"] == records.where("topic = 'topic-view'").count()
    assert by_class["Serialization"] > 0
    view = quarantined(spark, path).where("topic = 'topic-view'").select("topic", "partition", "offset", "value")
    assert rows(view) == rows(records.where("topic = 'topic-view'").select("topic", "partition", "offset", "value"))
    for bad in ({"on_unknown": "fail"}, {"on_error": "fail"}):
        with pytest.raises(Exception, match="missing topic configuration|could not decode record"):
            land(records, partial, work_dir(spark, "test"), LandingOptions(**bad))


def test_names_stay_inside_the_folder(spark, config):
    headers = [("schema_name", b"../../up"), ("schema_version", b"..")]
    data = [("topic-click", 0, 0, None, b"\x00" * 5 + b"{}", headers)]
    path = work_dir(spark, "test")
    land(spark.createDataFrame(data, RECORD).withColumn("timestamp", F.timestamp_seconds(F.lit(1))), config, path)
    key = manifest(spark, path).first().object_key
    assert key.startswith("%2E.%2F..%2Fup/%2E./ingest_year_month_day=")
    assert glob.glob(f"{path}/objects/**/*.zst", recursive=True) == [f"{path}/objects/{key}"]


def test_large_and_tiny_records(spark):
    profiles = [Profile("topic-1", 300, "one", "v"), Profile("topic-46", 5_000_000, "two", "v"), SMALL]
    records = synthesize_records(spark, 12_000_000, profiles)
    records = records.where("topic <> 'topic-1' OR offset < 200")
    path = work_dir(spark, "test")
    config = topic_config(spark, BENCH_GROUPS)
    records.write.parquet(f"{path}/in")
    records = read_record_files(spark, f"{path}/in")
    land(records, config, path, LandingOptions(target_bytes=6_000_000))
    assert rows(lines(spark, path)) == rows(expected_lines(records, config))
    small = lines(spark, path).where(F.col("stream_id").startswith("topic-small")).first()
    assert small.line.startswith('{"data":' + "\x00" * 5 + '{"pier":4,')


class Flaky:
    """A store whose first writes fail."""

    def __init__(self, failures):
        self.inner, self.failures, self.type_name = fs.LocalFileSystem(), failures, "local"

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def open_output_stream(self, *args, **kwargs):
        if self.failures:
            self.failures -= 1
            raise OSError("unreachable")
        return self.inner.open_output_stream(*args, **kwargs)


def test_put_retries_and_gives_up(tmp_path):
    waits = []
    assert objects.put(Flaky(2), f"{tmp_path}/a/f.zst", b"x", 3, waits.append) == 2
    assert open(f"{tmp_path}/a/f.zst", "rb").read() == b"x"
    assert waits[0] == 0 and waits[1] <= 0.2 and waits[2] <= 0.4
    with pytest.raises(OSError, match="maximum number of retries"):
        objects.put(Flaky(9), f"{tmp_path}/b/f.zst", b"x", 3, waits.append)
    assert glob.glob(f"{tmp_path}/b/*") == []


def test_object_stores_get_metadata():
    given = {}

    class Store:
        type_name = "s3"

        def open_output_stream(self, target, compression, metadata):
            given[target] = metadata
            return fs.LocalFileSystem().open_output_stream("/dev/null", compression=compression)

    about = {"record_count": "2", "raw_size_bytes": "10", "compression_ratio": "5.00"}
    assert objects.put(Store(), "b/f.zst", b"x", 0, metadata=about) == 0
    assert given == {"b/f.zst": about}


def test_vacuum_removes_what_no_ledger_names(spark, records, config):
    path = work_dir(spark, "test")
    assert vacuum(spark, path, 2**60) == 0
    land(records, config, path, LandingOptions(target_bytes=600))
    before, files = rows(lines(spark, path)), sorted(glob.glob(f"{path}/objects/**/*.zst", recursive=True))
    shutil.copy(files[0], files[0].replace(".jsonl.zst", "0.jsonl.zst"))
    assert vacuum(spark, path, 0) == 0
    assert vacuum(spark, path, 2**60) == 1
    assert vacuum(spark, path, 2**60) == 0
    assert sorted(glob.glob(f"{path}/objects/**/*.zst", recursive=True)) == files
    assert rows(lines(spark, path)) == before


def test_backoff_bounds():
    assert [objects.backoff_ms(n) for n in range(8)] == [0, 200, 400, 800, 1600, 3200, 5000, 5000]


def staged(spark, records, parts):
    stage = work_dir(spark, "stage")
    count = records.count()
    for k in range(parts):
        low, high = k * count // parts, (k + 1) * count // parts - 1
        part = records.where(F.col("arrival_seq").between(low, high)).drop("arrival_seq")
        part.coalesce(1).write.mode("append").parquet(stage)
    return stage


def test_stream_with_carry_equals_one_batch_even_after_a_repeat(spark, records, config):
    stage, path = staged(spark, records, 2), work_dir(spark, "stream")
    options = LandingOptions(target_bytes=900, shards=1, segment_offsets=None)
    stream = read_record_file_stream(spark, stage, files_per_batch=1)
    query = start_landing(stream, config, path, f"{path}/checkpoint", options, {"availableNow": True}, carry=True)
    query.awaitTermination()
    last = query.lastProgress["batchId"]

    # The driver died after the last batch was landed but before the checkpoint knew.
    before = rows(manifest(spark, path).drop("failed_attempts"))
    count = records.count()
    again = records.where(F.col("arrival_seq") >= count // 2).drop("arrival_seq")
    land_batch(config, path, query.id, options, carry=True)(again, last)
    assert rows(manifest(spark, path).drop("failed_attempts")) == before

    drain(spark, config, path, query.id, last, options)
    columns = ["stream_id", "record_count", "line_count", "raw_size_b", "created_us", "seal_reason"]
    plan = plan_files(consumed(process(records, config)), SealRules(900)).select(*columns)
    assert rows(manifest(spark, path).where("status <> 'open'").select(*columns)) == rows(plan)
    assert rows(lines(spark, path)) == rows(expected_lines(records, config))
    ends = commit_log(spark, path).groupBy("topic", "partition").agg(F.max("commit_offset").alias("n"))
    assert rows(ends) == rows(records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("n")))


def test_topics_set_their_own_lanes(spark, records, config):
    path = work_dir(spark, "test")
    own = replay_config(spark, segments={"topic-click": 7})
    land(records, own, path, LandingOptions(shards=2, segment_offsets=None))
    assert manifest(spark, path).agg(F.max("shard")).first()[0] == 1
    land(records, own, path, LandingOptions(shards=2, segment_offsets=1_000), batch_id=1)
    ranges = manifest(spark, path, 1).select(F.explode("offsets").alias("r")).select("r.*")
    assert ranges.where("topic = 'topic-click' AND start div 7 <> `end` div 7").isEmpty()
    assert not ranges.where("topic = 'topic-view' AND start div 7 <> `end` div 7").isEmpty()
    suggested = {r.topic: r.segment_offsets for r in suggest_segments(manifest(spark, path, 1), 70).collect()}
    assert suggested["topic-click"] == 1 and set(suggested) == {r.topic for r in config.collect()}


def test_kafka_subscription(spark, config):
    options = _kafka_options(config, {"kafka.bootstrap.servers": "broker:9092"})
    assert options["subscribe"] == "dlq,topic-click,topic-purchase,topic-signup,topic-view"
    assert (options["includeHeaders"], options["failOnDataLoss"]) == ("true", "true")


def test_age_seals_carried_files(spark, config):
    def batch(start, streams):
        rows = [
            ("topic-click", 0, start + i, None, b"\x00" * 5 + b"{}", [("schema_name", name.encode())])
            for i, name in enumerate(streams)
        ]
        df = spark.createDataFrame(rows, RECORD)
        return df.withColumn("timestamp", F.timestamp_seconds(F.col("offset") * 10))

    path = work_dir(spark, "test")
    options = LandingOptions(target_bytes=10_000, max_age_ms=100_000, shards=1, segment_offsets=None)

    def step(batch_id, rows, now_s):
        opened = manifest(spark, path, batch_id - 1).where("status = 'open'") if batch_id else None
        land(
            rows, config, path, options, batch_id, sealed_us=now_s * 1_000_000,
            finalize=False, now_us=now_s * 1_000_000, opened=opened,
        )
        found = manifest(spark, path, batch_id).collect()
        return sorted((r.stream_id.split("\x1f")[0], r.seal_reason, r.record_count, r.sealed_us // 10**6) for r in found)

    assert step(0, batch(0, ["a", "b"]), 20) == [("a", "open", 1, 20), ("b", "open", 1, 20)]
    # No new record for "a": the clock alone closes it. "b" grows and stays open.
    assert step(1, batch(3, ["b"]), 105) == [("a", "dormant", 1, 100), ("b", "open", 2, 105)]
    # "b" was due before this record came, so the record starts a new file.
    assert step(2, batch(50, ["b"]), 510) == [("b", "dormant", 2, 110), ("b", "open", 1, 510)]


def test_jobs_on_one_path_leave_each_other_alone(spark, records, config):
    stage, path = work_dir(spark, "stage"), work_dir(spark, "stream")
    records.where("partition >= 3").drop("arrival_seq").coalesce(1).write.parquet(stage)
    options = LandingOptions(target_bytes=900, shards=2)
    first = land(records.where("partition < 3"), config, path, options)

    def stream(checkpoint):
        source = read_record_file_stream(spark, stage)
        query = start_landing(source, config, path, f"{path}/{checkpoint}", options, {"availableNow": True})
        query.awaitTermination()
        return query.id

    second = stream("checkpoint")
    assert rows(lines(spark, path)) == rows(expected_lines(records, config))
    before, files = rows(manifest(spark, path)), set(glob.glob(f"{path}/objects/**/*.zst", recursive=True))
    # With a new checkpoint the source is read again: lines come twice, none are lost.
    third = stream("another")
    assert rows(manifest(spark, path).where(F.col("run_id") != third)) == before
    assert files < set(glob.glob(f"{path}/objects/**/*.zst", recursive=True))
    twice = records.unionByName(records.where("partition >= 3"))
    assert rows(lines(spark, path)) == rows(expected_lines(twice, config))
    assert {r.run_id for r in manifest(spark, path).select("run_id").distinct().collect()} == {first, second, third}
    with pytest.raises(ValueError, match="run id"):
        land(records, config, path, options, run_id="../up")


def test_old_records_accumulate_until_the_arrival_clock_closes_them(spark, config):
    path, now = work_dir(spark, "test"), []
    options = LandingOptions(target_bytes=10_000, max_age_ms=100_000, shards=1)
    run = land_batch(config, path, "old", options, carry=True, clock=lambda: now[-1] * 1_000_000)

    def step(batch_id, now_s):
        now.append(now_s)
        row = ("topic-click", 0, batch_id, None, b"\x00" * 5 + b"{}", [("schema_name", b"a")])
        df = spark.createDataFrame([row], RECORD).withColumn("timestamp", F.timestamp_seconds(F.lit(1)))
        run(df, batch_id)
        found = manifest(spark, path, batch_id, "old").collect()
        return sorted((r.seal_reason, r.record_count, r.created_us // 10**6) for r in found)

    assert step(0, 1_000_000) == [("open", 1, 1_000_000)]
    assert step(1, 1_000_050) == [("open", 2, 1_000_000)]
    closed = [("dormant", 2, 1_000_000), ("open", 1, 1_000_200)]
    assert step(2, 1_000_200) == closed
    # Repeated later, the batch keeps its time.
    assert step(2, 1_000_900) == closed


def test_no_row_on_its_way_to_python_has_a_null_list(spark, sf_dir):
    records = replay_events(spark, sf_dir, offsets=True)
    found = _rows_to_land(records, replay_config(spark), LandingOptions())
    nulls = found.agg(F.count_if(F.col("seed.offsets").isNull()), F.count_if(F.col("reject.headers").isNull()), F.count_if(F.col("reject.error_class").isNotNull()))
    seeds, headers, rejects = nulls.first()
    assert (seeds, headers) == (0, 0) and 0 < rejects < found.count()


def test_offset_ranges_of_a_resumed_file_of_several_topics():
    file = _OpenFile(zstandard.ZstdCompressor(level=3))
    file.resume({"record_count": 3, "line_count": 0, "raw_size_b": 0, "offsets": [{"topic": "b", "partition": 1, "start": 4, "end": 6}]}, b"")
    i8 = lambda *x: np.array(x, "i8")
    file.add_offsets(["b", "a"], i8(0, 1, 0, 0), i8(1, 0, 1, 2), i8(7, 3, 3, 7))
    file.add_offsets(["a"], i8(0, 0), i8(0, 0), i8(2, 9))
    assert file.offset_ranges() == [("a", 0, 2, 3), ("a", 0, 9, 9), ("b", 1, 3, 7), ("b", 2, 7, 7)]
    assert file.records == 9
