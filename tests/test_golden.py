"""Golden cases for decoding, envelopes, routing, keys and figures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions.headers import header_value
from quayside.functions.keys import file_suffix, landed_key, landed_suffix, object_key, object_prefix
from quayside.functions.metrics import compression_ratio, rate, ratio_text
from quayside.functions.routing import by_dead_letter, by_schema_version, stream_parts
from quayside.operators.records import decode, decode_errors, dropped_headers, envelope
from quayside.operators.topics import assign_config, topic_config
from quayside.schema import HEADERS

FRAME = b"\x00" * 5
DEFAULT = [("origin", b"quay 4"), ("seal", b"0x7f")]
ROW = f"id INT, topic STRING, partition INT, offset BIGINT, value BINARY, headers {HEADERS.simpleString()}, decoder STRING"


def rows(spark, cases):
    data = [(i, "topic", 0, 0, value, headers, decoder) for i, (value, headers, decoder) in enumerate(cases)]
    return spark.createDataFrame(data, ROW).coalesce(1)


ENVELOPES = [
    (FRAME + b'{"berths":[3,{"free":null}],"tide":-0.5}', DEFAULT, "schema", "ok",
     b'{"data":{"berths":[3,{"free":null}],"tide":-0.5},"x-origin":"quay 4","x-seal":"0x7f"}'),
    (b'"a line of text"', DEFAULT, "string", "ok",
     b'{"data":"a line of text","x-origin":"quay 4","x-seal":"0x7f"}'),
    (b'"a line of text"', None, "string", "ok", b'{"data":"a line of text"}'),
    (b'"a line of text"', [], "string", "ok", b'{"data":"a line of text"}'),
    (None, DEFAULT, "string", "skip_null", None),
    (None, DEFAULT, "schema", "skip_null", None),
    (b'[true, 9]', DEFAULT, "schema", "decode_error", None),
    (b"", DEFAULT, "schema", "decode_error", None),
    (b"\x01\x00\x00\x00\x01{}", DEFAULT, "schema", "decode_error", None),
    (b"\x00\x00\x00", DEFAULT, "schema", "decode_error", None),
    (FRAME, DEFAULT, "schema", "skip_empty", None),
    (b"", DEFAULT, "string", "skip_empty", None),
    (b'"data"', [("crane", b"idle"), ("note", b'say "go"')], "string", "ok",
     b'{"data":"data","x-crane":"idle"}'),
    (b'"data"', [("c:\\dock", b"value")], "string", "ok", b'{"data":"data"}'),
    (b'"data"', [("key", b"one\ntwo")], "string", "ok", b'{"data":"data"}'),
    (b'"data"', [("unset", None), ("ship", b"in")], "string", "ok", b'{"data":"data","x-ship":"in"}'),
    (b'"data"', [("e", b""), ("e", b"again"), ("d", b"\x7f\xff\xfe")], "string", "ok",
     b'{"data":"data","x-e":"","x-e":"again","x-d":"\x7f\xff\xfe"}'),
    (b'"data"', [("cut", b"\xe2\x22")], "string", "ok", b'{"data":"data"}'),
    # A framed value read as plain keeps its frame.
    (FRAME + b'{"id":1}', None, "string", "ok", b'{"data":' + FRAME + b'{"id":1}}'),
]


def test_envelopes(spark):
    got = envelope(decode(rows(spark, [c[:3] for c in ENVELOPES]))).orderBy("id").collect()
    for row, (_, _, _, outcome, line) in zip(got, ENVELOPES):
        assert row.outcome == outcome
        assert (None if row.line is None else bytes(row.line)) == line
        assert row.line_bytes == (0 if line is None else len(line) + 1)


def test_unknown_decoder_is_an_error_and_message(spark):
    errors = decode_errors(decode(rows(spark, [(b"x", None, "schema"), (b"x", None, "string")]))).collect()
    assert [e.message for e in errors] == [
        "could not decode record 'topic', partition '0', offset '0' with JsonSchemaDecoder"
    ]


def test_dropped_headers(spark):
    headers = [("a", None), ("b", b"ok"), ("c", b'q"'), ("d\\", b"v"), ("e", b"\x1f")]
    got = dropped_headers(rows(spark, [(b"x", headers, "string")])).orderBy("position").collect()
    assert [(r.position, r.reason) for r in got] == [
        (0, "null_value"), (2, "unsafe_value"), (3, "unsafe_key"), (4, "unsafe_value"),
    ]


ROUTES = [
    ([("schema_name", b"cargo"), ("schema_version", b"2024b")], "cargo|2024b",
     "topic|cargo|2024b|status_code=unknown_status_code"),
    ([("schema_name", b"cargo"), ("schema_version", b"2024b"), ("status_code", b"503")],
     "cargo|2024b", "topic|cargo|2024b|status_code=503"),
    ([("schema_name", b""), ("schema_version", b"")], "unknown_schema_name|unknown_schema_version",
     "topic|unknown_schema_name|unknown_schema_version|status_code=unknown_status_code"),
    (None, "unknown_schema_name|unknown_schema_version",
     "topic|unknown_schema_name|unknown_schema_version|status_code=unknown_status_code"),
    ([("schema_name", b"pilot")], "pilot|unknown_schema_version",
     "topic|pilot|unknown_schema_version|status_code=unknown_status_code"),
    ([("schema_name", b"\xff\xfe"), ("schema_name", None), ("schema_name", b"second")],
     "second|unknown_schema_version", "topic|second|unknown_schema_version|status_code=unknown_status_code"),
]


def test_routes(spark):
    df = rows(spark, [(b"x", headers, "string") for headers, _, _ in ROUTES])
    got = df.orderBy("id").select(
        by_schema_version(F.col("topic"), F.col("headers")).alias("version"),
        by_dead_letter(F.col("topic"), F.col("headers")).alias("dead"),
    )
    for row, (_, version, dead) in zip(got.collect(), ROUTES):
        assert (row.version.replace("\x1f", "|"), row.dead.replace("\x1f", "|")) == (version, dead)


@pytest.mark.parametrize(
    "headers, found",
    [
        ([("k", b"\xff\xfe")], None),
        ([("k", b"first"), ("k", b"second")], "first"),
        ([("j", b"v")], None),
        ([("k", b""), ("k", b"v")], "v"),
    ],
)
def test_header_value(spark, headers, found):
    df = rows(spark, [(b"x", headers, "string")])
    assert df.select(header_value(F.col("headers"), "k")).first()[0] == found


def test_topic_config_last_group_wins(spark):
    config = topic_config(spark, [("schema", "topic_version", ["a", "b"]), ("string", "dlq", ["b"])])
    assert sorted(map(tuple, config.collect()), key=repr) == [
        ("a", "schema", "topic_version", None), ("b", "string", "dlq", None),
    ]
    assigned = assign_config(spark.createDataFrame([("c",)], "topic STRING"), config).first()
    assert assigned.decoder is None and assigned.router is None
    with pytest.raises(ValueError):
        topic_config(spark, [("avro", "dlq", ["a"])])


AT = dt.datetime(2026, 5, 29, 14, 30, 15, 999_999, dt.timezone.utc)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_object_keys(spark, zone):
    stream = "dlq\x1fschema_name\x1fschema_version\x1fstatus_code=503"
    sealed_us = int(AT.timestamp()) * 1_000_000 + 999_999
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        key = object_key(stream_parts(F.lit(stream)), F.timestamp_micros(F.lit(sealed_us)), F.lit("c0ffee11"))
        want = (
            "dlq/schema_name/schema_version/status_code=503/"
            "ingest_year_month_day=2026-05-29/2026-05-29T14:30:15Z-c0ffee11.jsonl.zst"
        )
        assert spark.range(1).select(key).first()[0] == want
        assert landed_key(stream, sealed_us, "c0ffee11", escape=False) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_escaped_parts_and_suffix(spark):
    stream = "..\x1fa/b%\x1f\x1f.x"
    prefix = object_prefix(stream_parts(F.lit(stream)), escape=True)
    assert spark.range(1).select(prefix).first()[0] == "%2E./a%2Fb%25/%/%2Ex"
    assert landed_key(stream, 0, "s", escape=True).startswith("%2E./a%2Fb%25/%/%2Ex/ingest")
    suffix = file_suffix(F.lit("r"), F.lit(3), F.lit(2), F.lit("s"), F.lit(1))
    assert landed_suffix("s", "r", 3, 2, 1) == spark.range(1).select(suffix).first()[0] + "-2-1"


def test_compression_ratio_is_exact(spark):
    sizes = [(100, 25), (1000, 1000), (5, 14), (0, 9), (0, 0), (10**9, 1)]
    sizes += [(10_000, 10_000 - k) for k in range(0, 400)] + [(7 * k + 1, 3 * k) for k in range(1, 400)]
    df = spark.createDataFrame(sizes, "raw BIGINT, packed BIGINT")
    for row in df.select("*", compression_ratio(F.col("raw"), F.col("packed")).alias("text")).collect():
        assert row.text == ratio_text(row.raw, row.packed)


def test_rate(spark):
    values = [(10, 4.0, 2.5), (1, 3.0, 0.33), (5, 0.0, 0.0), (2, 3.0, 0.67)]
    df = spark.createDataFrame(values, "n BIGINT, s DOUBLE, want DOUBLE")
    assert all(r.got == r.want for r in df.select("*", rate(F.col("n"), F.col("s")).alias("got")).collect())


def test_unconfigured_topics_enter_no_stream(spark):
    """Whatever their value: it has no outcome of its own, no error and no place in a file."""
    import datetime

    from quayside.operators.packing import SealRules
    from quayside.operators.records import consumed, decode_errors, process
    from quayside.operators.seal import plan_files
    from quayside.operators.topics import topic_config
    from quayside.schema import RECORD

    config = topic_config(spark, [("string", "topic_version", ["known"])])
    names = RECORD.fieldNames()
    values = {"partition": 0, "timestamp": datetime.datetime(2024, 1, 1), "headers": None, "arrival_seq": None}
    made = [
        {**values, "topic": t, "offset": i, "value": v}
        for i, (t, v) in enumerate([("known", b"a"), ("other", None), ("other", b""), ("other", b"x")])
    ]
    records = spark.createDataFrame([tuple(r.get(n) for n in names) for r in made], RECORD)
    rows = process(records.withColumn("arrival_seq", records["offset"]), config)
    assert sorted(r.outcome for r in rows.collect()) == ["ok", "unconfigured", "unconfigured", "unconfigured"]
    assert decode_errors(rows).collect() == []
    assert plan_files(consumed(rows), SealRules(900)).count() == 1
