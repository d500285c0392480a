"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

TARGET = 1000
AGE_US = 86_400_000_000

# Records as the replay derives them, with outcome, stream and line.
_RECORDS = """
r AS (SELECT *, CASE WHEN event_type = 'error' THEN 'dlq' ELSE 'topic-' || event_type END AS topic,
    CAST(user_id % 6 AS INTEGER) AS "partition" FROM events),
f0 AS (SELECT *,
    row_number() OVER (PARTITION BY topic, "partition" ORDER BY event_id) - 1 AS "offset",
    CASE WHEN event_id % 97 = 0 THEN 'skip_null'
         WHEN topic <> 'dlq' AND event_id % 101 = 0 THEN 'decode_error'
         WHEN event_id % 89 = 0 THEN 'skip_empty' ELSE 'ok' END AS outcome,
    CASE WHEN event_id % 53 <> 0 THEN CASE WHEN event_id % 59 = 0 THEN '' ELSE event_type END END AS h_name,
    CASE WHEN event_id % 47 <> 0 THEN '1.' || (user_id % 3) || '.0' END AS h_ver,
    CASE WHEN topic = 'dlq' AND event_id % 43 <> 0
         THEN CASE WHEN value < 20 THEN '400' ELSE '500' END END AS h_code
    FROM r),
f1 AS (SELECT *,
    coalesce(nullif(h_name, ''), 'unknown_schema_name') AS schema_name,
    coalesce(h_ver, 'unknown_schema_version') AS schema_version,
    coalesce(h_code, 'unknown_status_code') AS status_code,
    CASE WHEN outcome = 'ok' THEN '{"data":' || props
        || coalesce(',"x-schema_name":"' || h_name || '"', '')
        || coalesce(',"x-schema_version":"' || h_ver || '"', '')
        || coalesce(',"x-status_code":"' || h_code || '"', '') || '}' END AS line
    FROM f0),
f AS MATERIALIZED (SELECT *, epoch_us(ts) AS t,
    CASE WHEN topic = 'dlq'
         THEN topic || chr(31) || schema_name || chr(31) || schema_version || chr(31)
              || 'status_code=' || status_code
         ELSE schema_name || chr(31) || schema_version END AS stream_id,
    CASE WHEN line IS NULL THEN 0 ELSE strlen(line) + 1 END AS line_bytes
    FROM f1),
c AS (SELECT * FROM f WHERE outcome <> 'decode_error')
"""


def _records(select: str) -> str:
    return f"WITH {_RECORDS} {select}"


def _sealed(
    select: str,
    shard: str = "0",
    stream: str = "stream_id",
    target: int = TARGET,
    age_us: int | None = None,
    records: str = _RECORDS,
) -> str:
    """Packs relation `c` (stream_id, event_id, t, line_bytes, ...) record by record.

    `filled` numbers the records' files; `files` has one row per file.
    """
    tick = (age_us or 0) // 10
    due = f"m.t0 + CAST(ceil((w.created + {age_us} - m.t0) / {tick}.0) AS BIGINT) * {tick}"
    aged = f"({due}) <= q.t" if age_us else "false"
    dormant = f"m.t0 + CAST(ceil((created_us + {age_us} - m.t0) / {tick}.0) AS BIGINT) * {tick}"
    return f"""
WITH RECURSIVE {records},
q AS MATERIALIZED (SELECT *, CAST({shard} AS BIGINT) AS shard, {stream} AS stream,
    row_number() OVER (PARTITION BY {shard}, {stream} ORDER BY t, event_id) AS rn FROM c),
m AS MATERIALIZED (SELECT min(t) AS t0 FROM c),
w AS (
    SELECT shard, stream, rn, line_bytes AS acc, line_bytes >= {target} AS closed, t AS created, 0 AS seq
    FROM q WHERE rn = 1
    UNION ALL
    SELECT shard, stream, rn, CASE WHEN fresh THEN 0 ELSE acc END + line_bytes,
        line_bytes > 0 AND CASE WHEN fresh THEN 0 ELSE acc END + line_bytes >= {target},
        CASE WHEN fresh THEN t ELSE created END, CASE WHEN fresh THEN seq + 1 ELSE seq END
    FROM (SELECT q.shard, q.stream, q.rn, q.line_bytes, q.t, w.acc, w.created, w.seq,
            w.closed OR {aged} AS fresh
        FROM w JOIN q ON q.shard = w.shard AND q.stream = w.stream AND q.rn = w.rn + 1 CROSS JOIN m)),
filled AS MATERIALIZED (SELECT q.* EXCLUDE (stream_id, stream, rn), q.stream AS stream_id,
    CAST(w.seq AS BIGINT) AS file_seq, w.created, w.closed
    FROM w JOIN q USING (shard, stream, rn)),
f1s AS (SELECT shard, stream_id, file_seq, count(*) AS record_count,
    count(*) FILTER (WHERE line_bytes > 0) AS line_count,
    CAST(sum(line_bytes) AS BIGINT) AS raw_size_b, min(created) AS created_us,
    bool_or(closed) AS closed, max(t) AS last_t FROM filled GROUP BY shard, stream_id, file_seq),
f2 AS (SELECT *, lead(file_seq) OVER (PARTITION BY shard, stream_id ORDER BY file_seq) AS following
    FROM f1s),
files AS (SELECT f2.* EXCLUDE (closed, last_t, following),
    CASE WHEN closed THEN 'size' WHEN following IS NOT NULL THEN 'dormant' ELSE 'final' END AS seal_reason,
    CASE WHEN closed THEN last_t WHEN following IS NOT NULL THEN {dormant if age_us else 'NULL'} END
        AS sealed_us
    FROM f2 CROSS JOIN m)
{select}"""


_FILES = (
    "SELECT shard, stream_id, file_seq, record_count, line_count, raw_size_b, created_us, "
    "seal_reason, CAST(sealed_us AS BIGINT) AS sealed_us FROM files"
)
_OPEN = _FILES.replace("seal_reason,", "'open' AS seal_reason,") + " WHERE seal_reason = 'final'"

# Offset sets as ranges: consecutive distinct offsets of a key.
_RANGES = """
SELECT {keys}, min("offset") AS start, max("offset") AS "end" FROM (
    SELECT *, "offset" - row_number() OVER (PARTITION BY {keys} ORDER BY "offset") AS island
    FROM (SELECT DISTINCT {keys}, "offset" FROM {source}))
GROUP BY {keys}, island
"""
_KEYS = 'topic, "partition"'
_UPLOADED = (
    """, released AS (
    SELECT topic, "partition", "offset" FROM filled JOIN files USING (shard, stream_id, file_seq)
    WHERE seal_reason = 'size'
    UNION ALL SELECT topic, "partition", "offset" FROM f WHERE outcome = 'decode_error'),
uploaded AS ("""
    + _RANGES.format(keys=_KEYS, source="released")
    + """),
marks AS (SELECT topic, "partition", arg_min("offset", event_id) AS watermark FROM f GROUP BY ALL)"""
)
_COMMITS = """
SELECT topic, "partition", watermark, "end" + 1 AS commit_offset
FROM uploaded JOIN marks USING (topic, "partition") WHERE watermark BETWEEN start AND "end"
"""
_HELD = (
    ", commits AS ("
    + _COMMITS
    + """), held AS (
    SELECT u.topic, u."partition", greatest(start, coalesce(commit_offset, watermark)) AS start, u."end"
    FROM uploaded u JOIN marks USING (topic, "partition") LEFT JOIN commits USING (topic, "partition")
    WHERE u."end" >= coalesce(commit_offset, marks.watermark))"""
).replace("coalesce(commit_offset, watermark)", "coalesce(commit_offset, marks.watermark)")
_GAPS = """
SELECT topic, "partition", gap_start, gap_end, gap_end - gap_start + 1 AS missing FROM (
    SELECT topic, "partition", coalesce(lag("end") OVER x + 1, watermark) AS gap_start, start - 1 AS gap_end
    FROM uploaded JOIN marks USING (topic, "partition") WHERE "end" >= watermark
    WINDOW x AS (PARTITION BY topic, "partition" ORDER BY start))
WHERE gap_end >= gap_start
"""

_DELIVERED = """
delivered AS (SELECT l_returnflag || l_linestatus AS topic, CAST(l_suppkey % 6 AS INTEGER) AS "partition",
    l_orderkey AS "offset" FROM lineitem),
marks AS (SELECT topic, "partition", min("offset") AS watermark FROM delivered GROUP BY ALL)"""
_LINES = f"WITH {_DELIVERED}, uploaded AS ({_RANGES.format(keys=_KEYS, source='delivered')})"

_STEPPED = f"""
WITH delivered AS (SELECT l_returnflag || l_linestatus AS topic, CAST(l_suppkey % 6 AS INTEGER) AS "partition",
    l_orderkey AS "offset", (l_orderkey * 7 + l_linenumber) % 10 AS step FROM lineitem),
marks AS (SELECT topic, "partition", min("offset") AS watermark FROM delivered
    JOIN (SELECT topic, "partition", min(step) AS step FROM delivered GROUP BY ALL) USING (topic, "partition", step) GROUP BY ALL),
uploaded AS ({_RANGES.format(keys=_KEYS, source='delivered')})"""

_DOCUMENTS = """
c AS (SELECT doc_id AS event_id, doc_id AS t, source || chr(31) || lang AS stream_id,
    position(chr(10) IN text) > 0 AS has_newline,
    '{"data":' || text || ',"x-schema_name":"' || source || '","x-schema_version":"' || lang || '"}' AS line,
    strlen(line) + 1 AS line_bytes FROM documents)"""

_ORDERS = """
c AS (SELECT o_orderkey AS event_id, epoch_us(o_orderdate) AS t,
    o_orderpriority || chr(31) || o_orderstatus AS stream_id,
    strlen('{"customer":' || o_custkey || ',"status":"' || o_orderstatus || '"}') + 1 AS line_bytes
    FROM orders)"""


def _rate(count: str, seconds: str, name: str) -> str:
    return f"round({count} / {seconds} * 100) / 100 AS {name}"


def _report(records: str, mib: str, seconds: str) -> str:
    return ", ".join(
        [
            f"CAST({records} AS BIGINT) AS record_count",
            f"CAST({mib} AS BIGINT) AS mb_consumed",
            _rate(records, seconds, "record_per_sec"),
            _rate(mib, seconds, "mb_per_sec"),
        ]
    )


def _file_report(seconds: str) -> str:
    lines, mib = "sum(line_count)", "floor(sum(raw_size_b) / 1048576)"
    sealed = "count(*) FILTER (WHERE seal_reason IN ('size', 'dormant'))"
    return ", ".join(
        [
            _report(lines, mib, seconds),
            f"{sealed} AS files_sealed",
            "count(*) AS successful_uploads",
            "CAST(0 AS BIGINT) AS failed_uploads",
            "count(*) FILTER (WHERE seal_reason = 'dormant') AS dormant_files",
            _rate(sealed, seconds, "files_sealed_per_sec"),
            _rate("count(*)", seconds, "successful_uploads_per_sec"),
            "CAST(0 AS DOUBLE) AS failed_uploads_per_sec",
        ]
    )


_CONFIG = """
CASE WHEN topic = 'topic-signup' THEN NULL WHEN topic = 'dlq' THEN 'string' ELSE 'schema' END AS decoder,
CASE WHEN topic = 'topic-signup' THEN NULL WHEN topic = 'dlq' THEN 'dlq' ELSE 'topic_version' END AS router
"""
_LANE = '"partition" % 2 + "offset" // 150 * 2'
_LINE_ROWS = _records("SELECT stream_id, line FROM f WHERE outcome = 'ok'")
_MESSAGE = (
    "'could not decode record ''' || topic || ''', partition ''' || \"partition\" || ''', offset '''"
    " || \"offset\" || ''' with JsonSchemaDecoder' AS message"
)

_LANDED_TOTALS = _records(
    """SELECT stream_id, count(*) AS record_count, count(*) FILTER (WHERE line_bytes > 0) AS line_count,
    CAST(sum(line_bytes) AS BIGINT) AS raw_size_b FROM c GROUP BY stream_id"""
)

ORACLES: dict[str, str] = {
    "records_scan": _records(
        """SELECT topic, "partition", "offset", event_id AS arrival_seq,
    CASE outcome WHEN 'skip_null' THEN NULL WHEN 'decode_error' THEN strlen(props)
        WHEN 'skip_empty' THEN CASE WHEN topic = 'dlq' THEN 0 ELSE 5 END
        ELSE strlen(props) + CASE WHEN topic = 'dlq' THEN 0 ELSE 5 END END AS value_bytes,
    CAST(h_name IS NOT NULL AS INTEGER) + CAST(h_ver IS NOT NULL AS INTEGER)
        + CAST(h_code IS NOT NULL AS INTEGER) + CAST(event_id % 61 = 0 AS INTEGER) AS header_count FROM f"""
    ),
    "topic_assign": _records(f"SELECT event_id AS arrival_seq, topic, {_CONFIG} FROM f"),
    "unknown_topics": _records(
        "SELECT event_id AS arrival_seq, topic FROM f WHERE topic = 'topic-signup'"
    ),
    "decode_outcomes": _records(
        """SELECT event_id AS arrival_seq, outcome,
    CASE outcome WHEN 'ok' THEN props WHEN 'skip_empty' THEN '' END AS body FROM f"""
    ),
    "decode_errors": _records(
        f"""SELECT topic, "partition", "offset", {_MESSAGE} FROM f WHERE outcome = 'decode_error'"""
    ),
    "header_lookup": _records(
        "SELECT event_id AS arrival_seq, schema_name, schema_version, status_code FROM f"
    ),
    "route_schema": _records(
        "SELECT event_id AS arrival_seq, stream_id FROM f WHERE topic <> 'dlq'"
    ),
    "route_dlq": _records("SELECT event_id AS arrival_seq, stream_id FROM f WHERE topic = 'dlq'"),
    "header_audit": r"""
SELECT conv_id, turn, role AS key, CASE WHEN text IS NULL THEN 'null_value' ELSE 'unsafe_value' END AS reason
FROM conversations WHERE text IS NULL OR regexp_matches(text, '["\\\x00-\x1F]')""",
    "envelope_lines": _records(
        """SELECT event_id AS arrival_seq, line, position(chr(10) IN props) > 0 AS has_newline
FROM f WHERE outcome = 'ok'"""
    ),
    "document_envelopes": f"""WITH {_DOCUMENTS}
SELECT event_id AS doc_id, stream_id, line_bytes, line, has_newline FROM c""",
    "object_prefix": _records(
        "SELECT DISTINCT stream_id, replace(stream_id, chr(31), '/') AS prefix FROM c"
    ),
    "object_keys": _records(
        """SELECT stream_id, replace(stream_id, chr(31), '/')
    || strftime(max(ts), '/ingest_year_month_day=%Y-%m-%d/%Y-%m-%dT%H:%M:%SZ-')
    || left(sha256(stream_id), 8) || '.jsonl.zst' AS object_key FROM c GROUP BY stream_id"""
    ),
    "ratio_text": """
SELECT o_orderkey, printf('%.1f%%', (1.0::DOUBLE - (o_custkey * 10000)::DOUBLE
    / CAST(round(o_totalprice * 100) AS BIGINT)::DOUBLE) * 100.0::DOUBLE) AS ratio FROM orders""",
    "stream_totals": _records(
        """SELECT stream_id, count(*) AS record_count, count(*) FILTER (WHERE line_bytes > 0) AS line_count,
    CAST(sum(line_bytes) AS BIGINT) AS raw_size_b, min(t) AS first_arrival_us FROM c GROUP BY stream_id"""
    ),
    "stream_catalog": _records(
        f"SELECT DISTINCT stream_id, {_CONFIG.replace('topic-signup', '')} FROM c"
    ),
    "stream_partitions": _records(
        """SELECT stream_id, topic, "partition", count(*) AS record_count,
    min("offset") AS min_offset, max("offset") AS max_offset FROM c GROUP BY ALL"""
    ),
    "initial_watermarks": _records(
        'SELECT topic, "partition", arg_min("offset", event_id) AS watermark FROM f GROUP BY ALL'
    ),
    "window_stats": _records(
        f"""SELECT {_report("count(*) FILTER (WHERE line_bytes > 0)", "floor(sum(line_bytes) / 1048576)", "86400.0")},
    epoch_us(date_trunc('day', ts)) AS window_start_us FROM c GROUP BY date_trunc('day', ts)"""
    ),
    "order_windows": f"""
SELECT {_report("count(*)", "floor(sum(floor(o_totalprice)) / 1048576)", "2592000.0")}, window_start_us
FROM (SELECT *, epoch_us(o_orderdate) // 2592000000000 * 2592000000000 AS window_start_us FROM orders)
WHERE floor(o_totalprice) > 0 GROUP BY window_start_us""",
    "run_stats": _sealed(
        f"""SELECT {_file_report("any_value(secs)")}
FROM files CROSS JOIN (SELECT (max(t) - min(t)) / 1000000 AS secs FROM c)""",
        age_us=AGE_US,
    ),
    "window_file_stats": _sealed(
        f"""SELECT {_file_report("86400.0")}, sealed_us // 86400000000 * 86400000000 AS window_start_us
FROM files WHERE seal_reason = 'size' GROUP BY window_start_us"""
    ),
    "size_seal": _sealed(_FILES),
    "age_seal": _sealed(_FILES, age_us=AGE_US),
    "final_seal": _sealed(f"{_FILES} WHERE seal_reason = 'final'"),
    "size_seal_sharded": _sealed(_FILES, shard=_LANE),
    "size_seal_sliced": _sealed(_FILES, stream="'all'", target=20 * TARGET),
    "document_seal": _sealed(_FILES, target=50 * TARGET, records=_DOCUMENTS),
    "order_seal": _sealed(_FILES, age_us=30 * AGE_US, records=_ORDERS),
    "open_streams": _sealed(_OPEN),
    "dormant_due": _sealed(f"{_OPEN} AND created_us <= (SELECT max(t) FROM f) - {AGE_US}"),
    "seal_capacity": _sealed(
        f"{_OPEN} AND created_us <= (SELECT max(t) FROM f) - {AGE_US} "
        "ORDER BY created_us, shard, stream_id LIMIT 10"
    ),
    "file_offsets": _sealed(
        _RANGES.format(keys=f"shard, stream_id, file_seq, {_KEYS}", source="filled")
    ),
    "uploaded_offsets": _sealed(f"{_UPLOADED} SELECT * FROM uploaded"),
    "committable": _sealed(f"{_UPLOADED} {_COMMITS}"),
    "committable_owned": _sealed(f'{_UPLOADED} {_COMMITS} AND "partition" < 4'),
    "outstanding": _sealed(f"{_UPLOADED} {_HELD} SELECT * FROM held"),
    "offset_backlog": _sealed(
        f"""{_UPLOADED} {_HELD} SELECT CAST(sum("end" - start + 1) AS BIGINT) AS offsets_held,
    CAST(sum("end" - start + 1) * 8 AS BIGINT) AS offsets_size_b FROM held"""
    ),
    "commit_gaps": _sealed(f"{_UPLOADED} {_GAPS}"),
    "observed_commits": f"""WITH {_DELIVERED}
SELECT topic, "partition", watermark, max("offset") + 1 AS commit_offset
FROM delivered JOIN marks USING (topic, "partition") WHERE topic <> 'NO' GROUP BY ALL""",
    "lineitem_ranges": f"{_LINES} SELECT * FROM uploaded",
    "lineitem_commits": f"{_LINES} {_COMMITS}",
    "lineitem_gaps": f"{_LINES} {_GAPS}",
    "revoke_streams": _sealed(
        """SELECT stream_id, bool_and(topic = 'topic-click' OR "partition" < 3) AS dropped
FROM filled JOIN files USING (shard, stream_id, file_seq) WHERE seal_reason = 'final' GROUP BY stream_id"""
    ),
    "landed_manifest": _sealed(
        """SELECT shard, stream_id, file_seq, record_count, line_count, raw_size_b, created_us, seal_reason,
    CASE WHEN line_count > 0 THEN 'uploaded' ELSE 'released' END AS status,
    line_count > 0 AS compressed, record_count AS offset_count FROM files""",
        shard=_LANE,
    ),
    "landed_roundtrip": _LINE_ROWS,
    "landed_source": _LINE_ROWS,
    "landed_two_runs": _LINE_ROWS,
    "landed_quarantine": _records(
        f"""SELECT topic, "partition", "offset", 'Serialization' AS error_class, {_MESSAGE}
FROM f WHERE outcome = 'decode_error'"""
    ),
    "landed_fast": _records(
        """SELECT line, replace(stream_id, chr(31), '/') AS stream, CAST(ts AS DATE) AS ingest_year_month_day
FROM f WHERE outcome = 'ok'"""
    ),
    "stream_landing": _LANDED_TOTALS,
    "landed_snapshot": _LANDED_TOTALS,
    "stream_carry": _sealed(
        "SELECT stream_id, record_count, line_count, raw_size_b, created_us, seal_reason FROM files",
        shard='"partition" % 32',
    ),
    "stream_open_files": _sealed(
        "SELECT stream_id, record_count, line_count, raw_size_b, created_us, seal_reason FROM files"
    ),
    "stream_report": _sealed(
        """SELECT CAST(sum(line_count) AS BIGINT) AS lines_taken, CAST(sum(raw_size_b) AS BIGINT) AS bytes_taken,
    CAST(sum(line_count) FILTER (WHERE seal_reason = 'size') AS BIGINT) AS record_count,
    CAST(sum(raw_size_b) FILTER (WHERE seal_reason = 'size') AS BIGINT) AS raw_size_b,
    count(*) FILTER (WHERE seal_reason = 'size') AS files_sealed,
    (SELECT count(*) FROM f WHERE outcome = 'decode_error') AS rejects FROM files"""
    ),
    "stream_commits": _records(
        'SELECT topic, "partition", max("offset") + 1 AS commit_offset FROM f GROUP BY ALL'
    ),
    "offset_log": f"""{_STEPPED} {_HELD}
SELECT topic, "partition", coalesce(commit_offset, marks.watermark) AS watermark, start, "end"
FROM marks LEFT JOIN commits USING (topic, "partition") LEFT JOIN held USING (topic, "partition")""",
}
