"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import collocations, decontaminate, language, licenses, near_duplicates, packing, pii, quality, runs, scoring, token_counts, topk, warc
from quayside.llm.common import stage, table
from quayside.session import work_dir


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup after the documents arrived, some were withdrawn and some revised, and a batch came twice."""
    docs = table(spark, sf_dir, "documents")
    counted = stage(token_counts.count_tokens(docs), "token-counts")
    changed = docs.filter("doc_id % 50 = 11")
    changed = changed.withColumn("text", F.concat("text", F.lit("\n"), "text")).withColumn("lang", F.lit("rev"))
    path = work_dir(spark, "token-rollup")
    revise = token_counts.revised(counted.filter("doc_id % 50 = 11"), token_counts.count_tokens(changed))
    withdraw = token_counts.signed(counted.filter("doc_id % 50 = 7"), -1)
    token_counts.commit(spark, path, "load", token_counts.signed(counted, 1))
    token_counts.fold(spark, path)
    for _ in range(2):  # the second time changes nothing
        token_counts.commit(spark, path, "withdraw", withdraw)
        token_counts.commit(spark, path, "revise", revise)
    return token_counts.rollup(spark, path)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), ids=False)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_held_out(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_token_counts,
        op3_language,
        op4_packing,
        op5_lm_score,
        op6_near_duplicates,
        op7_warc,
        op8_decontaminate,
        op9_top_k,
        op10_licenses,
        op11_periodic_runs,
        op12_collocations,
        op13_quality,
    )
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op6_near_duplicates": near_duplicates.ORACLE,
    "op7_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
    substr('{_BASE32}', CAST((CAST('0x' || substr(hex, CAST(i * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')), '')
    AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN largest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN largest > page_id THEN largest END AS refers_to FROM m""",
    "op9_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10""",
    "op10_licenses": licenses.oracle(),
    "op12_collocations": collocations.ORACLE,
}
