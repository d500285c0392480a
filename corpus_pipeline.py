"""A corpus pipeline: each stage is one of the operators, over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import decontaminate, language, near_duplicates, packing, pii
from quayside.llm.common import stage, table
from quayside.session import prepare

#: Bytes of an Arrow batch; whole documents go through Python, and a batch is held on both sides.
BATCH_BYTES = 4 << 20
#: A document of which no language has this share is in none.
LEAST_SHARE = 0.35


def _prepare(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no language with a fair share.

    The model is learned from the documents' own lang values, those of three folds in four.
    """
    _prepare(spark)
    return language.keep_identified(docs, LEAST_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate group."""
    _prepare(spark)
    return near_duplicates.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    _prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts marks in place of personal data; all documents stay."""
    _prepare(spark)
    return pii.redact(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences; a row per piece, with its token ids."""
    _prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_redaction", pii_redaction),
    ("token_packing", token_packing),
]

#: Packing and tokenizing are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`, each written and read again."""
    _prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
