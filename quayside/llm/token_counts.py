"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes is committed once, as a folder with its sums by key. `fold` adds the batches
since the last time to the totals and writes new ones beside the old, with the list of the
batches that they hold; `rollup` reads the newest totals and the batches that are not among them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import exists, slices
from quayside.llm.tokens import VOCABULARY, word_bytes

#: Tokenizer version -> vocabulary file; None counts words between ASCII white space.
TOKENIZERS = {"byte_bpe_50k/1": VOCABULARY, "words/1": None}
KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def count_tokens(docs: DataFrame, tokenizers: dict[str, str | None] = TOKENIZERS) -> DataFrame:
    """The tokens of each document under each tokenizer: doc_id, source, lang, tokenizer, n_tokens.

    A null text has no tokens. Rows are counted as they are, repeated ones too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            for name, path in tokenizers.items():
                if path is None:
                    sizes = [len((t or "").encode().split()) for t in texts]
                else:
                    encode = word_bytes(path).encode
                    sizes = [len(encode(t)) // 4 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["source"], batch["lang"], pa.array([name] * len(sizes), pa.string()), pa.array(sizes, pa.int64())],
                    ["doc_id", "source", "lang", "tokenizer", "n_tokens"],
                )

    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")),
    )
    return plain.mapInArrow(count, "doc_id long, source string, lang string, tokenizer string, n_tokens long")


def signed(counted: DataFrame, sign: int) -> DataFrame:
    """Counted documents as changes: `sign` is 1 for rows that arrive and -1 for rows that go."""
    return counted.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (F.lit(sign) * F.col("n_tokens")).alias("n_tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """A revision takes the old count away and adds the new one, wherever each belongs."""
    return signed(before, -1).unionByName(signed(after, 1))


def commit(spark: SparkSession, path: str, batch_id: str, changes: DataFrame) -> bool:
    """Adds a batch of changes to the rollup at `path`, once: False if the batch is there already.

    A batch is a folder with its sums by key, of a few rows per key. It counts from the moment
    that Spark's committer marks it complete; a failed attempt leaves nothing that is read, and a
    repeated one overwrites it.
    """
    folder = f"{path}/batch={batch_id}"
    if exists(spark, f"{folder}/_SUCCESS"):
        return False
    sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    sums.write.mode("overwrite").parquet(folder)
    return True


def _marks(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that Spark's committer marked complete, by name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def batches(spark: SparkSession, path: str) -> list[str]:
    """The committed batches: the name of one folder each, found in one listing."""
    return sorted(folder.rsplit("/", 1)[1] for folder in _marks(spark, f"{path}/batch=*"))


def _summed(rows: DataFrame) -> DataFrame:
    """Sums by key; keys whose documents are all gone add nothing to any total and go."""
    sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.filter("n_docs <> 0 OR n_tokens <> 0")


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)


def _totals(spark: SparkSession, path: str) -> tuple[int, DataFrame, set[str]]:
    """The newest complete totals: their number, their rows and the names of the batches in them."""
    found = max((f.rsplit("/", 2)[1] for f in _marks(spark, f"{path}/totals/*/batches")), default=None)
    if found is None:
        return 0, _read(spark, []), set()
    names = spark.read.schema("batch string").parquet(f"{path}/totals/{found}/batches").collect()
    return int(found.split("-")[0]), _read(spark, [f"{path}/totals/{found}/sums"]), {r["batch"] for r in names}


def _since(spark: SparkSession, path: str, held: set[str]) -> list[str]:
    return [name for name in batches(spark, path) if name not in held]


def fold(spark: SparkSession, path: str) -> bool:
    """Writes new totals that hold all committed batches: False if there is no new one.

    Reads the totals before and the batches since. The list of batches is written last and makes
    the totals count, so a failed attempt is never read. Nothing is replaced or removed: batches
    may be committed, and totals folded, at the same time, and any complete totals together with the
    batches they lack give the same rollup. Lists of batches, not documents, pass the driver.
    """
    number, totals, held = _totals(spark, path)
    fresh = _since(spark, path, held)
    if not fresh:
        return False
    root = f"{path}/totals/{number + 1:012d}-{uuid.uuid4().hex[:8]}"
    _summed(totals.unionByName(_read(spark, [f"{path}/{name}" for name in fresh]))).write.parquet(f"{root}/sums")
    listed = spark.createDataFrame([(name,) for name in sorted(held | set(fresh))], "batch string")
    listed.coalesce(1).write.parquet(f"{root}/batches")
    return True


def rollup(spark: SparkSession, path: str) -> DataFrame:
    """The totals after all committed batches; keys whose documents are all gone are left out.

    Reads the newest totals and the batches since. Null source and lang are keys of their own;
    repeated rows count as often as they came. A path without a batch has no rows.
    """
    _, totals, held = _totals(spark, path)
    return _summed(totals.unionByName(_read(spark, [f"{path}/{name}" for name in _since(spark, path, held)])))
