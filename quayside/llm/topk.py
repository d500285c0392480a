"""Exact search for the largest inner products by the threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import groups_of

SCALE = 1024
TOP = 10
#: Rows whose sorted lists a task holds at a time.
BLOCK_ROWS = 8192
#: Queries that are sent to the tasks at a time; larger query sets take more passes.
QUERY_BLOCK = 4096
LONG = 2**63
FOUND = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as floor(scale * x); null and non-finite vectors are left out."""
    x = F.col("embedding").cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(usable & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * float(scale)).cast("long")).alias("v"),
    )


class SortedLists:
    """Rows of one length with, per dimension, their numbers in the order of that component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, vec_id) but for the query's own row; ties to the smaller vec_id.

        Each round reads on in all lists, from the end that suits the sign of the query there,
        and scores the rows that it has not met. No row further down can score more than the
        query with the values just read, so the search ends once the kth best is above that.
        """
        n = len(self.ids)
        dims = np.flatnonzero(query)
        if not len(dims):  # every row scores 0: the smallest ids win
            best = np.sort(self.ids[self.ids != query_id], kind="stable")[:k]
            return [(0, int(i)) for i in best]
        up = query[dims] > 0
        seen = self.ids == query_id
        scores, ids = np.empty(0, query.dtype), np.empty(0, np.int64)
        depth, step = 0, max(8, n // 64)
        while depth < n:
            upto = min(n, depth + step)
            read = np.concatenate(
                [self.order[n - upto : n - depth, dims[up]].ravel(), self.order[depth:upto, dims[~up]].ravel()]
            )
            new = np.zeros(n, bool)
            new[read] = True
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new)
            if len(at):
                scores = np.concatenate([scores, self.rows[at] @ query])
                ids = np.concatenate([ids, self.ids[at]])
                keep = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[keep], ids[keep]
            edge = np.where(up, self.sorted[n - upto, dims], self.sorted[upto - 1, dims])
            if len(ids) == k and scores[-1] > edge @ query[dims]:
                break
            depth, step = upto, step * 2
        return list(zip(scores.tolist(), ids.tolist(), strict=True))


def _exact(rows: list[np.ndarray]) -> np.ndarray:
    """Integers as doubles while every inner product stays exact there, else as Python integers."""
    most = max((int(np.abs(r).max()) for r in rows if len(r)), default=0)
    width = max((len(r) for r in rows), default=0)
    return np.array(rows, np.float64 if most * most * width < 2**52 else object)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """The k largest integer inner products of each query with all other rows.

    Rows: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. `queries` has the
    columns of `vectors`. A row is not its own candidate: rows with the query's vec_id are left
    out. Fewer than k other rows give them all; only rows of the query's own length are compared.
    Vectors that are null or hold null or non-finite components, and rows without vec_id, take no
    part. Repeated rows are one row. Scores beyond the range of a long are its ends. Tables without rows give none.

    Each task sorts the components of its rows, block by block, and runs the threshold algorithm
    for every query; per block and query k rows go to the final ranking. Queries are sent to the
    tasks in blocks of a fixed number, one pass over the rows for each.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, scale)
    asked = integers(queries, scale).dropDuplicates()
    passes = groups_of(asked.count(), QUERY_BLOCK // 2)
    asked = asked.withColumn("__part", F.pmod(F.xxhash64("vec_id"), F.lit(passes)))
    found = None
    for part in range(passes):
        block = spark.sparkContext.broadcast(
            [(r["vec_id"], np.array(r["v"], np.int64)) for r in asked.filter(F.col("__part") == part).collect()]
        )
        hits = rows.mapInArrow(_searcher(block, k), FOUND)
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _searcher(block, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            out: list[tuple[int, int, int]] = []
            rows = list({(i, v.tobytes()): (i, v) for i, v in held}.values())
            for width in {len(v) for _, v in rows}:
                mine = [x for x in rows if len(x[1]) == width]
                asked = [x for x in block.value if len(x[1]) == width]
                if not asked:
                    continue
                both = _exact([v for _, v in mine] + [v for _, v in asked])
                lists = SortedLists(np.array([i for i, _ in mine], np.int64), both[: len(mine)])
                for (query_id, _), query in zip(asked, both[len(mine) :], strict=True):
                    out += [(query_id, i, min(max(int(s), -LONG), LONG - 1)) for s, i in lists.search(query_id, query, k)]
            columns = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        for batch in batches:
            for vec_id, v in zip(batch["vec_id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                held.append((vec_id, np.array(v, np.int64)))
                if len(held) == BLOCK_ROWS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return search
