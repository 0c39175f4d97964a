"""Exact top-k by inner product of integer vectors: exhaustive, term at a time.

Candidates are dealt once and stay where they are; a block of queries at a time is sent to all of them. A task takes
its candidates in chunks, in each of which every dimension (term) has a posting list of candidates and weights. A
query's non-zero components scatter their weighted postings into one dense array of scores, a partition picks the k best,
and the winners of chunks and of tasks are merged. No pair of rows ever leaves a task but k per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argulith.llm.common import query, table
from argulith.session import scratch_path, stage

CHUNK_ROWS = 32_768
BLOCK_BYTES = 64 * 1024 * 1024  # of a block's queries and of the hits that a task holds for them


def scaled(vector: Column) -> Column:
    """floor(256 * x) of every component, as longs; null if a component is null or not finite.

    Components beyond the range of a long become its ends.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def postings(vectors: list[np.ndarray]) -> list[tuple]:
    """Per dimension: the vectors that are not zero there, and their weights."""
    terms = max(map(len, vectors), default=0)
    lengths = np.array([len(v) for v in vectors], dtype=np.int64)
    dense = np.zeros((len(vectors), terms), dtype=np.int64)
    dense[np.arange(terms) < lengths[:, None]] = np.concatenate(vectors) if terms else 0
    lists = []
    for term in range(terms):
        column = dense[:, term]
        rows = np.flatnonzero(column)
        # A list of all vectors needs no row numbers.
        lists.append((slice(None), column.copy()) if len(rows) == len(vectors) else (rows, column[rows]))
    return lists


def accumulate(vector: np.ndarray, lists: list[tuple], scores: np.ndarray) -> None:
    """Scores of all vectors behind ``lists`` against one query, wrapping like longs."""
    scores[:] = 0
    for term in np.flatnonzero(vector[: len(lists)]):
        rows, weights = lists[term]
        scores[rows] += vector[term] * weights


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller positions, in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    bound = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > bound)
    return np.concatenate([above, np.flatnonzero(scores == bound)[: k - len(above)]])


def _chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches put together until they have about ``rows`` rows, in the order of ids."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held).sort_values("vec_id", kind="stable")
            held = []
    if sum(map(len, held)):
        yield pd.concat(held).sort_values("vec_id", kind="stable")


def _merge(ids: np.ndarray, scores: np.ndarray, more_ids: np.ndarray, more_scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, scores = np.concatenate([ids, more_ids]), np.concatenate([scores, more_scores])
    order = np.lexsort((ids, ~scores))[:k]  # ~s falls as s grows, without overflow
    return ids[order], scores[order]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, chunk_rows: int = CHUNK_ROWS, block_rows: int | None = None
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows of ``vectors`` with the highest inner products.

    Both tables have ``vec_id`` (long) and ``ints`` (array of long). A query's own id is no candidate;
    with fewer than k candidates all of them are returned. Ties go to the smaller id. Vectors of
    different lengths are compared as if the shorter one ended in zeros; sums wrap like longs.
    Rows with a null id or vector take no part. Repeated candidates are returned each; a
    repeated query is answered once per row. Empty tables give no rows.

    Candidates are shuffled once, whatever the number of blocks; what is sent is a block of queries, about
    ``block_rows`` of them, by default as many as fit ``BLOCK_BYTES``. Blocks follow one another and append their hits to a table.
    """
    usable = F.col("vec_id").isNotNull() & F.col("ints").isNotNull()
    spark = vectors.sparkSession
    asked = queries.filter(usable).select("vec_id", "ints").withColumn("row", F.monotonically_increasing_id())
    asked = stage(asked, "asked")
    held = vectors.filter(usable).select("vec_id", "ints")
    chunks = max(-(-held.count() // chunk_rows), spark.sparkContext.defaultParallelism)
    held = stage(held.repartition(chunks), "held")
    rows, width = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("ints")), F.lit(0))).first()
    blocks = -(-rows // (block_rows or max(1, BLOCK_BYTES // (8 * (width + 2 * k + 2)))))
    if blocks > 1:
        asked = stage(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "asked", "block")
    schema = "query_id long, query_row long, vec_id long, score long"
    path = scratch_path(spark, "found")
    spark.createDataFrame([], schema).write.parquet(path)
    for n in range(blocks):
        some = (asked.filter(F.col("block") == n) if blocks > 1 else asked).select("vec_id", "row", "ints").toPandas()
        block = spark.sparkContext.broadcast(
            (some["vec_id"].to_numpy(np.int64), some["row"].to_numpy(np.int64), [np.asarray(v, dtype=np.int64) for v in some["ints"]])
        )
        _search(held, block, k, chunk_rows, schema).write.mode("append").parquet(path)
        block.destroy()
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(order))
    return found.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(held: DataFrame, block, k: int, chunk_rows: int, schema: str) -> DataFrame:
    """The k best of every task's candidates for each query of the block that was sent."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, query_rows, vectors = block.value
        none = np.empty(0, dtype=np.int64)
        kept = [(none, none)] * len(vectors)
        for candidates in _chunks(batches, chunk_rows):
            ids = candidates["vec_id"].to_numpy(np.int64)
            lists = postings([np.asarray(v, dtype=np.int64) for v in candidates["ints"]])
            scores = np.zeros(len(ids), dtype=np.int64)
            for n, (query_id, ints) in enumerate(zip(query_ids, vectors)):
                accumulate(ints, lists, scores)
                first, last = np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, "right")
                others = np.delete(scores, slice(first, last)) if last > first else scores
                at = best(others, k)
                at = at + (at >= first) * (last - first)  # as if the own rows had not been taken out
                kept[n] = _merge(*kept[n], ids[at], scores[at], k)
        sizes = [len(ids) for ids, _ in kept]
        if sum(sizes):
            yield pd.DataFrame(
                {
                    "query_id": np.repeat(query_ids, sizes),
                    "query_row": np.repeat(query_rows, sizes),
                    "vec_id": np.concatenate([ids for ids, _ in kept]),
                    "score": np.concatenate([scores for _, scores in kept]),
                }
            )

    return held.mapInPandas(search, schema)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.ints) + 1), lambda i: q.ints[i] * c.ints[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query("op7_exact_topk", OP7_SQL)
def op7_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The five best rows of every query, a row whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("ints"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
