"""Exact similarity join of sparse unit vectors: a short bound decides which pairs are worth a product.

Every vector gets a sketch, and only pairs whose sketches reach the threshold are multiplied,
component by component. Blocks of one side go to all tasks, which hold the other side where it is:
no pair is shuffled, and nothing as wide as the vectors is ever filled with zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argulith.operators.search import _DENSE, QUERY_BLOCK_BYTES, _as_passages, _as_queries, _in_blocks
from argulith.operators.sketches import Level, Sparse, columns, least_single, width_of

_ROWS = 2_048  # rows a side whose sketches are multiplied at a time


class _Near:
    """One block of queries inside a task: partners above the bound, and pairs that had to be multiplied."""

    def __init__(self, ids: np.ndarray, held: Sparse, column: np.ndarray, above: float, once: bool) -> None:
        self.ids, self.held, self.column, self.above, self.once = ids, held, column, above, once
        self.level, self.length = Level(column), held.lengths()
        self.sketch = held.sketch(np.arange(len(held)), self.level)
        self.over = np.zeros(len(ids), dtype=np.int64)
        self.largest = np.zeros(len(ids))
        self.verified = np.zeros(len(ids), dtype=np.int64)

    def add(self, vectors: pa.Array) -> None:
        most = max(1, min(_ROWS, _DENSE // max(1, len(self.column))))
        for at in range(0, len(vectors), most):
            other = Sparse(vectors.slice(at, most))
            everyone = np.arange(len(other))
            sketch, slack = other.sketch(everyone, self.level), self.level.slack * other.lengths().max()
            points = other.dense(everyone, len(self.column))
            for low in range(0, len(self.ids), _ROWS):
                rows = np.arange(low, min(low + _ROWS, len(self.ids)))
                rows = rows[self.over[rows] == 0] if self.once else rows
                least = least_single(self.above - slack * self.length[rows])
                query, passage = np.nonzero(~(self.sketch[rows] @ sketch.T < least[:, None]))
                query = rows[query]
                for some in self._waves(query):
                    self._verify(query[some], passage[some], points)

    def _waves(self, query: np.ndarray) -> Iterator[np.ndarray]:
        """Positions to verify: all at once, or one per query, two, four, ... of the queries still without a partner."""
        left = np.arange(len(query))
        if not self.once:
            yield left
            return
        size = 1
        while len(left):
            place = np.arange(len(left)) - np.searchsorted(query[left], query[left])  # within the query
            yield left[place < size]
            left = left[place >= size]
            left = left[self.over[query[left]] == 0]
            size *= 2

    def _verify(self, query: np.ndarray, passage: np.ndarray, points: np.ndarray) -> None:
        dot = self.held.products(query, passage, points)
        np.add.at(self.verified, query, 1)
        np.add.at(self.over, query, dot > self.above)
        np.maximum.at(self.largest, query, dot)

    def batch(self) -> pa.RecordBatch:
        met = self.verified > 0
        columns = [pa.array(c[met]) for c in (self.ids, self.over, self.largest, self.verified)]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "n_above", "largest", "verified"])


_PARTIAL = "query_id long, n_above long, largest double, verified long"


def near_partners(
    queries: DataFrame, corpus: DataFrame, above: float, query_id: str = "doc_id", corpus_id: str = "doc_id",
    vector: str = "vector", once: bool = False, block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """``(query_id, n_above, max_above, verified)`` of the queries that have a partner above the bound, or nearly.

    Exact for sparse vectors of length 1 or less, as ``TfIdf.encode`` makes them. ``n_above`` counts the corpus
    rows whose inner product exceeds ``above``, ``max_above`` is the largest product if one does (else
    null), ``verified`` the pairs that were multiplied at all; queries without such a pair have no row.

    ``once`` asks for existence only: a task that has found a query's partner leaves that query alone, so a
    group of near copies costs a few products a row and task instead of one per pair; counts are then lower bounds.
    """
    spark = corpus.sparkSession

    def run(passages: DataFrame, block: pa.Table, shared: list) -> DataFrame:
        vectors = block["vector"].combine_chunks()
        width, held = width_of(vectors), Sparse(vectors)
        column = columns(width, np.bincount(held.index, held.value**2, width))
        sent = spark.sparkContext.broadcast((block["query_id"].to_numpy(), held, column))
        shared.append(sent)

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near = _Near(*sent.value, above, once)
            for batch in batches:
                if batch.num_rows:
                    width_of(batch.column("vector"), len(near.column))
                    near.add(batch.column("vector"))
            yield near.batch()

        partial = passages.select("vector").mapInArrow(join, _PARTIAL)
        return partial.groupBy("query_id").agg(
            F.sum("n_above").alias("n_above"),
            F.when(F.sum("n_above") > 0, F.max("largest")).alias("max_above"),
            F.sum("verified").alias("verified"),
        )

    schema = "query_id long, n_above long, max_above double, verified long"
    return _in_blocks(
        _as_queries(queries, query_id, vector), _as_passages(corpus, corpus_id, vector), run, schema, block_bytes, 4
    )
