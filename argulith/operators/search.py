"""Exact and cell-pruned nearest neighbours by inner product.

A bounded block of queries is sent to all tasks; each task multiplies it with its own passages in
Arrow batches and keeps the k best per query, so the passages are neither shuffled nor paired up
row by row. What leaves a task is at most k rows per query. More queries than fit the bound are
searched block after block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argulith.functions.vectors import as_double, matrix_of
from argulith.operators.bounded import broadcast_bounded
from argulith.operators.ranking import sample_n
from argulith.operators.sketches import GROUPS, HEAVY, Sparse, columns, least_single, levels, width_of
from argulith.session import scratch_path, spread, stage

QUERY_BLOCK_BYTES = 64 * 1024 * 1024
SCORE_PLACES = 12  # scores that agree so far are ties, whatever order a product was summed in
_ROUNDING = 10.0**-SCORE_PLACES
_PRODUCT_ROWS = 2_048  # queries times passages held as one dense product
_DENSE = 1 << 21  # numbers of sparse vectors that stand with their zeros at a time
_FEW = 256  # passages that stand with their zeros before sparse queries at a time
_GROUP = 4 * _PRODUCT_ROWS  # sparse queries that meet them one part after the other
_SEVERAL = 32  # one in so many pairs may remain before the best bounds are tried first


def topk_per_query(hits: DataFrame, k: int, query_col: str = "query_id", id_col: str = "id", score_col: str = "score") -> DataFrame:
    """The k best hits per query, ties by passage key; every task limits its rows before the shuffle."""
    order = Window.partitionBy(query_col).orderBy(F.desc(score_col), F.asc(id_col))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise k best of a score matrix, by score descending, then id."""
    if scores.shape[1] > k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        keep = scores >= kth  # all ties of the last place
        width = int(keep.sum(axis=1).max())
        at = np.argsort(~keep, axis=1, kind="stable")[:, :width]
        scores = np.where(np.take_along_axis(keep, at, 1), np.take_along_axis(scores, at, 1), -np.inf)
        ids = np.take_along_axis(np.broadcast_to(ids, keep.shape), at, 1)
    else:
        ids = np.broadcast_to(ids, scores.shape)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


class _Block:
    """One query block inside a task: the running k best of every query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: tuple[np.ndarray, np.ndarray] | None = None):
        self.ids, self.vectors, self.k, self.floor = ids, vectors, k, floor
        self.scores = np.full((len(ids), k), -np.inf)
        self.hits = np.zeros((len(ids), k), dtype=np.int64)

    def _merge_all(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Queries without k hits yet: any passage may be one."""
        scores, ids = _best(np.round(scores, SCORE_PLACES), ids, self.k)
        both = np.concatenate([self.scores[rows], scores], axis=1)
        found = np.concatenate([self.hits[rows], ids], axis=1)
        order = np.lexsort((found, -both), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(both, order, 1)
        self.hits[rows] = np.take_along_axis(found, order, 1)

    def _merge_better(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Queries with k hits: only passages that reach the last of them matter, which are few."""
        bound = self.scores[rows, -1] - _ROUNDING
        row, column = np.nonzero(scores >= bound[:, None])
        self._merge_pairs(rows[row], scores[row, column], ids[column])

    def _merge_pairs(self, row: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        touched = np.unique(row)
        at = np.concatenate([np.repeat(touched, self.k), row])
        value = np.concatenate([self.scores[touched].ravel(), np.round(scores, SCORE_PLACES)])
        found = np.concatenate([self.hits[touched].ravel(), ids])
        order = np.lexsort((found, -value, at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        keep = order[place < self.k]
        self.scores[touched] = value[keep].reshape(-1, self.k)
        self.hits[touched] = found[keep].reshape(-1, self.k)

    def _merge(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        full = np.isfinite(self.scores[rows, -1])
        if full.all():
            self._merge_better(rows, scores, ids)
            return
        self._merge_all(rows[~full], scores[~full], ids)
        if full.any():
            self._merge_better(rows[full], scores[full], ids)

    def add(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray) -> None:
        for q in range(0, len(queries), _PRODUCT_ROWS):
            rows = queries[q : q + _PRODUCT_ROWS]
            for p in range(0, len(ids), _PRODUCT_ROWS):
                self._merge(rows, self.vectors[rows] @ vectors[p : p + _PRODUCT_ROWS].T, ids[p : p + _PRODUCT_ROWS])

    def batch(self) -> pa.RecordBatch:
        real = np.isfinite(self.scores)
        if self.floor is not None:
            least, last = (part[:, None] for part in self.floor)
            real &= (self.scores > least) | ((self.scores > least - 2 * _ROUNDING) & (self.hits <= last))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(self.ids, real.sum(axis=1)), pa.int64()),
                pa.array(self.hits[real], pa.int64()),
                pa.array(self.scores[real], pa.float64()),
            ],
            names=["query_id", "id", "score"],
        )


class _Totals:
    """One query block inside a task: count, sum, maximum and number above a bound per query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, above: float):
        self.ids, self.vectors, self.above = ids, vectors, above
        self.count = np.zeros(len(ids), dtype=np.int64)
        self.total = np.zeros(len(ids))
        self.largest = np.full(len(ids), -np.inf)
        self.over = np.zeros(len(ids), dtype=np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray) -> None:
        for q in range(0, len(queries), _PRODUCT_ROWS):
            rows = queries[q : q + _PRODUCT_ROWS]
            for p in range(0, len(ids), _PRODUCT_ROWS):
                scores = self.vectors[rows] @ vectors[p : p + _PRODUCT_ROWS].T
                self.count[rows] += scores.shape[1]
                self.total[rows] += scores.sum(axis=1)
                self.largest[rows] = np.maximum(self.largest[rows], scores.max(axis=1))
                self.over[rows] += (scores > self.above).sum(axis=1)

    def batch(self) -> pa.RecordBatch:
        met = self.count > 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids[met], pa.int64()),
                pa.array(self.count[met]),
                pa.array(self.total[met]),
                pa.array(self.largest[met]),
                pa.array(self.over[met]),
            ],
            names=["query_id", "n", "total", "largest", "n_above"],
        )


class _Pruned:
    """One block of sparse queries inside a task: sketches leave few pairs whose components are multiplied.

    ``_floor`` says which products of a query still matter; a pair whose sketches stay below it is left out. A few passages at
    a time stand with their zeros and meet some queries after the other, so that bounds and components stay in the cache.
    Passages of more components have longer sketches, which bound them as closely as short ones bound the others. Queries for which
    many passages remain meet them in a dense product.
    """

    def _hold(self, held: Sparse, column: np.ndarray) -> None:
        self.held, self.column, self.length = held, column, held.lengths()
        self.few = max(1, min(_FEW, _DENSE // max(1, len(column))))
        self.first = max(8, 2 * getattr(self, "k", 1))
        self.empty, self.asking = np.flatnonzero(self.length == 0), np.flatnonzero(self.length != 0)
        self.levels = levels(column, np.bincount(held.index, held.value**2, len(column)))
        self.sketch = held.sketch(self.asking, self.levels[0])

    def add(self, ids: np.ndarray, vectors: pa.Array) -> None:
        some = Sparse(vectors)
        self._count(some)
        self._merge_zeros(ids)
        fitting = np.searchsorted([level.most for level in self.levels[:-1]], some.length)
        lengths = some.lengths()
        for n, level in enumerate(self.levels):
            held = np.flatnonzero(fitting == n)
            group = _GROUP if n else max(1, len(self.asking))  # longer sketches are held for some queries at a time
            for q in range(0, len(self.asking) if len(held) else 0, group):
                rows = self.asking[q : q + group]
                sketch = self.held.sketch(rows, level) if n else self.sketch
                for at in range(0, len(held), self.few):
                    passages = held[at : at + self.few]
                    points, short = some.dense(passages, len(self.column)), some.sketch(passages, level)
                    slack = level.slack * lengths[passages].max()
                    for low in range(0, len(rows), _PRODUCT_ROWS):
                        part = slice(low, low + _PRODUCT_ROWS)
                        self._meet(rows[part], short @ sketch[part].T, points, ids[passages], slack, level.whole)

    def _meet(self, rows: np.ndarray, bound: np.ndarray, points: np.ndarray, known: np.ndarray, slack: float, whole: bool) -> None:
        """Queries and a few passages, a row of ``bound`` for every passage."""
        least = self._least(rows, slack)
        new = np.flatnonzero(np.isneginf(least))
        if len(new):  # the pairs with the largest bounds first: they raise the floor for the others
            best = np.argpartition(bound[:, new], -min(self.first, len(known)), axis=0)[-min(self.first, len(known)) :]
            self._verify(rows, np.tile(new, len(best)), best.ravel(), points, known)
            least = self._least(rows, slack)
        below = bound < least
        reach = np.logical_not(below, out=below)  # what is no number is not below the floor
        if len(new):
            reach[best, new] = False
        if whole:
            self._settle(rows, bound, reach, slack)
        cell = np.flatnonzero(reach)
        passage, row = np.divmod(cell, len(rows))
        if len(row) > reach.size // _SEVERAL:  # again the larger bounds first
            upper = bound.ravel()[cell] >= ((bound.max(axis=0) + least) / 2)[row]
            self._verify(rows, row[upper], passage[upper], points, known)
            left = ~(upper | (bound.ravel()[cell] < self._least(rows, slack)[row]))
            row, passage = row[left], passage[left]
        many = np.bincount(row, minlength=len(rows)) > len(known) // 16
        if many.any():
            dense, place = many[row], np.cumsum(many) - 1
            scores = points @ self.held.dense(rows[many], len(self.column)).T
            self._merge_pairs(rows[row[dense]], scores[passage[dense], place[row[dense]]], known[passage[dense]])
            row, passage = row[~dense], passage[~dense]
        self._verify(rows, row, passage, points, known)

    def _least(self, rows: np.ndarray, slack: float) -> np.ndarray:
        return least_single(self._floor(rows) - slack * self.length[rows])

    def _verify(self, rows: np.ndarray, row: np.ndarray, passage: np.ndarray, points: np.ndarray, known: np.ndarray) -> None:
        self._merge_pairs(rows[row], self.held.products(rows[row], passage, points), known[passage])

    def _count(self, some: Sparse) -> None:
        pass

    def _settle(self, rows: np.ndarray, bound: np.ndarray, reach: np.ndarray, slack: float) -> None:
        pass


class _SparseBlock(_Pruned, _Block):
    """``_Block`` for sparse vectors."""

    def __init__(self, ids: np.ndarray, held: Sparse, column: np.ndarray, k: int, floor: tuple[np.ndarray, np.ndarray] | None = None):
        _Block.__init__(self, ids, held, k, floor)
        self._hold(held, column)

    def _floor(self, rows: np.ndarray) -> np.ndarray:
        last = self.scores[rows, -1]
        return (last if self.floor is None else np.maximum(last, self.floor[0][rows])) - 2 * _ROUNDING

    def _merge_pairs(self, row: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        better = ~(scores < self.scores[row, -1] - _ROUNDING)
        super()._merge_pairs(row[better], scores[better], ids[better])

    def _merge_zeros(self, known: np.ndarray) -> None:
        """Queries without components have the same product with all passages: the smallest keys are their hits."""
        first = np.partition(known, self.k - 1)[: self.k] if len(known) > self.k else known
        self._merge_pairs(np.repeat(self.empty, len(first)), np.zeros(len(self.empty) * len(first)), np.tile(first, len(self.empty)))


class _SparseTotals(_Pruned, _Totals):
    """``_Totals`` for sparse vectors: sums come from the sum of the passages, the rest from the pairs that matter."""

    def __init__(self, ids: np.ndarray, held: Sparse, column: np.ndarray, above: float):
        _Totals.__init__(self, ids, held, above)
        self._hold(held, column)
        self.largest[:] = -np.inf
        self.sum = np.zeros(len(column))

    def _floor(self, rows: np.ndarray) -> np.ndarray:
        return np.minimum(self.largest[rows], self.above)

    def _count(self, some: Sparse) -> None:
        self.count += len(some)
        self.sum += np.bincount(some.index, some.value, len(self.sum))

    def _settle(self, rows: np.ndarray, bound: np.ndarray, reach: np.ndarray, slack: float) -> None:
        """Products known to single precision that are surely above the bound, and not the largest, need no more than to be counted."""
        margin = slack * self.length[rows]
        sure = (bound > -least_single(-self.above - margin)) & (bound < least_single(self.largest[rows] - margin)) & reach
        self.over[rows] += np.count_nonzero(sure, axis=0)
        reach &= ~sure

    def _merge_zeros(self, known: np.ndarray) -> None:
        self.largest[self.empty] = np.maximum(self.largest[self.empty], 0.0)
        self.over[self.empty] += len(known) if self.above < 0 else 0

    def _merge_pairs(self, row: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        np.maximum.at(self.largest, row, scores)
        np.add.at(self.over, row, scores > self.above)

    def batch(self) -> pa.RecordBatch:
        rows = np.arange(len(self.ids))
        self.total = np.zeros(len(rows))
        self.total[:] = self.held.products(rows, np.zeros(len(rows), dtype=np.int64), self.sum[None, :]) if len(self.sum) else 0.0
        return super().batch()


_ON_SPARSE = {_Block: _SparseBlock, _Totals: _SparseTotals}


def _sparse_product(corpus: DataFrame, queries: pa.Table, state, schema: str, shared: list) -> DataFrame:
    """``_product`` for sparse vectors, which travel and are held without their zeros."""
    vectors = queries["vector"].combine_chunks()
    width, held = width_of(vectors), Sparse(vectors)
    column = columns(width, np.bincount(held.index, held.value**2, width))
    block = corpus.sparkSession.sparkContext.broadcast((queries["query_id"].to_numpy(), vectors, column))
    shared.append(block)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, places = block.value
        kept = state(ids, Sparse(rows), places)
        for batch in batches:
            if batch.num_rows:
                width_of(batch.column("vector"), len(places))
                kept.add(batch.column("id").to_numpy(zero_copy_only=False), batch.column("vector"))
        yield kept.batch()

    return corpus.select("id", "vector").mapInArrow(multiply, schema)


def _product(corpus: DataFrame, queries: pa.Table, state, schema: str, by_cell: bool, shared: list) -> DataFrame:
    """Run one query block against every passage, task by task; ``state`` says what to keep.

    The block's broadcast is added to ``shared``, for the caller to destroy when its rows are written.
    """
    if not by_cell and pa.types.is_struct(queries.schema.field("vector").type) and _sparse(corpus, "vector"):
        return _sparse_product(corpus, queries, partial(_ON_SPARSE[state.func], *state.args, **state.keywords), schema, shared)
    vectors = matrix_of(queries["vector"])
    probed = _bits_of(queries["cells"]) if by_cell else None
    block = corpus.sparkSession.sparkContext.broadcast((queries["query_id"].to_numpy(), vectors, probed))
    shared.append(block)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, by = block.value
        kept = state(ids, matrix)
        everyone = np.arange(len(ids))
        for batch in batches:
            if not batch.num_rows:
                continue
            passages = batch.column("id").to_numpy(zero_copy_only=False)
            if not by_cell:
                for at in range(0, len(passages), _PRODUCT_ROWS):
                    points = matrix_of(batch.column("vector").slice(at, _PRODUCT_ROWS), matrix.shape[1])
                    kept.add(passages[at : at + _PRODUCT_ROWS], points, everyone)
                continue
            points = matrix_of(batch.column("vector"), matrix.shape[1])
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            for cell in np.unique(cells):
                asking = np.flatnonzero(by[:, cell >> 3] & (128 >> (cell & 7)))
                if len(asking):
                    inside = cells == cell
                    kept.add(passages[inside], points[inside], asking)
        yield kept.batch()

    if not by_cell:
        return corpus.select("id", "vector").mapInArrow(multiply, schema)
    cells = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(probed, axis=0))).tolist()
    held = corpus.filter(F.col("cell").isin(cells))  # prunes folders of a stored index
    return held.select("id", "vector", "cell").mapInArrow(multiply, schema)


def _blocks(queries: DataFrame, rows: int, most: int, order: list[Column]) -> tuple[DataFrame, int]:
    """Staged queries with a ``block`` column, in ranges of ``order``, at most ``most`` rows each."""
    same = queries.groupBy("query_id").count().agg(F.max("count")).first()[0]
    if same > most:
        raise ValueError(f"a query key stands in {same} rows, a block holds {most}")
    parts = -(-rows // most)
    while True:
        ranged = queries.repartitionByRange(parts, *order).withColumn("block", F.spark_partition_id())
        blocked = stage(ranged, "blocks", "block")
        largest = blocked.groupBy("block").count().agg(F.max("count")).first()[0]
        if largest <= most:
            return blocked, parts
        parts *= 2  # a key fits a block, so the ranges shrink until every block does


def _in_blocks(
    queries: DataFrame,
    corpus: DataFrame,
    run: Callable[[DataFrame, pa.Table, list], DataFrame],
    schema: str,
    block_bytes: int,
    kept: int,
    by_cell: bool = False,
) -> DataFrame:
    """``run`` for all queries against the corpus, in blocks of queries that each fit the bound.

    The queries are staged and measured before any is fetched: a block is bounded by the bytes of its
    vectors and of the ``kept`` numbers that a task holds per query. The usual query set is one
    block, and the result a lazy plan. More blocks are run one after the other, each appending to a
    table in the shared folder, so that never more than one block is held anywhere. Queries that
    start from the same cell share a block, which therefore reads few cells; without cells the corpus
    is staged, so that no block computes it again, and so are sparse passages, on all cores.
    """
    spark = corpus.sparkSession
    queries = stage(queries, "queries")
    bytes_of = _held_bytes(queries, kept)
    rows, usual, largest = queries.agg(F.count(F.lit(1)), F.avg(bytes_of), F.max(bytes_of)).first()
    if not rows:
        return spark.createDataFrame([], schema)
    most = max(1, int(block_bytes // max(usual, largest / 4)))  # the longest vectors may meet in one block
    if _sparse(corpus, "vector") or (rows > most and not by_cell):
        corpus = stage(corpus, "passages")
        wide = spread(corpus)  # what a shuffle has left in few files is few tasks' work otherwise
        corpus = corpus if wide is corpus else stage(wide, "passages")
    if rows <= most:
        return run(corpus, queries.toArrow(), [])
    near = [F.col("near")] if by_cell else []
    blocked, parts = _blocks(queries, rows, most, [*near, F.col("query_id")])
    path = scratch_path(spark, "found")
    for n in range(parts):
        block = blocked.filter(F.col("block") == n).drop("block").toArrow()
        if block.num_rows:
            shared: list = []
            run(corpus, block, shared).write.mode("append").parquet(path)
            for sent in shared:
                sent.destroy()
    return spark.read.schema(schema).parquet(path)


_HIT = "query_id long, id long, score double"


def _floors(passages: DataFrame, block: pa.Table, k: int, share: float, by_cell: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per query of a block, score and key of the k-th best in a share of the passages; the k-th best of all is no worse."""
    first = passages.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    shared: list = []
    last = topk_per_query(_product(first, block, partial(_Block, k=k), _HIT, by_cell, shared), k).filter(F.col("rank") == k)
    known = {r["query_id"]: (r["score"], r["id"]) for r in last.collect()}
    for sent in shared:
        sent.destroy()
    of_query = [known.get(q, (-np.inf, 0)) for q in block["query_id"].to_pylist()]
    return np.array([score for score, _ in of_query]), np.array([key for _, key in of_query], dtype=np.int64)


def _search(queries: DataFrame, corpus: DataFrame, k: int, by_cell: bool, block_bytes: int, first_share: float = 0.0) -> DataFrame:
    def run(passages: DataFrame, block: pa.Table, shared: list) -> DataFrame:
        floor = _floors(passages, block, k, first_share, by_cell) if first_share else None
        return topk_per_query(_product(passages, block, partial(_Block, k=k, floor=floor), _HIT, by_cell, shared), k)

    return _in_blocks(queries, corpus, run, f"{_HIT}, rank int", block_bytes, 2 * k, by_cell)


def _sparse(df: DataFrame, vector: str) -> bool:
    return isinstance(df.schema[vector].dataType, T.StructType)


def _held_bytes(df: DataFrame, kept: int) -> Column:
    """What a task holds of a query: its vector, with a sketch if it is sparse, and ``kept`` numbers."""
    if _sparse(df, "vector"):
        return 28 * F.size("vector.indices") + 4 * (HEAVY + GROUPS) + 8 * kept
    cells = F.octet_length("cells") if "cells" in df.columns else F.lit(0)
    return 8 * (F.size("vector") + kept) + cells


def _as_queries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows without a vector ask for nothing and are never found."""
    single = isinstance(df.schema[vector].dataType, T.ArrayType) and isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    value = F.col(vector) if single or _sparse(df, vector) else as_double(F.col(vector))  # floats travel as they are
    return df.filter(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("query_id"), value.alias("vector"))


def _as_passages(df: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    return df.filter(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), *more)


def query_corpus_product(
    queries: DataFrame,
    corpus: DataFrame,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    vector: str = "embedding",
    above: float = 0.85,
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """Every query against every passage, reduced where it is computed.

    Per query: passages met, mean and largest inner product, passages above a bound. No pair ever
    leaves the task that computed it.
    """
    partials = "query_id long, n long, total double, largest double, n_above long"

    def run(passages: DataFrame, block: pa.Table, shared: list) -> DataFrame:
        return (
            _product(passages, block, partial(_Totals, above=above), partials, False, shared)
            .groupBy("query_id")
            .agg(
                F.sum("n").alias("n"),
                (F.sum("total") / F.sum("n")).alias("mean_score"),
                F.max("largest").alias("max_score"),
                F.sum("n_above").alias("n_above"),
            )
        )

    schema = "query_id long, n long, mean_score double, max_score double, n_above long"
    return _in_blocks(
        _as_queries(queries, query_id, vector), _as_passages(corpus, corpus_id, vector), run, schema, block_bytes, 4
    )


def exact_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    vector: str = "embedding",
    block_bytes: int = QUERY_BLOCK_BYTES,
    first_share: float = 0.0,
) -> DataFrame:
    """``(query_id, id, score, rank)`` of the k passages with the largest inner product.

    Exact, so the arithmetic is queries times passages; ``ivf_topk`` prunes it. Every task finds k hits per query. With a
    ``first_share``, that part of the passages is searched first, and only hits that reach its k-th best leave a task:
    about ``k / first_share`` per query in all, however many tasks there are. For stored passages in many tasks.
    """
    return _search(
        _as_queries(queries, query_id, vector), _as_passages(corpus, corpus_id, vector), k, False, block_bytes, first_share
    )


# --- cells -----------------------------------------------------------------------------------


def train_cells(
    corpus: DataFrame, n_cells: int = 100, seed: int = 42, vector: str = "embedding", max_iter: int = 10
) -> list[list[float]]:
    """Cell centres by k-means; ``n_cells`` vectors, whatever the size of the corpus."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    points = corpus.select(array_to_vector(as_double(F.col(vector))).alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter).fit(points)
    return [centre.tolist() for centre in model.clusterCenters()]


def cells_for(rows: int, per_root: int = 4, most: int = 65_536) -> int:
    """How many cells a corpus gets: a multiple of the root of its rows, so cells and their number grow alike."""
    return max(1, min(most, rows, math.ceil(per_root * math.sqrt(rows))))


def sampled_cells(
    corpus: DataFrame, n_cells: int, id_col: str = "vec_id", vector: str = "embedding", seed: int = 42, per_cell: int = 16
) -> list[list[float]]:
    """Cell centres from a bounded sample: unit vectors, at most ``n_cells``.

    The first ``n_cells`` vectors in seeded hash order are seeds. Each of the first ``per_cell * n_cells`` goes to the seed
    with the largest inner product, the smaller one of equal seeds; a centre is the direction of the sum of a seed and what went to
    it. The sample is all that the driver holds, and the corpus is read once, where ``train_cells`` reads it many times.
    """
    usable = corpus.filter(F.col(vector).isNotNull()).select(id_col, as_double(F.col(vector)).alias("vector"))
    sample = matrix_of(sample_n(usable, per_cell * n_cells, id_col, seed).toArrow()["vector"])
    seeds = sample[:n_cells]
    sums = seeds.copy()
    for at in range(0, len(sample), _PRODUCT_ROWS):
        some = sample[at : at + _PRODUCT_ROWS]
        np.add.at(sums, np.round(some @ seeds.T, SCORE_PLACES).argmax(axis=1), some)
    lengths = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(lengths == 0, 1, lengths)).tolist()


def nprobe_for(
    queries: DataFrame,
    cells: DataFrame,
    centres: list[list[float]],
    k: int,
    recall: float = 0.92,
    sample: int = 200,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    vector: str = "embedding",
    seed: int = 43,
) -> int:
    """The fewest cells to probe that find a share ``recall`` of the exact hits of sampled queries.

    An exact hit is found as soon as its cell is probed, so the place of its cell among those of the query is all that counts. The sample
    is searched exactly, once; the places are counted, at most a number per cell.
    """
    asked = stage(sample_n(queries.filter(F.col(vector).isNotNull()).select(query_id, vector), sample, query_id, seed), "asked")
    hits = exact_topk(asked, cells, k, query_id, corpus_id, vector).select("query_id", "id")
    order = nearest_cells(asked, centres, len(centres), vector, "_order").select(F.col(query_id).cast("long").alias("query_id"), "_order")
    where = cells.select(F.col(corpus_id).cast("long").alias("id"), "cell")
    found = where.join(broadcast_bounded(hits, sample * k), "id").join(order, "query_id")
    places = dict(tuple(r) for r in found.groupBy(F.array_position("_order", F.col("cell"))).count().collect())
    wanted = math.ceil(recall * sum(places.values()) - 1e-9)
    for place in sorted(places):
        wanted -= places[place]
        if wanted <= 0:
            return int(place)
    return 1  # no hits, nothing to find


def share_read(
    queries: DataFrame, cells: DataFrame, centres: list[list[float]], nprobe: int, vector: str = "embedding"
) -> DataFrame:
    """``share_read``: the part of all query and passage pairs that a search of ``nprobe`` cells multiplies."""
    sizes = cells.filter(F.col("cell").isNotNull()).groupBy("cell").agg(F.count(F.lit(1)).alias("held"))
    probing = probed_cells(queries.filter(F.col(vector).isNotNull()), centres, min(nprobe, len(centres)), vector)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros(-(-len(centres) // 8) * 8, dtype=np.int64)
        for batch in batches:
            bits = _bits_of(batch.column("cells"))
            for at in range(0, len(bits), _rows_by(len(asked))):
                asked += np.unpackbits(bits[at : at + _rows_by(len(asked))], axis=1).sum(axis=0, dtype=np.int64)
        cells = np.flatnonzero(asked)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(asked[cells])], names=["cell", "asked"])

    probed = probing.select("cells").mapInArrow(count, "cell int, asked long").groupBy("cell").agg(F.sum("asked").alias("asked"))
    pairs = sizes.join(probed, "cell", "outer").agg(  # cells may be empty
        F.sum(F.col("held") * F.coalesce("asked", F.lit(0))).alias("met"), F.sum("held").alias("held"), F.sum("asked").alias("asked")
    )
    return pairs.select((F.col("met") / F.col("held") / (F.col("asked") / nprobe)).alias("share_read"))


def nearest_cells(df: DataFrame, centres: list[list[float]], n: int, vector: str = "embedding", out: str = "cells") -> DataFrame:
    """Add the ``n`` cells whose centres have the largest inner product with the vector; null without one."""
    table = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(vectors: pa.Array) -> pa.Array:
        missing = vectors.is_null().to_numpy(zero_copy_only=False)
        best = _nearest(vectors.drop_null(), table, n)
        lengths = np.where(missing, 0, best.shape[1])
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(best.ravel()), mask=pa.array(missing))

    return df.withColumn(out, nearest(F.col(vector)))


def _rows_by(numbers: int) -> int:
    """Rows of so many numbers that stand as a matrix at a time."""
    return max(1, _DENSE // max(1, numbers))


def _nearest(vectors: pa.Array, table: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` rows of the table nearest to each vector, best first; few vectors meet the table at a time."""
    best = np.empty((len(vectors), min(n, len(table))), dtype=np.int32)
    step = _rows_by(len(table))
    for at in range(0, len(vectors), step):
        scores = np.round(matrix_of(vectors.slice(at, step), table.shape[1]) @ table.T, SCORE_PLACES)
        best[at : at + step] = scores.argmax(axis=1)[:, None] if n == 1 else np.argsort(-scores, axis=1, kind="stable")[:, :n]
    return best


def probed_cells(df: DataFrame, centres: list[list[float]], n: int, vector: str = "embedding") -> DataFrame:
    """Add ``cells``, a bit for every cell that is set for the ``n`` nearest ones, and ``near``, the nearest; vectors are not null.

    A bit a cell is less than a number for each of the cells probed, as soon as a search probes one in 32.
    """
    table = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf("struct<near: int, cells: binary>")
    def probe(vectors: pa.Array) -> pa.Array:
        near, rows = np.empty(len(vectors), dtype=np.int32), []
        step = _rows_by(len(table))
        for at in range(0, len(vectors), step):
            best = _nearest(vectors.slice(at, step), table, n)
            near[at : at + step] = best[:, 0]
            bits = np.zeros((len(best), len(table)), dtype=bool)
            np.put_along_axis(bits, best, True, axis=1)
            rows += [row.tobytes() for row in np.packbits(bits, axis=1)]
        return pa.StructArray.from_arrays([pa.array(near), pa.array(rows, pa.binary())], names=["near", "cells"])

    return df.withColumn("_probe", probe(F.col(vector))).withColumns({"cells": F.col("_probe.cells"), "near": F.col("_probe.near")}).drop("_probe")


def _bits_of(cells: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """``cells`` of ``probed_cells``, a row of bytes each."""
    rows = cells.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -1) if rows else np.zeros((0, 0), dtype=np.uint8)


def assign_cells(corpus: DataFrame, centres: list[list[float]], vector: str = "embedding") -> DataFrame:
    """Add the ``cell`` of every passage."""
    return nearest_cells(corpus, centres, 1, vector, "_cells").withColumn("cell", F.get("_cells", 0)).drop("_cells")


def ivf_topk(
    queries: DataFrame,
    cells: DataFrame,
    centres: list[list[float]],
    k: int = 5,
    nprobe: int = 10,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    vector: str = "embedding",
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """Like ``exact_topk`` over the ``nprobe`` nearest cells of every query.

    ``cells`` is the corpus with its ``cell`` column. Passages stay where they are, so a cell that
    holds a third of them is searched by as many tasks as its rows fill. Cells that no query
    probes are filtered out before anything is read from them if the table is stored by cell.
    """
    probing = probed_cells(_as_queries(queries, query_id, vector), centres, min(nprobe, len(centres)), "vector")
    return _search(probing, _as_passages(cells, corpus_id, vector, "cell"), k, True, block_bytes)


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found."""
    found = approximate.select("query_id", "id").withColumn("_found", F.lit(1))
    return exact.select("query_id", "id").join(found, ["query_id", "id"], "left").agg(
        (F.count("_found") / F.count(F.lit(1))).alias("recall")
    )
