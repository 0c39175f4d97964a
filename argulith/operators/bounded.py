"""Joins that stay balanced: checked broadcasts and hot keys joined apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 20_000
MAX_HOT_KEYS = 1_000


def broadcast_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else ``df`` as it is.

    The rows are fetched once (never more than ``max_rows + 1``), so the plan behind a small
    dimension is not run again by the join. A larger one is left to a shuffle join, where
    adaptive execution splits skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def fetch_bounded(df: DataFrame, max_rows: int, what: str) -> list[Row]:
    """All rows of a table that must be small; an error, never a cut, if it is not."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}")
    return rows


def hot_keys(df: DataFrame, key: str, min_rows: int) -> list:
    """Keys with ``min_rows`` rows or more, the ``MAX_HOT_KEYS`` most frequent at most.

    A key outside the list holds fewer than ``min_rows`` rows or less than a thousandth of the
    table, so one task can take it.
    """
    top = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .orderBy(F.desc("_rows"), key)
        .limit(MAX_HOT_KEYS)
        .filter(F.col("_rows") >= min_rows)
    )
    return [row[0] for row in top.select(key).collect()]


def join_to_unique(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot_rows: int = 1_000_000
) -> DataFrame:
    """Join a possibly skewed ``left`` to a ``right`` that has at most one row per ``key``.

    The rows of hot keys never meet in one task: they are joined by broadcasting the few matching
    right rows, the rest goes through an ordinary shuffle join. Supports the join types that keep
    or drop left rows: inner, left, left_semi, left_anti.
    """
    hot = hot_keys(left, key, hot_rows)
    if not hot:
        return left.join(right, key, how)
    field = left.select(key).schema
    keys = F.broadcast(left.sparkSession.createDataFrame([(k,) for k in hot], field))
    cold = left.join(keys, key, "left_anti").join(right, key, how)
    few = F.broadcast(right.join(keys, key, "left_semi"))
    return cold.unionByName(left.join(keys, key, "left_semi").join(few, key, how))
