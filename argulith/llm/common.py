"""Helpers that several operators share: registry, words, held-out rows, copies of a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BLANKS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of runs of anything but the six ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def spare(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it (case ignored)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, text: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch whose texts hold ``limit`` bytes or are one row."""
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    ends = pc.cumulative_sum(pc.fill_null(pc.cast(pc.binary_length(batch.column(text)), pa.int64()), 0)).to_pylist()
    first, base = 0, 0
    for row, end in enumerate(ends):
        if end - base > limit and row > first:
            yield batch.slice(first, row - first)
            first, base = row, ends[row - 1]
    yield batch.slice(first)


def with_text_columns(
    df: DataFrame, text: str, out: StructType, fn: Callable[[list], list[pa.Array]], limit: int = 8 << 20
) -> DataFrame:
    """``df`` with columns computed from whole texts, slice by slice of bounded bytes.

    ``fn`` gets the texts of a slice and returns one Arrow array per field of ``out``.
    """
    at = df.columns.index(text)
    schema = StructType([*df.schema.fields, *out.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, limit):
                made = fn(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)

    return df.mapInArrow(run, schema)
