"""Sources. Schemas are explicit: CSV cells are strings by header name, JSON has a given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith.operators.labels import project_text_label
from argulith.operators.ranking import number_rows
from argulith.sources.split_csv import read_split_csv

PASSAGE_SCHEMA = "id long, text string, text_normalized string, question string, type string"

# Header of the taxonomy file (one name ends in a blank) -> column name.
TAXONOMY_COLUMNS = {
    "Original Name": "original_name",
    "Understandable Name": "understandable_name",
    "Description": "description",
    "Logical Form": "logical_form",
    "Source for Logical Form ": "logical_form_source",
    "Masked Logical Form": "masked_logical_form",
}


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, in_order: bool = False) -> DataFrame:
    """CSV with a header and doubled quotes; cells may span lines.

    Large files are split either way; ``multi_line=False`` saves one of two passes where no cell has a line break.
    ``in_order`` sorts rows by file and place, for sources whose rows are to be numbered; without ``multi_line`` they come so.
    """
    if multi_line:
        return read_split_csv(spark, path, in_order)
    return spark.read.csv(path, header=True, escape='"', inferSchema=False)


def scan_csv(spark: SparkSession, path: str, text_col: str, label_col: str, multi_line: bool = True, in_order: bool = False) -> DataFrame:
    """A labelled source as ``(text, raw_label)``; null texts become empty."""
    cells = read_csv(spark, path, multi_line, in_order)
    return project_text_label(cells.withColumn("_id", F.lit(None)), text_col, label_col, "_id").drop("_id")


def scan_keyed_csv(spark: SparkSession, path: str, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Like ``scan_csv`` with the key column of the file, as ``(doc_id, text, raw_label)``."""
    keyed = read_csv(spark, path).withColumn("doc_id", F.col(id_col).cast("long"))
    return project_text_label(keyed, text_col, label_col)


def scan_arguments(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Arguments for ``build_corpus``: ``(id, argument, question, type)`` from a CSV file with the last three.

    The file has no keys, so rows are numbered; the numbers are staged and have gaps.
    """
    cells = read_csv(spark, path, multi_line, in_order=True).select("argument", "question", "type")
    return number_rows(cells, "id").select("id", "argument", "question", "type")


def scan_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    cells = read_csv(spark, path, in_order=True)
    return cells.select(
        *[F.trim(F.regexp_replace(F.col(f"`{old}`"), r"^\s+|\s+$", "")).alias(new) for old, new in TAXONOMY_COLUMNS.items()]
    )


def scan_jsonl(spark: SparkSession, path: str, schema: str = PASSAGE_SCHEMA) -> DataFrame:
    """JSON lines; blank lines are skipped by the reader."""
    return spark.read.schema(schema).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def resolve_source(spark: SparkSession, candidates: list[str]) -> str:
    """The first path that exists; an error if none does."""
    for path in candidates:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {candidates}")


def resolve_sources(spark: SparkSession, optional: dict[str, str]) -> dict[str, str]:
    """The optional sources that exist; an error if there is none at all."""
    found = {name: path for name, path in optional.items() if exists(spark, path)}
    if not found:
        raise FileNotFoundError(f"none of {list(optional.values())}")
    return found
