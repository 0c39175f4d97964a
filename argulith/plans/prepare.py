"""Raw labelled sources to a cleaned, masked, deduplicated, split table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith.functions.text import clean_text, longer_than, null_text_to_empty
from argulith.operators.dedup import dedup_exact, union_sources
from argulith.operators.labels import canonical_label, encode_label, label_index
from argulith.operators.names import masked
from argulith.operators.ranking import number_rows, stratified_split
from argulith.session import stage
from argulith.sources.readers import read_csv, resolve_sources, scan_csv
from argulith.sources.stores import save_label_map
from argulith.sources.writers import sink_csv


def load_sources(spark: SparkSession, sources: list[tuple[str, str, str]], multi_line: bool = True) -> DataFrame:
    """CSV sources ``(path, text column, label column)`` as one table ``(doc_id, text, raw_label)``.

    Paths that do not exist are skipped; it is an error if none does. Rows are numbered in the
    order of the sources, so of copies the one of the first source is kept later on. With
    ``multi_line=False`` (no cell has a line break) large files are read by many tasks.
    """
    found = resolve_sources(spark, {path: path for path, _, _ in sources})
    scans = [scan_csv(spark, path, text, label, multi_line, in_order=True) for path, text, label in sources if path in found]
    return number_rows(union_sources(*scans))


def clean_labelled(
    sources: list[DataFrame], names: DataFrame | dict[str, list[str]] | None = None, min_chars: int = 50, normalise: bool = True
) -> DataFrame:
    """Sources ``(doc_id, text, raw_label)`` with keys unique over all of them, as ``(doc_id, text, label)``.

    Known labels only; duplicates and short texts are judged on the raw text.
    """
    mapped = [
        canonical_label(s.withColumn("text", null_text_to_empty(F.col("text"))), "raw_label", "inner").select(
            "doc_id", "text", "label"
        )
        for s in sources
    ]
    # A copy is as long as its original, so dropping short texts first saves their shuffle.
    kept = dedup_exact(union_sources(*mapped).filter(longer_than(F.col("text"), min_chars)))
    return masked(kept.withColumn("text", clean_text(F.col("text"), normalise)), names, "doc_id", "text")


def prepare_dataset(
    sources: list[DataFrame],
    names: DataFrame | dict[str, list[str]] | None = None,
    seed: int = 42,
    min_chars: int = 50,
    normalise: bool = True,
) -> DataFrame:
    """``(doc_id, text, label, label_id, split)``.

    The cleaned texts are staged once: numbering the labels and finding the split points read only
    two columns of them, and labelling the rows is a map over the staged table.
    """
    cleaned = stage(clean_labelled(sources, names, min_chars, normalise), "cleaned")
    numbered = encode_label(cleaned, label_index(cleaned))
    return stratified_split(numbered, "label", "doc_id", seed).select(
        "doc_id", "text", "label", "label_id", "split"
    )


def split_summary(dataset: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per split and label."""
    return dataset.groupBy("split", label_col).agg(F.count(F.lit(1)).alias("n"))


def save_dataset(dataset: DataFrame, path: str) -> None:
    """The splits as CSV, one folder per split, written in one pass, and the label table."""
    columns = ["doc_id", "text", "label", "label_id", "split"]
    sink_csv(dataset.select(*columns), f"{path}/splits", partition_by="split")
    index = dataset.select("label", "label_id").distinct()
    save_label_map(index, f"{path}/label_map")


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One saved split as ``(doc_id, text, label, label_id)``; the other folders are not read."""
    cells = read_csv(spark, f"{path}/splits/split={split}")
    return cells.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        null_text_to_empty(F.col("text")).alias("text"),
        "label",
        F.col("label_id").cast("int").alias("label_id"),
    )
