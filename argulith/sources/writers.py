"""Sinks: every task writes its own part files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sink_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, UTF-8 as it is; nulls are kept as fields."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def sink_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: str | None = None) -> None:
    """CSV with a header and doubled quotes; blanks at the ends of cells are kept."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def sink_explanations(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line: text, predicted label, confidence, explanation."""
    sink_jsonl(df.select("text", "predicted_fallacy", "confidence", "explanation"), path, mode)
