"""Label names, ids and their lookups. Label tables are small by nature and broadcast after a check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.functions.text import null_text_to_empty
from argulith.operators.bounded import broadcast_bounded


def alias_table(spark: SparkSession) -> DataFrame:
    """Raw name -> canonical label, one row per alias."""
    return spark.createDataFrame(list(fixed.LABEL_ALIASES.items()), "raw_label string, label string")


def canonical_label(df: DataFrame, raw_col: str, how: str = "left") -> DataFrame:
    """Add ``label``; unknown names get null, or are dropped with ``how='inner'``."""
    aliases = alias_table(df.sparkSession).withColumnRenamed("raw_label", raw_col)
    return df.join(F.broadcast(aliases), raw_col, how)  # 19 rows, a fixed list


def drop_unmapped(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.filter(F.col(label_col).isNotNull())


def project_text_label(df: DataFrame, text_col: str, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """A source with its own column names, as ``(id, text, raw_label)``."""
    return df.select(
        id_col, null_text_to_empty(F.col(text_col)).alias("text"), F.col(label_col).alias("raw_label")
    )


def label_index(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Sorted distinct labels, numbered from 0. One row per class."""
    distinct = df.filter(F.col(label_col).isNotNull()).select(label_col).distinct()
    position = F.row_number().over(Window.orderBy(label_col)) - 1
    return distinct.select(label_col, position.cast("int").alias("label_id"))


def encode_label(
    df: DataFrame, index: DataFrame, label_col: str = "label", unmapped: str = "drop"
) -> DataFrame:
    """Add ``label_id``; unknown labels are dropped or, with ``unmapped='zero'``, get class 0."""
    if unmapped not in ("drop", "zero"):
        raise ValueError(unmapped)
    known = broadcast_bounded(index)
    if unmapped == "drop":
        return df.join(known, label_col)
    joined = df.join(known, label_col, "left")
    return joined.withColumn("label_id", F.coalesce("label_id", F.lit(0)))


def decode_label(df: DataFrame, index: DataFrame, id_col: str = "label_id") -> DataFrame:
    """Add the label of an id."""
    return df.join(broadcast_bounded(index.withColumnRenamed("label_id", id_col)), id_col)


def lookup_with_default(
    df: DataFrame, table: DataFrame, key: str, value: str, default: str, out: str
) -> DataFrame:
    """Look ``key`` up in a small table; rows without an entry get ``default``."""
    found = table.select(key, F.col(value).alias(out))
    return df.join(broadcast_bounded(found), key, "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(default))
    )


def top_labels(df: DataFrame, n: int = 15, label_col: str = "label") -> DataFrame:
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label_col).limit(n)


def label_distribution(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def distinct_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Counted over the classes, after a partial distinct in every task."""
    return df.select(label_col).distinct().agg(F.count(label_col).alias("n_labels"))


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class). Windows run over one row per class.

    Rows without a class are no class of their own: they count nowhere.
    """
    everything = Window.partitionBy()
    counts = df.filter(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    weight: Column = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.select(label_col, "n", weight.alias("weight"))
