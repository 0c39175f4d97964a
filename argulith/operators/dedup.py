"""Unions, exact duplicates and overlaps, all on a digest of the text instead of the text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argulith.operators.bounded import join_to_unique


def text_digest(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def union_sources(*sources: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def dedup_exact(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Of rows with the same text, keep the one with the lowest key.

    The keepers are found on (digest, key) alone: a hash aggregate combines copies inside every
    task, however many there are, and only then shuffles. The texts move once, in a semi join on
    the unique key, which cannot be skewed.
    """
    keepers = df.groupBy(text_digest(text_col).alias("_digest")).agg(F.min(id_col).alias(id_col))
    return df.join(keepers.select(id_col), id_col, "left_semi")


def keep_first(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The same rows by a window; every task drops all but its first copy before the shuffle."""
    first = Window.partitionBy("_digest").orderBy(id_col)
    return (
        df.withColumn("_digest", text_digest(text_col))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_digest", "_rank")
    )


def split_overlap(df: DataFrame, text_col: str = "text", split_col: str = "split") -> DataFrame:
    """Distinct texts that train shares with val and with test, in one pass."""

    def present(part: str) -> Column:
        return F.max((F.col(split_col) == part).cast("int"))

    texts = df.groupBy(text_digest(text_col).alias("_digest")).agg(
        present("train").alias("train"), present("val").alias("val"), present("test").alias("test")
    )
    return texts.agg(
        F.coalesce(F.sum(F.col("train") * F.col("val")), F.lit(0)).alias("train_val_overlap"),
        F.coalesce(F.sum(F.col("train") * F.col("test")), F.lit(0)).alias("train_test_overlap"),
    )


def _train_digests(train: DataFrame, text_col: str) -> DataFrame:
    return train.select(text_digest(text_col).alias("_digest")).distinct()


def mark_contaminated(
    held_out: DataFrame, train: DataFrame, text_col: str = "text", out: str = "contaminated"
) -> DataFrame:
    """Add whether the text of a held-out row also occurs in train."""
    known = _train_digests(train, text_col).withColumn("_known", F.lit(True))
    marked = held_out.withColumn("_digest", text_digest(text_col))
    joined = join_to_unique(marked, known, "_digest", "left")
    return joined.withColumn(out, F.coalesce("_known", F.lit(False))).drop("_digest", "_known")


def contaminated_rows(
    held_out: DataFrame, train: DataFrame, text_col: str = "text", clean: bool = False
) -> DataFrame:
    """Held-out rows whose text also occurs in train; with ``clean=True`` the other rows."""
    marked = held_out.withColumn("_digest", text_digest(text_col))
    how = "left_anti" if clean else "left_semi"
    return join_to_unique(marked, _train_digests(train, text_col), "_digest", how).drop("_digest")


def corpus_union(sources: dict[str, DataFrame], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Several corpora in one, with a ``corpus`` tag and without repeated texts.

    Keys of different corpora may coincide, so the first copy is the one of the first corpus
    name, then of the lowest key.
    """
    tagged = union_sources(*[df.withColumn("corpus", F.lit(name)) for name, df in sources.items()])
    first = Window.partitionBy("_digest").orderBy("corpus", id_col)
    return (
        tagged.withColumn("_digest", text_digest(text_col))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_digest", "_rank")
    )
