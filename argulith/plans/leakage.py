"""Audit of a split table: sizes, overlaps, lengths, masks and near-duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.functions.text import has_mask
from argulith.operators.dedup import split_overlap
from argulith.operators.ranking import head_n, sample_n
from argulith.operators.tfidf import fit_tfidf, near_copies, near_duplicate_count

SPLITS = ("train", "val", "test")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def text_length_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    length = F.length(text_col)
    return df.groupBy("split").agg(
        F.avg(length).alias("mean_length"), F.min(length).alias("min_length"), F.max(length).alias("max_length")
    )


def mask_rate(df: DataFrame, text_col: str = "text", **options: bool) -> DataFrame:
    """Rows with a mask token and their share, per split."""
    masked = F.count_if(has_mask(F.col(text_col), **options))
    return df.groupBy("split").agg(
        masked.alias("masked"), F.count(F.lit(1)).alias("n"), (masked / F.count(F.lit(1))).alias("mask_rate")
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    above: float = 0.85,
    max_features: int = 1000,
    sample_train: int | None = None,
    sample_test: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Test rows that resemble a train row, of how many; over the whole splits unless sampled."""
    train = df.filter(F.col("split") == "train")
    test = df.filter(F.col("split") == "test")
    train = train if sample_train is None else sample_n(train, sample_train, id_col, seed)
    test = test if sample_test is None else head_n(test, sample_test, id_col)
    both = train.select(id_col, text_col).unionByName(test.select(id_col, text_col))
    model = fit_tfidf(both, text_col, max_features)
    return near_duplicate_count(near_copies(test, train, model, above, id_col, text_col))


def leakage_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
    above: float = 0.85, near_duplicate_limit: int = 20, **sampling: int,
) -> DataFrame:
    """One row with all audit figures and the two warning flags."""

    def inside(part: str) -> Column:
        return F.col("split") == part

    length = F.length(text_col)
    figures = [F.count_if(inside(part)).alias(f"{part}_rows") for part in SPLITS]
    for part in SPLITS:
        of_part = F.when(inside(part), length)
        figures += [
            F.avg(of_part).alias(f"{part}_mean_length"),
            F.min(of_part).alias(f"{part}_min_length"),
            F.max(of_part).alias(f"{part}_max_length"),
        ]
    figures += [
        F.count_if(inside(part) & has_mask(F.col(text_col))).alias(f"{part}_masked") for part in ("train", "test")
    ]
    # Classes of test are few; a set of them is smaller than one text.
    figures.append(F.size(F.collect_set(F.when(inside("test"), F.col(label_col)))).alias("test_labels"))

    parts = [df.agg(*figures), split_overlap(df, text_col), near_duplicates(df, id_col, text_col, above, **sampling)]
    # Three one-row tables side by side: stacked with nulls, then folded.
    names = [c for part in parts for c in part.columns]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    for part in ("train", "test"):
        names.append(f"{part}_masked_share")
        share = F.col(f"{part}_masked") / F.greatest(F.col(f"{part}_rows"), F.lit(1))
        stacked = stacked.withColumn(names[-1], F.when(F.col(f"{part}_rows").isNotNull(), share))
    overlap = (F.col("train_val_overlap") > 0) | (F.col("train_test_overlap") > 0)
    return (
        stacked.agg(*[F.max(c).alias(c) for c in names])
        .withColumn("exact_leak", overlap)
        .withColumn("near_leak", F.col("near_duplicates") > near_duplicate_limit)
    )
