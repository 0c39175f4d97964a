"""Classification metrics, all from one count of (label, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.session import stage


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Rows per (label, prediction): the only step that reads the predictions."""
    return df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_scores(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support for every class seen in labels or predictions."""
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    sides = F.explode(
        F.array(
            F.struct(F.col("label").alias("label"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
            F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
        )
    )
    per_class = confusion.select(sides.alias("s")).groupBy(F.col("s.label").alias("label")).agg(
        F.sum("s.tp").alias("tp"), F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted")
    )
    return per_class.select(
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "tp",
    )


def accuracy(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(label_col) == F.col(pred_col)).cast("int")).alias("accuracy"))


def metrics_record(confusion: DataFrame) -> DataFrame:
    """One row: accuracy, macro F1 and weighted F1."""
    return class_scores(confusion).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def macro_f1(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    return metrics_record(confusion_matrix(df, label_col, pred_col)).select("macro_f1")


def weighted_f1(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    return metrics_record(confusion_matrix(df, label_col, pred_col)).select("weighted_f1")


def classification_report(confusion: DataFrame) -> DataFrame:
    """Rows per class, then accuracy, macro average and weighted average.

    The class scores are staged, a row per class, so the predictions are counted once.
    """
    scores = stage(class_scores(confusion), "class_scores")
    kinds = ("precision", "recall", "f1")
    support = F.sum("support").alias("support")
    share = (F.sum("tp") / F.sum("support")).cast("double")
    summaries = {
        "accuracy": [share.alias(m) for m in kinds],
        "macro avg": [F.avg(m).alias(m) for m in kinds],
        "weighted avg": [(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in kinds],
    }
    report = scores.select(F.col("label").cast("string").alias("label"), *kinds, "support")
    for name, columns in summaries.items():
        summary = scores.agg(*columns, support).filter(F.col("support").isNotNull())
        report = report.unionByName(summary.withColumn("label", F.lit(name)))
    return report


def best_model(scores: DataFrame, name_col: str = "model", order_col: str = "position", score_col: str = "macro_f1") -> DataFrame:
    """The candidate with the highest score; the earlier one on ties."""
    best = F.max_by(F.struct(name_col, order_col, score_col), F.struct(F.col(score_col), -F.col(order_col)))
    return scores.agg(best.alias("b")).select("b.*")
