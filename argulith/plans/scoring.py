"""Texts to labels, similar passages and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argulith.functions.explain import template_explanation
from argulith.functions.text import truncate_text
from argulith.operators.classify import LinearScorer, TextClassifier, score
from argulith.operators.hits import hits_to_passages, top_hits_array
from argulith.operators.metrics import confusion_matrix, metrics_record
from argulith.operators.search import exact_topk
from argulith.plans.corpus import PassageIndex, search_index
from argulith.session import stage


def predict(df: DataFrame, scorer: LinearScorer | TextClassifier, vector_col: str = "embedding") -> DataFrame:
    """Add ``pred`` and ``confidence`` with a vector scorer or a fitted text classifier."""
    if isinstance(scorer, LinearScorer):
        return score(df, scorer, vector_col)
    return scorer.transform(df)


def predict_batch(
    df: DataFrame, scorer: LinearScorer | TextClassifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, text[:100], fallacy, confidence)`` for every row; one text is a one-row frame."""
    return predict(df, scorer).select(
        id_col, truncate_text(F.col(text_col), 100).alias("text"), F.col("pred").alias("fallacy"), "confidence"
    )


def similar_examples(
    df: DataFrame, corpus: DataFrame, k: int = 3, id_col: str = "doc_id", corpus_id: str = "id", vector: str = "embedding"
) -> DataFrame:
    """``(id, similar_examples)``: the k most similar passages of every row that has any, best first.

    The hits are staged: they are few, and looking for hot passages must not search twice.
    """
    hits = stage(exact_topk(df, corpus, k, id_col, corpus_id, vector), "hits")
    return top_hits_array(hits_to_passages(hits, corpus, corpus_id)).withColumnRenamed("query_id", id_col)


def predict_with_retrieval(
    df: DataFrame, scorer: LinearScorer | TextClassifier, corpus: DataFrame, k: int = 3,
    id_col: str = "doc_id", corpus_id: str = "id", vector: str = "embedding",
) -> DataFrame:
    """Predictions with the k most similar passages as ``(text, score)`` lists."""
    examples = similar_examples(df, corpus, k, id_col, corpus_id, vector)
    none = F.array().cast("array<struct<text: string, score: double>>")
    return (
        predict_batch(df, scorer, id_col)
        .join(examples, id_col, "left")
        .withColumn("similar_examples", F.coalesce("similar_examples", none))
    )


def predict_with_index(
    df: DataFrame, classifier: TextClassifier, index: PassageIndex, k: int = 3, nprobe: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Predictions of a text classifier with the k passages of a stored index that resemble the text.

    Texts go through the index's own encoder; only ``nprobe`` cells are read per text, all without it.
    """
    hits = search_index(index, df, k, nprobe, id_col, text_col)
    examples = top_hits_array(hits).withColumnRenamed("query_id", id_col)
    none = F.array().cast("array<struct<text: string, score: double>>")
    return (
        predict_batch(df, classifier, id_col, text_col)
        .join(examples, id_col, "left")
        .withColumn("similar_examples", F.coalesce("similar_examples", none))
    )


def predict_and_explain(
    df: DataFrame, scorer: LinearScorer | TextClassifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, text, predicted_fallacy, confidence, explanation)``."""
    scored = predict(df, scorer)
    return scored.select(
        id_col,
        text_col,
        F.col("pred").alias("predicted_fallacy"),
        "confidence",
        template_explanation(F.col(text_col), F.col("pred"), F.col("confidence")).alias("explanation"),
    )


def evaluate_model(test: DataFrame, scorer: LinearScorer | TextClassifier, label_col: str = "label") -> DataFrame:
    """One row: accuracy, macro F1, weighted F1."""
    return metrics_record(confusion_matrix(predict(test, scorer), label_col, "pred"))
