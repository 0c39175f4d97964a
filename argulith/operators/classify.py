"""Text and vector classifiers: class-weighted training, linear scoring, decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argulith.functions.text import word_tokens
from argulith.functions.vectors import as_double, matrix_of
from argulith.operators.bounded import broadcast_bounded, fetch_bounded
from argulith.operators.labels import class_weights, encode_label, label_index
from argulith.operators.metrics import confusion_matrix, metrics_record
from argulith.session import stage

MAX_CLASSES = 10_000
_PRODUCT_ROWS = 2_048  # vectors that stand as a dense matrix at a time


OUTCOME = T.StructType(
    [
        T.StructField("probabilities", T.ArrayType(T.DoubleType())),
        T.StructField("position", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)


def _products(vectors: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the vectors that are there, and which rows have none."""
    missing = vectors.is_null().to_numpy(zero_copy_only=False)
    held, parts = vectors.drop_null(), [np.empty((0, len(weights)))]
    for at in range(0, len(held), _PRODUCT_ROWS):
        parts.append(matrix_of(held.slice(at, _PRODUCT_ROWS), weights.shape[1]) @ weights.T)
    return np.concatenate(parts), missing


def _as_lists(rows: np.ndarray, missing: np.ndarray) -> pa.ListArray:
    lengths = np.where(missing, 0, rows.shape[1])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()), mask=pa.array(missing))


def _as_column(values: np.ndarray, missing: np.ndarray) -> pa.Array:
    whole = np.zeros(len(missing), dtype=values.dtype)
    whole[~missing] = values
    return pa.array(whole, mask=missing)


@dataclass
class LinearScorer:
    """One weight vector per class; ids are positions in ``labels``."""

    labels: list
    weights: np.ndarray

    def logits(self, vector: Column) -> Column:
        """Inner products with all classes, as one matrix product per Arrow batch."""
        weights = self.weights

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def product(vectors: pa.Array) -> pa.Array:
            return _as_lists(*_products(vectors, weights))

        return product(vector)

    def outcome(self, vector: Column) -> Column:
        """Struct of the softmax of the logits, the position of the first largest and its probability."""
        weights = self.weights

        @F.arrow_udf(OUTCOME)
        def outcomes(vectors: pa.Array) -> pa.Array:
            scores, missing = _products(vectors, weights)
            position = scores.argmax(axis=1)
            powers = np.exp(scores - scores.max(axis=1, keepdims=True))
            probabilities = powers / powers.sum(axis=1, keepdims=True)
            confidence = probabilities[np.arange(len(position)), position]
            return pa.StructArray.from_arrays(
                [
                    _as_lists(probabilities, missing),
                    _as_column(position.astype(np.int32), missing),
                    _as_column(confidence, missing),
                ],
                names=["probabilities", "position", "confidence"],
            )

        return outcomes(vector)

    def label_of(self, position: Column) -> Column:
        return F.get(F.array(*[F.lit(label) for label in self.labels]), position)


def class_centroids(df: DataFrame, label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Mean vector per class; partial sums are combined in every task, so a large class is no hot key."""
    vectors = df.select(label_col, array_to_vector(as_double(F.col(vector_col))).alias("_v"))
    return vectors.groupBy(label_col).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("centroid"))


def centroid_scorer(
    df: DataFrame, label_col: str = "label", vector_col: str = "embedding", unit: bool = False
) -> LinearScorer:
    """Class centroids as weights, optionally scaled to unit length; one row per class is fetched."""
    rows = fetch_bounded(class_centroids(df, label_col, vector_col), MAX_CLASSES, "classes")
    rows.sort(key=lambda r: r[label_col])
    weights = np.array([r["centroid"] for r in rows])
    if unit:
        weights = weights / np.linalg.norm(weights, axis=1, keepdims=True)
    return LinearScorer([r[label_col] for r in rows], weights)


def score(df: DataFrame, scorer: LinearScorer, vector_col: str = "embedding") -> DataFrame:
    """Add ``probabilities``, ``pred`` and ``confidence``, null for rows without a vector."""
    return (
        df.withColumn("_outcome", scorer.outcome(F.col(vector_col)))
        .withColumn("probabilities", F.col("_outcome.probabilities"))
        .withColumn("pred", scorer.label_of(F.col("_outcome.position")))
        .withColumn("confidence", F.col("_outcome.confidence"))
        .drop("_outcome")
    )


def topn_labels(probabilities: Column, labels: list, n: int) -> Column:
    """The ``n`` most likely labels of a row as ``(label, probability)``, ties by label; no shuffle."""
    names = F.array(*[F.lit(label) for label in labels])
    pairs = F.zip_with(names, probabilities, lambda l, p: F.struct((-p).alias("low"), l.alias("label")))
    best = F.slice(F.array_sort(pairs), 1, n)
    return F.transform(best, lambda b: F.struct(b["label"].alias("label"), (-b["low"]).alias("probability")))


def confidence_filter(df: DataFrame, threshold: float = 0.6, confidence_col: str = "confidence") -> DataFrame:
    return df.filter(F.col(confidence_col) >= threshold)


# --- text encoder and text classifier --------------------------------------------------------


def text_encoder(dimensions: int = 256) -> Pipeline:
    """Hashed terms, weighted by rarity, as unit vectors; expects a ``tokens`` column."""
    return Pipeline(
        stages=[
            HashingTF(numFeatures=dimensions, inputCol="tokens", outputCol="_tf"),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(p=2.0, inputCol="_tfidf", outputCol="vector"),
        ]
    )


def with_tokens(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    text = F.concat(F.lit(prefix), F.col(text_col)) if prefix else F.col(text_col)
    return df.withColumn("tokens", word_tokens(text))


def fit_encoder(df: DataFrame, text_col: str = "text", dimensions: int = 256, prefix: str = "") -> PipelineModel:
    return text_encoder(dimensions).fit(with_tokens(df, text_col, prefix))


def encode_texts(df: DataFrame, encoder: PipelineModel, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the unit vector of every text as ``embedding``."""
    encoded = encoder.transform(with_tokens(df, text_col, prefix))
    return encoded.withColumn("embedding", vector_to_array("vector")).drop("tokens", "_tf", "_tfidf", "vector")


def encode_texts_with(load_model, dimensions: int, batch_size: int = 64):
    """An encoding column function around a model loaded once per task; vectors are scaled to unit length."""

    @F.pandas_udf("array<double>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_model()
        for texts in batches:
            parts = []
            for start in range(0, len(texts), batch_size):
                part = np.asarray(encode(texts.iloc[start : start + batch_size].tolist()), dtype=np.float64)
                if part.shape[1] != dimensions:
                    raise ValueError(f"the model returns {part.shape[1]} dimensions, not {dimensions}")
                lengths = np.linalg.norm(part, axis=1, keepdims=True)
                parts.extend((part / np.where(lengths > 0, lengths, 1.0)).tolist())
            yield pd.Series(parts, dtype=object)

    return encoded


@dataclass
class TextClassifier:
    """A fitted pipeline with its label table."""

    model: PipelineModel
    labels: list

    def transform(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add ``probabilities``, ``pred`` and ``confidence``, null for rows without a vector."""
        names = F.array(*[F.lit(label) for label in self.labels])
        scored = self.model.transform(with_tokens(df, text_col))
        return (
            scored.withColumn("probabilities", vector_to_array("probability"))
            .withColumn("pred", F.get(names, F.col("prediction").cast("int")))
            .withColumn("confidence", F.array_max("probabilities"))
            .drop("tokens", "_tf", "_tfidf", "vector", "rawPrediction", "probability", "prediction")
        )


def train_classifier(
    train: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    dimensions: int = 1024,
    reg: float = 0.01,
    max_iter: int = 20,
) -> TextClassifier:
    """Multinomial logistic regression on hashed terms, classes weighted by their inverse size.

    Texts are read and hashed once: the term counts are staged, and all passes go over them.
    """
    index = label_index(train, label_col)
    weighted = encode_label(train, index, label_col).join(
        broadcast_bounded(class_weights(train, label_col).select(label_col, "weight")), label_col
    )
    hashing, *weighing = text_encoder(dimensions).getStages()
    counted = stage(hashing.transform(with_tokens(weighted, text_col)).select("_tf", "label_id", "weight"), "counts")
    fitted = Pipeline(stages=[*weighing, _regression(reg, max_iter)]).fit(counted)
    return TextClassifier(PipelineModel([hashing, *fitted.stages]), labels_in_order(index, label_col))


def _regression(reg: float, max_iter: int) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="vector",
        labelCol="label_id",
        weightCol="weight",
        family="multinomial",
        regParam=reg,
        maxIter=max_iter,
    )


def choose_classifier(
    dataset: DataFrame,
    regs: tuple[float, ...] = (0.001, 0.01, 0.1),
    text_col: str = "text",
    label_col: str = "label",
    dimensions: int = 512,
    max_iter: int = 20,
) -> tuple[TextClassifier, DataFrame, DataFrame]:
    """Fit on ``split`` train, choose by macro F1 on val, measure on test.

    Returns the chosen classifier, a row per candidate (``position``, ``reg``, ``macro_f1`` on val)
    and one row of its metrics on test. The vectors of all splits are staged once; candidates and
    measurements read them and never the texts.
    """
    train = dataset.filter(F.col("split") == "train")
    index, weights = label_index(train, label_col), class_weights(train, label_col).select(label_col, "weight")
    hashing, *weighing = text_encoder(dimensions).getStages()
    known = encode_label(dataset, index, label_col).join(broadcast_bounded(weights), label_col)
    counted = stage(hashing.transform(with_tokens(known, text_col)).select("_tf", label_col, "label_id", "weight", "split"), "counts")
    encoder = Pipeline(stages=weighing).fit(counted.filter(F.col("split") == "train"))
    encoded = stage(encoder.transform(counted).select("vector", label_col, "label_id", "weight", "split"), "vectors")
    labels = labels_in_order(index, label_col)
    names = F.array(*[F.lit(label) for label in labels])

    def measured(model, part: str) -> DataFrame:
        scored = model.transform(encoded.filter(F.col("split") == part))
        scored = scored.withColumn("pred", F.get(names, F.col("prediction").cast("int")))
        return metrics_record(confusion_matrix(scored, label_col, "pred"))

    models = [_regression(reg, max_iter).fit(encoded.filter(F.col("split") == "train")) for reg in regs]
    scores = [measured(model, "val").first()["macro_f1"] for model in models]
    rows = [(n, reg, score) for n, (reg, score) in enumerate(zip(regs, scores))]
    candidates = dataset.sparkSession.createDataFrame(rows, "position int, reg double, macro_f1 double")
    best = max(range(len(regs)), key=lambda n: (scores[n] or 0.0, -n))
    chosen = TextClassifier(PipelineModel([hashing, *encoder.stages, models[best]]), labels)
    return chosen, candidates, measured(models[best], "test")


def labels_in_order(index: DataFrame, label_col: str = "label") -> list:
    """The labels of a label table by id."""
    rows = fetch_bounded(index.select("label_id", label_col), MAX_CLASSES, "classes")
    return [label for _, label in sorted(tuple(r) for r in rows)]
