"""Saved label tables, vector indexes and fitted classifiers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from argulith.operators.classify import TextClassifier, labels_in_order
from argulith.operators.labels import label_index
from argulith.sources.readers import exists

LABEL_MAP_SCHEMA = "label string, label_id int"


def save_label_map(index: DataFrame, path: str) -> None:
    index.coalesce(1).write.mode("overwrite").json(path)  # one row per class


def load_label_map(spark: SparkSession, path: str, train: DataFrame | None = None) -> DataFrame:
    """The saved table, or one rebuilt from the labels of ``train`` if nothing was saved."""
    if exists(spark, path):
        return spark.read.schema(LABEL_MAP_SCHEMA).json(path)
    if train is None:
        raise FileNotFoundError(path)
    return label_index(train)


def inverse_label_map(index: DataFrame) -> DataFrame:
    return index.select("label_id", "label")


def save_index(passages: DataFrame, path: str) -> None:
    """Passages with their ``cell``, one folder per cell.

    Rebalancing gives each cell a few files of even size and splits a cell that holds most rows.
    """
    passages.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_centres(spark: SparkSession, centres: list[list[float]], path: str) -> None:
    rows = [(n, centre) for n, centre in enumerate(centres)]
    spark.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def load_centres(spark: SparkSession, path: str) -> list[list[float]]:
    return [list(r["centre"]) for r in spark.read.parquet(path).orderBy("cell").collect()]


def save_model(spark: SparkSession, classifier: TextClassifier, path: str) -> None:
    classifier.model.write().overwrite().save(f"{path}/model")
    rows = [(label, n) for n, label in enumerate(classifier.labels)]
    save_label_map(spark.createDataFrame(rows, LABEL_MAP_SCHEMA), f"{path}/label_map")


def load_model(spark: SparkSession, path: str) -> TextClassifier:
    index = load_label_map(spark, f"{path}/label_map")
    return TextClassifier(PipelineModel.load(f"{path}/model"), labels_in_order(index))
