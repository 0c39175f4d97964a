"""Sources and sinks: what is written from the tables and read back must be what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith.catalog.base import (
    CANONICAL_SQL,
    NAMED_SQL,
    RATED_SQL,
    canonical_documents,
    named_documents,
    query,
    rated_documents,
    table,
)
from argulith.catalog.texts import EXPLANATION_SQL
from argulith.catalog.vectors import CELLS_SQL, stored_cells
from argulith.functions.explain import template_explanation
from argulith.operators.classify import train_classifier
from argulith.operators.labels import label_index
from argulith.plans.corpus import conversation_arguments
from argulith.session import scratch_path
from argulith.sources import readers, stores, writers


def _digest(column: str, out: str):
    return F.md5(F.col(column)).alias(out)


@query("scan_csv", f"SELECT doc_id, md5(text) AS text_md5, raw_label FROM ({NAMED_SQL})")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    raw = named_documents(spark, sf_dir).select("doc_id", "lang", F.col("text").alias("source_article"), F.col("raw_label").alias("logical_fallacies"))
    writers.sink_csv(raw, path)
    back = readers.scan_keyed_csv(spark, path, "doc_id", "source_article", "logical_fallacies")
    return back.select("doc_id", _digest("text", "text_md5"), "raw_label")


@query(
    "scan_taxonomy",
    """SELECT 'entry ' || doc_id AS original_name, source AS understandable_name,
       md5(trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS description_md5,
       'If ' || lang || ' occurred,' || chr(10) || chr(10) || 'then "' || source || '" occurred.' AS logical_form,
       'https://example.org/' || doc_id AS logical_form_source,
       '<MSK1> is ' || lang || ',' || chr(10) || '<MSK2>.' AS masked_logical_form FROM documents""",
)
def scan_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "taxonomy")
    cells = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("entry "), F.col("doc_id").cast("string")),
        "source",
        "text",
        F.concat(F.lit("If "), "lang", F.lit(' occurred,\n\nthen "'), "source", F.lit('" occurred.\n ')),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")),
        F.concat(F.lit(" <MSK1> is "), "lang", F.lit(",\n<MSK2>.")),
    )
    writers.sink_csv(cells.toDF(*readers.TAXONOMY_COLUMNS), path)
    back = readers.scan_taxonomy(spark, path)
    return back.withColumn("description", F.md5("description")).withColumnRenamed("description", "description_md5")


_ANSWERS_SQL = """SELECT a.conv_id * 4294967296 + a.turn AS id, a.text AS argument, q.text AS question, a.role AS type
FROM conversations a LEFT JOIN conversations q ON q.conv_id = a.conv_id AND q.turn + 1 = a.turn WHERE a.role = 'assistant'"""


@query("scan_jsonl", f"SELECT id, md5(argument) AS text_md5, md5(question) AS question_md5, type FROM ({_ANSWERS_SQL})")
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "passages")
    passages = conversation_arguments(table(spark, sf_dir, "conversations")).withColumnRenamed("argument", "text")
    writers.sink_jsonl(passages.withColumn("text_normalized", F.lit("")), path)
    back = readers.scan_jsonl(spark, path)
    return back.select("id", _digest("text", "text_md5"), _digest("question", "question_md5"), "type")


@query("sink_jsonl", "SELECT doc_id, lang, source, md5(text) AS text_md5, n_chars FROM documents")
def sink_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    documents = table(spark, sf_dir, "documents")
    writers.sink_jsonl(documents, path)
    back = spark.read.schema(documents.schema).json(path)
    return back.select("doc_id", "lang", "source", _digest("text", "text_md5"), "n_chars")


@query("sink_csv", f"SELECT doc_id, md5(text) AS text_md5, label FROM ({CANONICAL_SQL})")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    writers.sink_csv(canonical_documents(spark, sf_dir).select("doc_id", "text", "label"), path)
    back = readers.read_csv(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), _digest("text", "text_md5"), "label")


@query(
    "sink_explanations",
    f"""SELECT md5(text) AS text_md5, label AS predicted_fallacy, confidence, md5({EXPLANATION_SQL}) AS explanation_md5
    FROM ({CANONICAL_SQL})""",
)
def sink_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "explanations")
    explained = canonical_documents(spark, sf_dir).withColumn(
        "explanation", template_explanation(F.col("text"), F.col("label"), F.col("confidence"))
    )
    writers.sink_explanations(explained.withColumnRenamed("label", "predicted_fallacy"), path)
    schema = "text string, predicted_fallacy string, confidence double, explanation string"
    back = spark.read.schema(schema).json(path)
    return back.select(
        _digest("text", "text_md5"), "predicted_fallacy", "confidence", _digest("explanation", "explanation_md5")
    )


@query(
    "label_map_io",
    "SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id FROM "
    "(SELECT DISTINCT 'class_' || (quality * 2 + toxic) AS label FROM labels JOIN documents USING (doc_id))",
)
def label_map_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "label_map")
    stores.save_label_map(label_index(rated_documents(spark, sf_dir)), path)
    saved = stores.load_label_map(spark, path)
    return stores.inverse_label_map(saved).select("label", "label_id")


@query("resolve_source", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def resolve_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = readers.resolve_source(spark, [f"{sf_dir}/documents_clean.parquet", f"{sf_dir}/documents.parquet"])
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("index_io", f"SELECT vec_id, label, cell FROM ({CELLS_SQL}) JOIN embeddings USING (vec_id)")
def index_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, _ = stored_cells(spark, sf_dir)
    return cells.select("vec_id", "label", F.col("cell").cast("int").alias("cell"))


@query("model_io", f"SELECT lang, count(*) AS n, count(*) AS n_same FROM ({RATED_SQL}) GROUP BY lang")
def model_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier gives the same predictions after it was saved and loaded."""
    path = scratch_path(spark, "classifier")
    rated = rated_documents(spark, sf_dir)
    fitted = train_classifier(rated, dimensions=256, max_iter=5)
    stores.save_model(spark, fitted, path)
    before = fitted.transform(rated).select("doc_id", "lang", "pred", "confidence")
    after = stores.load_model(spark, path).transform(rated).select("doc_id", F.struct("pred", "confidence").alias("again"))
    same = F.struct("pred", "confidence") == F.col("again")
    return before.join(after, "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("n_same"))
