"""Labels, filters, duplicates, sampling, splits, joins, aggregates and ranks over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.catalog.base import (
    ALIASES_SQL,
    CANONICAL_SQL,
    MASKS_SQL,
    NAMED_SQL,
    SPLIT_SQL,
    canonical_documents,
    documents_with_masks,
    named_documents,
    query,
    quoted,
    six,
    split_documents,
    table,
)
from argulith.functions import text as tx
from argulith.operators import dedup, hits, labels, ranking, search
from argulith.plans import leakage

# --- projections, filters, labels ----------------------------------------------------------------


@query("project_text_label", f"SELECT doc_id, md5(text) AS text_md5, raw_label FROM ({NAMED_SQL})")
def project_text_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = labels.project_text_label(named_documents(spark, sf_dir), "text", "raw_label")
    return projected.select("doc_id", F.md5("text").alias("text_md5"), "raw_label")


_MAPPED_SQL = f"SELECT n.*, a.label FROM ({NAMED_SQL}) n LEFT JOIN ({ALIASES_SQL}) a USING (raw_label)"


@query("canonical_label", f"SELECT doc_id, raw_label, label FROM ({_MAPPED_SQL})")
def canonical_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.canonical_label(named_documents(spark, sf_dir).select("doc_id", "raw_label"), "raw_label").select(
        "doc_id", "raw_label", "label"
    )


@query("drop_unmapped", f"SELECT doc_id, label FROM ({_MAPPED_SQL}) WHERE label IS NOT NULL")
def drop_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = labels.canonical_label(named_documents(spark, sf_dir).select("doc_id", "raw_label"), "raw_label")
    return labels.drop_unmapped(mapped).select("doc_id", "label")


@query(
    "null_text_to_empty",
    "SELECT doc_id, length(coalesce(CASE WHEN lang = 'fr' THEN NULL ELSE text END, '')) AS n FROM documents",
)
def null_text_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = F.when(F.col("lang") != "fr", F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(tx.null_text_to_empty(holed)).cast("long").alias("n")
    )


@query("min_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) > 50")
def min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(tx.longer_than(F.col("text"), 50)).select("doc_id", "n_chars")


_INDEX_SQL = f"SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id FROM (SELECT DISTINCT label FROM ({_MAPPED_SQL}) WHERE label IS NOT NULL)"


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.canonical_label(named_documents(spark, sf_dir).select("doc_id", "raw_label"), "raw_label")


@query("label_index", _INDEX_SQL)
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_index(_mapped(spark, sf_dir))


@query(
    "unknown_label_zero",
    f"SELECT doc_id, coalesce(label_id, 0) AS label_id FROM ({_MAPPED_SQL}) LEFT JOIN ({_INDEX_SQL}) USING (label)",
)
def unknown_label_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _mapped(spark, sf_dir)
    return labels.encode_label(mapped, labels.label_index(mapped), unmapped="zero").select("doc_id", "label_id")


@query("encode_label", f"SELECT doc_id, label_id FROM ({_MAPPED_SQL}) JOIN ({_INDEX_SQL}) USING (label)")
def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = _mapped(spark, sf_dir)
    return labels.encode_label(mapped, labels.label_index(mapped)).select("doc_id", "label_id")


@query("decode_label", f"SELECT doc_id, label FROM (SELECT doc_id, (doc_id % 13)::INTEGER AS label_id FROM documents) JOIN ({_INDEX_SQL}) USING (label_id)")
def decode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 13).cast("int").alias("label_id"))
    return labels.decode_label(ids, labels.label_index(_mapped(spark, sf_dir))).select("doc_id", "label")


@query(
    "truncate_text",
    "SELECT doc_id, text[1:50] || '...' AS claim, text[1:100] AS shown, md5(text[1:200]) AS example_md5, "
    "md5(text[1:500]) AS passage_md5 FROM documents",
)
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.truncate_text(text, 50, "...").alias("claim"),
        tx.truncate_text(text, 100).alias("shown"),
        F.md5(tx.truncate_text(text, 200)).alias("example_md5"),
        F.md5(tx.truncate_text(text, 500)).alias("passage_md5"),
    )


_DESCRIPTIONS_SQL = "SELECT * FROM (VALUES {}) AS v(label, text)".format(
    ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in fixed.STANDARD_EXPLANATIONS.items())
)


@query(
    "lookup_with_default",
    f"SELECT doc_id, label, coalesce(v.text, {quoted(fixed.STANDARD_EXPLANATION_DEFAULT)}) AS explanation "
    f"FROM (SELECT doc_id, label FROM ({CANONICAL_SQL})) LEFT JOIN ({_DESCRIPTIONS_SQL}) v USING (label)",
)
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = spark.createDataFrame(list(fixed.STANDARD_EXPLANATIONS.items()), "label string, sentence string")
    labelled = canonical_documents(spark, sf_dir).select("doc_id", "label")
    return labels.lookup_with_default(
        labelled, sentences, "label", "sentence", fixed.STANDARD_EXPLANATION_DEFAULT, "explanation"
    ).select("doc_id", "label", "explanation")


# --- unions, duplicates, samples, splits ---------------------------------------------------------


@query("union_sources", "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    here = F.col("source") < "src15"
    one = documents.filter(here).select("doc_id", F.col("text").alias("source_article"), "lang")
    other = documents.filter(~here).select("lang", F.col("text").alias("masked_articles"), "doc_id")
    both = dedup.union_sources(
        one.withColumnRenamed("source_article", "text"), other.withColumnRenamed("masked_articles", "text")
    )
    return both.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


_FIRST_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"


@query("dedup_exact", f"SELECT doc_id, md5(text) AS text_md5 FROM ({_FIRST_SQL})")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.dedup_exact(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


@query("keep_first", f"SELECT doc_id, lang, source, n_chars FROM ({_FIRST_SQL})")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


_SHUFFLED_SQL = "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS row_idx FROM documents"


@query("seeded_shuffle", _SHUFFLED_SQL)
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.shuffled_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select(
        "doc_id", "row_idx"
    )


@query("row_index", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey * 8 + l_linenumber) - 1 AS row_idx FROM lineitem")
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key")
    )
    return ranking.row_index(lines, "line_key").select("l_orderkey", "l_linenumber", "row_idx")


# The sample is the operator's own result; it is drawn from all documents.
@query("sample_n", "SELECT doc_id, n_chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 500")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sample_n(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 500, "doc_id")


@query("head_n", "SELECT doc_id, text[1:150] AS shown FROM documents ORDER BY doc_id LIMIT 10")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = ranking.head_n(table(spark, sf_dir, "documents"), 10, "doc_id")
    return first.select("doc_id", tx.truncate_text(F.col("text"), 150).alias("shown"))


@query("top_labels", f"SELECT raw_label, count(*) AS n FROM ({NAMED_SQL}) GROUP BY raw_label ORDER BY n DESC, raw_label NULLS FIRST LIMIT 15")
def top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.top_labels(named_documents(spark, sf_dir), 15, "raw_label")


def stratified_sql(rows: str, key: str = "doc_id", label: str = "label") -> str:
    return f"""SELECT *, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + floor((n - n_test) * 111 / 1000.0 + 0.5)
      THEN 'val' ELSE 'train' END AS split FROM (SELECT *, floor(n * 10 / 100.0 + 0.5) AS n_test FROM (
      SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {key}), {key}) AS r,
      count(*) OVER (PARTITION BY {label}) AS n FROM ({rows})))"""


_RAW_SQL = f"SELECT doc_id, raw_label AS label FROM ({NAMED_SQL})"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under their raw names; null is one of the classes."""
    return named_documents(spark, sf_dir).select("doc_id", F.col("raw_label").alias("label"))


@query("stratified_split", f"SELECT doc_id, label, split FROM ({stratified_sql(_RAW_SQL)})")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.stratified_split(_raw(spark, sf_dir), "label", "doc_id").select("doc_id", "label", "split")


@query(
    "rank_in_class",
    "SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS rank_in_class, "
    f"count(*) OVER (PARTITION BY label) AS class_size FROM ({_RAW_SQL})",
)
def rank_in_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.rank_in_class(_raw(spark, sf_dir), "label", "doc_id")
    return ranked.select("doc_id", "label", "rank_in_class", "class_size")


_OVERLAP_SQL = f"""SELECT
 (SELECT count(*) FROM (SELECT text FROM s WHERE split = 'train' INTERSECT SELECT text FROM s WHERE split = 'val')) AS train_val_overlap,
 (SELECT count(*) FROM (SELECT text FROM s WHERE split = 'train' INTERSECT SELECT text FROM s WHERE split = 'test')) AS train_test_overlap"""


@query("split_overlap", f"WITH s AS ({SPLIT_SQL}) {_OVERLAP_SQL}")
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.split_overlap(split_documents(spark, sf_dir))


@query(
    "contaminated_rows",
    f"WITH s AS ({SPLIT_SQL}) SELECT doc_id, split, text IN (SELECT text FROM s WHERE split = 'train') AS contaminated "
    "FROM s WHERE split <> 'train'",
)
def contaminated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = split_documents(spark, sf_dir).select("doc_id", "text", "split")
    train, held_out = documents.filter(F.col("split") == "train"), documents.filter(F.col("split") != "train")
    return dedup.mark_contaminated(held_out, train).select("doc_id", "split", "contaminated")


# --- joins on hits -------------------------------------------------------------------------------

# Every document's line of text that stands for its hit list: its three neighbours by key.
_NEAR_SQL = "SELECT doc_id AS query_id, doc_id + s AS id, 1.0::DOUBLE / s AS score FROM documents, (VALUES (1), (2), (3)) AS v(s)"


def _neighbour_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.explode(F.sequence(F.lit(1), F.lit(3)))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("query_id"), steps.alias("s")).select(
        "query_id", (F.col("query_id") + F.col("s")).alias("id"), (1.0 / F.col("s")).alias("score")
    )


@query("hits_to_passages", f"SELECT query_id, id, round(score, 6) AS score, text[1:200] AS text FROM ({_NEAR_SQL}) JOIN (SELECT doc_id AS id, text FROM documents) USING (id)")
def hits_to_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits.hits_to_passages(_neighbour_hits(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id")
    return found.select("query_id", "id", six("score").alias("score"), "text")


@query("valid_hit_filter", f"SELECT query_id, id FROM ({_NEAR_SQL}) WHERE id IN (SELECT doc_id FROM labels)")
def valid_hit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = hits.valid_hit_filter(_neighbour_hits(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")
    return valid.select("query_id", "id")


@query(
    "top_hits_array",
    f"""SELECT query_id, count(*) AS n, string_agg(id || ':' || round(score, 4), ',' ORDER BY score DESC, id) AS best
    FROM ({_NEAR_SQL}) WHERE id IN (SELECT doc_id FROM documents) GROUP BY query_id""",
)
def top_hits_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = hits.valid_hit_filter(_neighbour_hits(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id")
    lists = hits.top_hits_array(known.withColumn("text", F.col("id").cast("string")))
    shown = F.transform(
        "similar_examples", lambda h: F.concat(h["text"], F.lit(":"), F.round(h["score"], 4).cast("string"))
    )
    return lists.select("query_id", F.size("similar_examples").cast("long").alias("n"), F.array_join(shown, ",").alias("best"))


@query(
    "topk_per_query",
    "SELECT * FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 5",
)
def topk_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return search.topk_per_query(found, 5, "source", "doc_id", "n_chars").withColumn("rank", F.col("rank").cast("long"))


# --- aggregates ----------------------------------------------------------------------------------


@query("split_sizes", f"SELECT split, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY split")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.split_sizes(split_documents(spark, sf_dir))


@query("label_distribution", f"SELECT split, label, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY split, label")
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_distribution(split_documents(spark, sf_dir), "split", "label")


@query("distinct_labels", f"SELECT count(DISTINCT raw_label) AS n_labels FROM ({NAMED_SQL})")
def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.distinct_labels(named_documents(spark, sf_dir), "raw_label")


@query(
    "text_length_stats",
    f"SELECT split, round(avg(length(text)), 6) AS mean_length, min(length(text)) AS min_length, max(length(text)) AS max_length FROM ({SPLIT_SQL}) GROUP BY split",
)
def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = leakage.text_length_stats(split_documents(spark, sf_dir))
    return stats.select(
        "split",
        six("mean_length").alias("mean_length"),
        F.col("min_length").cast("long").alias("min_length"),
        F.col("max_length").cast("long").alias("max_length"),
    )


@query(
    "mask_rate",
    rf"""SELECT split, count(*) FILTER (regexp_matches(text, '\[MSK\d+\]')) AS masked, count(*) AS n,
    round(count(*) FILTER (regexp_matches(text, '\[MSK\d+\]')) / count(*)::DOUBLE, 6) AS mask_rate FROM ({MASKS_SQL}) GROUP BY split""",
)
def mask_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = leakage.mask_rate(documents_with_masks(spark, sf_dir))
    return rates.withColumn("mask_rate", six("mask_rate"))


@query(
    "class_weights",
    f"""SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*))::DOUBLE, 6) AS weight
    FROM ({_RAW_SQL}) WHERE label IS NOT NULL GROUP BY label""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_weights(_raw(spark, sf_dir)).withColumn("weight", six("weight"))
