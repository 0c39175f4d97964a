"""Composite jobs: data set, corpus, index, audit, stream, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith.catalog.base import (
    ENTITIES_SQL,
    MASKS_SQL,
    RAW_NAMES,
    ALIASES_SQL,
    clean_sql,
    documents_with_entities,
    documents_with_masks,
    pick,
    pick_sql,
    query,
    rated_documents,
    RATED_SQL,
    six,
    table,
)
from argulith.catalog.io import _ANSWERS_SQL
from argulith.catalog.tables import _OVERLAP_SQL, stratified_sql
from argulith.catalog.texts import (
    CONCEPTS_SQL,
    documents_with_concepts,
    explanation_sql,
    gazetteer,
    masked_sql,
)
from argulith.catalog.vectors import PREDICTIONS_SQL, tfidf_ctes
from argulith.functions.explain import template_explanation
from argulith.functions.text import clean_text, longer_than
from argulith.operators import classify, dedup, hits, labels, ranking, search
from argulith.plans import corpus as corpus_plan
from argulith.plans import leakage, prepare, scoring
from argulith.session import scratch_path, spread, stage
from argulith.sources.readers import scan_jsonl
from argulith.sources.writers import sink_jsonl
from argulith.streaming.score import stream_score, text_stream

# --- the flagship: rated documents, cleaned, split, counted ---------------------------------------

_KEPT_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
FROM ({RATED_SQL}) WHERE length(text) > 50) WHERE rn = 1"""


@query(
    "prepared_distribution",
    f"""SELECT split, label, count(*) AS n, sum(length(cleaned))::BIGINT AS chars FROM (SELECT *, {clean_sql('text')} AS cleaned
    FROM ({stratified_sql(_KEPT_SQL)})) GROUP BY split, label""",
)
def prepared_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length filter, deduplication, cleaning, stratified split, rows and characters per split and class."""
    kept = dedup.dedup_exact(rated_documents(spark, sf_dir).filter(longer_than(F.col("text"), 50)))
    # Staged, as the split goes over its input more than once.
    cleaned = stage(kept.select("doc_id", "label", F.length(clean_text(F.col("text"))).alias("chars")), "cleaned")
    parts = ranking.stratified_split(cleaned, "label", "doc_id")
    return parts.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


# --- data set and corpus --------------------------------------------------------------------------


def _raw_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two sources with column names of their own, brought to one schema."""
    named = documents_with_entities(spark, sf_dir).withColumn("raw_label", pick(RAW_NAMES))
    here = F.col("source") < "src15"
    one = named.filter(here).select("doc_id", F.col("text").alias("source_article"), F.col("raw_label").alias("logical_fallacies"))
    other = named.filter(~here).select("doc_id", F.col("text").alias("masked_articles"), F.col("raw_label").alias("updated_label"))
    return [
        labels.project_text_label(one, "source_article", "logical_fallacies"),
        labels.project_text_label(other, "masked_articles", "updated_label"),
    ]


_MAPPED_SQL = f"SELECT doc_id, text, label FROM (SELECT *, {pick_sql(RAW_NAMES)} AS raw_label FROM ({ENTITIES_SQL})) JOIN ({ALIASES_SQL}) USING (raw_label)"
_DATASET_ROWS_SQL = f"""SELECT doc_id, label, {masked_sql('t')} AS text FROM (SELECT doc_id, label, {clean_sql('text')} AS t FROM (
SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM ({_MAPPED_SQL})) WHERE rn = 1 AND length(text) > 50)"""
DATASET_SQL = f"SELECT *, (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS label_id FROM ({stratified_sql(_DATASET_ROWS_SQL)})"


@query("prepare_dataset", f"SELECT doc_id, md5(text) AS text_md5, label, label_id, split FROM ({DATASET_SQL})")
def prepare_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = prepare.prepare_dataset(_raw_sources(spark, sf_dir), gazetteer(spark, sf_dir))
    return dataset.select("doc_id", F.md5("text").alias("text_md5"), "label", "label_id", "split")


_CORPUS_SQL = f"""SELECT id, argument[1:500] AS text, {masked_sql('t')} AS text_normalized, coalesce(question, '')[1:200] AS question, type
FROM (SELECT *, {clean_sql('argument')} AS t FROM ({_ANSWERS_SQL}) WHERE length(argument) > 50)"""


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    answers = corpus_plan.conversation_arguments(conversations, corpus_plan.QUESTION_CHARS)
    return corpus_plan.build_corpus(answers, gazetteer(spark, sf_dir))


@query("build_corpus", f"SELECT id, text, md5(text_normalized) AS normalized_md5, question, type FROM ({_CORPUS_SQL})")
def build_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passages(spark, sf_dir).select(
        "id", "text", F.md5("text_normalized").alias("normalized_md5"), "question", "type"
    )


@query(
    "corpus_to_index",
    f"""SELECT item_id AS query_id, least(5, (SELECT count(*) FROM ({_CORPUS_SQL}))) AS n_found, true AS ranks_run,
    true AS scores_fall, least(5, (SELECT count(*) FROM ({_CORPUS_SQL}))) AS n_own_texts FROM benchmark""",
)
def corpus_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as passages, encoded and stored by cell; every benchmark text searches them.

    SQL cannot follow k-means; it knows how many hits each query has, that they are ranked by falling
    scores, and that each shows the text of the passage it names.
    """
    path = scratch_path(spark, "corpus_index")
    sink_jsonl(_passages(spark, sf_dir), f"{path}/corpus")
    passages = scan_jsonl(spark, f"{path}/corpus")
    index = corpus_plan.corpus_to_index(passages, path, n_cells=8, dimensions=128)
    found = corpus_plan.search_index(index, table(spark, sf_dir, "benchmark"), 5, id_col="item_id")
    own = passages.select("id", F.md5(F.substring("text", 1, 200)).alias("own_md5"))  # hits show 200 characters
    hits_ = found.join(own, "id", "left").groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", (-F.col("score")).alias("low")))).alias("hits"),
        F.count_if(F.col("own_md5") == F.md5("text")).alias("n_own_texts"),
    )
    ranks, lows = F.col("hits.rank"), F.col("hits.low")
    return hits_.select(
        "query_id",
        F.size("hits").cast("long").alias("n_found"),
        (ranks == F.sequence(F.lit(1), F.size("hits"))).alias("ranks_run"),
        (lows == F.sort_array(lows)).alias("scores_fall"),
        "n_own_texts",
    )


@query(
    "corpus_union",
    f"""SELECT corpus, id, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY corpus, id) AS rn FROM (
    SELECT 'documents' AS corpus, doc_id AS id, text FROM documents UNION ALL
    SELECT 'forum', conv_id * 4294967296 + turn, text FROM conversations)) WHERE rn = 1""",
)
def corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    forum = table(spark, sf_dir, "conversations").select(corpus_plan.passage_key(F.col("conv_id"), F.col("turn")).alias("id"), "text")
    both = dedup.corpus_union({"documents": documents, "forum": forum}, id_col="id")
    return both.select("corpus", "id", F.md5("text").alias("text_md5"))


# --- leakage --------------------------------------------------------------------------------------


def report_sql(rows: str) -> str:
    """The audit of ``rows`` (doc_id, text, label, split) in one row."""
    lengths = ", ".join(
        f"round(avg(length(text)) FILTER (split = '{p}'), 6) AS {p}_mean_length, min(length(text)) FILTER (split = '{p}') AS {p}_min_length, "
        f"max(length(text)) FILTER (split = '{p}') AS {p}_max_length"
        for p in leakage.SPLITS
    )
    return f"""WITH s AS ({rows}), parts AS (SELECT * FROM s WHERE split <> 'val'), {tfidf_ctes('SELECT * FROM parts')},
    met AS (SELECT a.doc_id, b.doc_id AS other, sum(a.x * b.x) AS dot FROM w a JOIN w b USING (term)
      JOIN parts ta ON ta.doc_id = a.doc_id AND ta.split = 'test' JOIN parts tb ON tb.doc_id = b.doc_id AND tb.split = 'train' GROUP BY a.doc_id, b.doc_id),
    near AS (SELECT count(DISTINCT doc_id) AS near_duplicates FROM met WHERE dot > 0.85),
    figures AS (SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows,
      count(*) FILTER (split = 'test') AS test_rows, {lengths},
      count(*) FILTER (split = 'train' AND regexp_matches(text, '\\[MSK\\d+\\]')) AS train_masked,
      count(*) FILTER (split = 'test' AND regexp_matches(text, '\\[MSK\\d+\\]')) AS test_masked,
      count(DISTINCT label) FILTER (split = 'test') AS test_labels FROM s),
    overlap AS ({_OVERLAP_SQL})
    SELECT *, round(train_masked / greatest(train_rows, 1)::DOUBLE, 6) AS train_masked_share,
    round(test_masked / greatest(test_rows, 1)::DOUBLE, 6) AS test_masked_share, test_rows AS compared, train_val_overlap > 0 OR train_test_overlap > 0 AS exact_leak, near_duplicates > 20 AS near_leak
    FROM figures, overlap, near"""


def _report(df: DataFrame) -> DataFrame:
    report = leakage.leakage_report(df)
    for part in leakage.SPLITS:
        report = report.withColumn(f"{part}_mean_length", six(f"{part}_mean_length"))
    for part in ("train", "test"):
        report = report.withColumn(f"{part}_masked_share", six(f"{part}_masked_share"))
    whole = [c for c in report.columns if c.endswith(("_min_length", "_max_length")) or c == "test_labels"]
    return report.select(*[F.col(c).cast("long").alias(c) if c in whole else F.col(c) for c in report.columns])


@query("leakage_report", report_sql(f"SELECT doc_id, text, label, split FROM ({MASKS_SQL})"))
def leakage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spread(documents_with_masks(spark, sf_dir).select("doc_id", "text", "label", "split")))


@query("leakage_audit", report_sql(f"SELECT doc_id, text, label, split FROM ({DATASET_SQL})"))
def leakage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the prepared data set: cleaning may have made copies that were none before."""
    return _report(prepare.prepare_dataset(_raw_sources(spark, sf_dir), gazetteer(spark, sf_dir)))


# --- stream ---------------------------------------------------------------------------------------


@query("stream_score", f"SELECT vec_id, pred AS fallacy, round(confidence, 6) AS confidence FROM ({PREDICTIONS_SQL})")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings arrive as a stream and are scored in micro-batches."""
    embeddings = table(spark, sf_dir, "embeddings")
    scorer = classify.centroid_scorer(embeddings)
    # A pattern, as a stream takes only folders otherwise; the table is one file or a folder of files.
    requests = text_stream(spark, f"{sf_dir}/embeddings.parque[t]", embeddings.schema)
    out = scratch_path(spark, "scored")

    def scoring_plan(df: DataFrame) -> DataFrame:
        return scoring.predict(df, scorer).select("vec_id", F.col("pred").alias("fallacy"), six("confidence").alias("confidence"))

    stream_score(requests, scoring_plan, out, scratch_path(spark, "stream_checkpoint")).awaitTermination()
    return spark.read.parquet(out)


# --- enrichment and training pairs ----------------------------------------------------------------

# Regions hold nations, nations are of a kind and part of their region; the kinds lead on, and in a circle.
_KINDS = [("nation", "IsA", "place"), ("place", "PartOf", "world"), ("world", "HasPart", "place"), ("world", "IsA", "whole")]
_EDGES_SQL = """SELECT r_name AS concept, 'HasPart' AS relation, n_name AS target FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT n_name, 'PartOf', r_name FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT n_name, 'IsA', 'nation' FROM nation UNION ALL VALUES {}""".format(
    ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _KINDS)
)
_DEPTH = 3


@query(
    "concept_enrichment",
    f"""WITH RECURSIVE named AS (SELECT doc_id, unnest(list_concat(organizations, locations)) AS root FROM ({CONCEPTS_SQL})),
    edges AS ({_EDGES_SQL}),
    reached AS (SELECT DISTINCT root, root AS concept, 0 AS depth FROM named
      UNION SELECT r.root, e.target, r.depth + 1 FROM reached r JOIN edges e USING (concept) WHERE r.depth < {_DEPTH - 1}),
    f AS (SELECT DISTINCT doc_id, concept || ' ' || relation || ' ' || target AS fact FROM named JOIN reached USING (root) JOIN edges USING (concept))
    SELECT d.doc_id, coalesce(string_agg(fact, ';' ORDER BY fact), '') AS facts FROM documents d LEFT JOIN f
    ON f.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def concept_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts up to three edges from the concepts of every document."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    held = region.join(nation, region.r_regionkey == nation.n_regionkey)
    edges = [
        held.select(F.col("r_name").alias("concept"), F.lit("HasPart").alias("relation"), F.col("n_name").alias("target")),
        held.select(F.col("n_name"), F.lit("PartOf"), F.col("r_name")),
        nation.select(F.col("n_name"), F.lit("IsA"), F.lit("nation")),
        spark.createDataFrame(_KINDS, "concept string, relation string, target string"),
    ]
    named = documents_with_concepts(spark, sf_dir).select(
        "doc_id", F.concat("concepts.organizations", "concepts.locations").alias("names")
    )
    graph = edges[0].union(edges[1]).union(edges[2]).union(edges[3])
    enriched = hits.concept_enrichment(named, graph, "doc_id", "names", _DEPTH)
    return enriched.select("doc_id", F.array_join("facts", ";").alias("facts"))


@query(
    "choose_classifier",
    f"""WITH s AS ({stratified_sql(RATED_SQL)})
    SELECT count(*) FILTER (split = 'test') AS n_test, 3::BIGINT AS n_candidates, true AS best_is_chosen, true AS right_on_test,
    (SELECT count(DISTINCT label) FROM s WHERE split = 'train') > 1 AS names_several FROM s""",
)
def choose_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the split to the test report.

    SQL knows the rows; that the chosen one is the best, that it names more than one class if it has learned
    more than one, and that the report says what it predicts must hold.
    """
    dataset = ranking.stratified_split(rated_documents(spark, sf_dir), "label", "doc_id")
    chosen, candidates, report = classify.choose_classifier(dataset, dimensions=256)
    in_test = F.col("split") == "test"
    right = scoring.predict(dataset, chosen).agg(
        F.count_if(in_test).alias("n_test"),
        F.avg(F.when(in_test, (F.col("label") == F.col("pred")).cast("double"))).alias("share"),
        F.count_distinct("pred").alias("named"),
    )
    best = candidates.agg(F.count(F.lit(1)).alias("n_candidates"), F.max("macro_f1").alias("most"), F.max_by("macro_f1", F.struct("macro_f1", -F.col("position"))).alias("first"))
    # Three one-row tables: stacked with nulls, then folded.
    stacked = right.unionByName(best, True).unionByName(report.select("accuracy"), True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns]).select(
        "n_test",
        "n_candidates",
        (F.col("most") == F.col("first")).alias("best_is_chosen"),
        (F.abs(F.col("share") - F.col("accuracy")) < 1e-9).alias("right_on_test"),
        (F.col("named") > 1).alias("names_several"),
    )
