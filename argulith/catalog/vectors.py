"""Vectors: arithmetic, search, TF-IDF similarity, scoring, metrics and grounding."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.catalog.base import CANONICAL_SQL, SPLIT_CASE_SQL, SPLIT_SQL, canonical_documents, query, rated_documents, six, table, texts
from argulith.catalog.texts import TOKENS_SQL
from argulith.functions import vectors as vx
from argulith.operators.bounded import broadcast_bounded
from argulith.operators import classify, hits, metrics, minhash, ranking, search, tfidf
from argulith.plans import scoring
from argulith.session import scratch_path, stage
from argulith.sources import stores

# --- arithmetic ----------------------------------------------------------------------------------


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


@query(
    "l2_normalize",
    """SELECT vec_id, round(sum(u * u), 6) AS norm2, round(sum(u), 6) + 0.0 AS total FROM (
    SELECT vec_id, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS u FROM (
    SELECT vec_id, unnest(embedding)::DOUBLE * (label + 2) AS x FROM embeddings)) GROUP BY vec_id""",
)
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    longer = F.transform(vx.as_double(F.col("embedding")), lambda x: x * (F.col("label") + 2))
    unit = _embeddings(spark, sf_dir).select("vec_id", vx.l2_normalize(longer).alias("u"))
    zero = F.lit(0.0)
    return unit.select(
        "vec_id",
        six(F.aggregate("u", zero, lambda t, x: t + x * x)).alias("norm2"),
        six(F.aggregate("u", zero, lambda t, x: t + x)).alias("total"),
    )


# Class centroids in SQL, one value per class and position.
LONG_SQL = "SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings"
CENTROIDS_SQL = f"SELECT label AS class, pos, avg(x) AS c FROM ({LONG_SQL}) GROUP BY label, pos"
LOGITS_SQL = f"SELECT vec_id, l.label, class, sum(x * c) AS logit FROM ({LONG_SQL}) l JOIN ({CENTROIDS_SQL}) USING (pos) GROUP BY vec_id, l.label, class"


@query(
    "dot_score",
    f"SELECT vec_id, round(logit, 6) + 0.0 AS score FROM ({LOGITS_SQL}) WHERE label = class",
)
def dot_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the centroid of its own class."""
    embeddings = _embeddings(spark, sf_dir)
    centroids = broadcast_bounded(classify.class_centroids(embeddings))
    return embeddings.join(centroids, "label").select(
        "vec_id", six(vx.dot_score(F.col("embedding"), F.col("centroid"))).alias("score")
    )


PROBABILITIES_SQL = f"""SELECT vec_id, label, class, logit, exp(logit - top) / sum(exp(logit - top)) OVER (PARTITION BY vec_id) AS p
FROM (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS top FROM ({LOGITS_SQL}))"""
PREDICTIONS_SQL = f"""SELECT vec_id, label, class AS pred, p AS confidence FROM (
SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, class) AS r FROM ({PROBABILITIES_SQL})) WHERE r = 1"""


def scored_embeddings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, classify.LinearScorer]:
    embeddings = _embeddings(spark, sf_dir)
    scorer = classify.centroid_scorer(embeddings)
    return classify.score(embeddings, scorer), scorer


def _logits(spark: SparkSession, sf_dir: str) -> tuple[classify.LinearScorer, DataFrame]:
    embeddings = _embeddings(spark, sf_dir)
    scorer = classify.centroid_scorer(embeddings)
    return scorer, embeddings.select("vec_id", scorer.logits(F.col("embedding")).alias("logits"))


@query("softmax", f"SELECT vec_id, class, round(p, 6) AS probability FROM ({PROBABILITIES_SQL})")
def softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer, logits = _logits(spark, sf_dir)
    classes = F.array(*[F.lit(c) for c in scorer.labels])
    pairs = F.explode(F.arrays_zip(classes.alias("class"), vx.softmax(F.col("logits")).alias("p"))).alias("e")
    return logits.select("vec_id", pairs).select("vec_id", "e.class", six("e.p").alias("probability"))


@query("argmax_label", f"SELECT vec_id, pred, round(confidence, 6) AS confidence FROM ({PREDICTIONS_SQL})")
def argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer, logits = _logits(spark, sf_dir)
    return logits.select(
        "vec_id",
        scorer.label_of(vx.argmax(F.col("logits"))).alias("pred"),
        six(F.array_max(vx.softmax(F.col("logits")))).alias("confidence"),
    )


@query(
    "topn_labels_per_row",
    f"""SELECT vec_id, class, round(p, 6) AS probability, r AS place FROM (SELECT *, row_number() OVER (
    PARTITION BY vec_id ORDER BY p DESC, class) AS r FROM ({PROBABILITIES_SQL})) WHERE r <= 3""",
)
def topn_labels_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, scorer = scored_embeddings(spark, sf_dir)
    best = F.posexplode(classify.topn_labels(F.col("probabilities"), scorer.labels, 3)).alias("place", "b")
    return scored.select("vec_id", best).select(
        "vec_id", F.col("b.label").alias("class"), six("b.probability").alias("probability"), (F.col("place") + 1).cast("long").alias("place")
    )


@query("confidence_filter", f"SELECT doc_id, label, confidence FROM ({CANONICAL_SQL}) WHERE confidence >= 0.6")
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.confidence_filter(canonical_documents(spark, sf_dir)).select("doc_id", "label", "confidence")


# --- search --------------------------------------------------------------------------------------

PAIRS_SQL = """SELECT q.vec_id AS query_id, p.vec_id AS id, round(list_dot_product(q.v, p.v), 12) AS score
FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) q,
(SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) p"""
RANKED_SQL = f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM ({PAIRS_SQL})"


@query("exact_topk", f"SELECT query_id, id, round(score, 6) + 0.0 AS score, rank FROM ({RANKED_SQL}) WHERE rank <= 5")
def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors, for every vector."""
    embeddings = _embeddings(spark, sf_dir)
    found = search.exact_topk(embeddings, embeddings, 5, first_share=1 / 64)
    return found.select("query_id", "id", six("score").alias("score"), F.col("rank").cast("long").alias("rank"))


@query(
    "query_corpus_product",
    f"""SELECT query_id, count(*) AS n, round(avg(score), 6) + 0.0 AS mean_score, round(max(score), 6) + 0.0 AS max_score,
    count(*) FILTER (score > 0.3) AS n_above FROM ({PAIRS_SQL}) GROUP BY query_id""",
)
def query_corpus_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _embeddings(spark, sf_dir)
    sums = search.query_corpus_product(embeddings, embeddings, above=0.3)
    return sums.select("query_id", "n", six("mean_score").alias("mean_score"), six("max_score").alias("max_score"), "n_above")


# Cells as `sampled_cells` makes them: seeds in hash order, a sample put to the nearest seed, centres along the sums.
CELL_CTES = """v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
wanted AS (SELECT least(65536, count(*), ceil(4 * sqrt(count(*))))::INTEGER AS n FROM v),
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS place FROM v),
seeds AS (SELECT (place - 1)::INTEGER AS cell, v AS c FROM placed, wanted WHERE place <= n),
members AS (SELECT cell, v FROM (SELECT cell, v, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(v, c), 12) DESC, cell) AS r
  FROM placed, seeds, wanted WHERE place <= 16 * n) WHERE r = 1 UNION ALL SELECT cell, c FROM seeds),
sums AS (SELECT cell, pos, sum(x) AS x FROM (SELECT cell, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM members) GROUP BY cell, pos),
centres AS (SELECT cell, list(x / length ORDER BY pos) AS c FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY cell)) AS length FROM sums) GROUP BY cell),
near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(v, c), 12) DESC, cell) AS r FROM v, centres),
cells AS (SELECT vec_id, cell FROM near WHERE r = 1)"""
CELLS_SQL = f"WITH {CELL_CTES} SELECT vec_id, cell FROM cells"


def _probed_ctes(k: int) -> str:
    """Exact hits, the number of cells that finds 92 % of those of 200 queries, and the hits in the cells probed."""
    return f"""{CELL_CTES}, ranked AS ({RANKED_SQL}), exact AS (SELECT * FROM ranked WHERE rank <= {k}),
    asked AS (SELECT vec_id FROM v ORDER BY md5('43:' || vec_id), vec_id LIMIT 200),
    places AS (SELECT n.r, row_number() OVER (ORDER BY n.r) AS i, count(*) OVER () AS n_hits FROM exact e JOIN asked a ON a.vec_id = e.query_id
      JOIN cells c ON c.vec_id = e.id JOIN near n ON n.vec_id = e.query_id AND n.cell = c.cell),
    probing AS (SELECT max(r) AS nprobe FROM places WHERE i <= ceil(0.92 * n_hits)),
    probes AS (SELECT vec_id, cell FROM near, probing WHERE r <= nprobe),
    seen AS (SELECT r.query_id, r.id, r.score, row_number() OVER (PARTITION BY r.query_id ORDER BY r.score DESC, r.id) AS rank
      FROM ranked r JOIN cells c ON c.vec_id = r.id JOIN probes p ON p.vec_id = r.query_id AND p.cell = c.cell)"""


def stored_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[list[float]]]:
    """The embeddings by cell, written and read back; cells follow the number of vectors."""
    embeddings = _embeddings(spark, sf_dir)
    centres = search.sampled_cells(embeddings, search.cells_for(embeddings.count()))
    path = scratch_path(spark, "index")
    stores.save_index(search.assign_cells(embeddings, centres), path)
    return stores.load_index(spark, path), centres


@query(
    "recall_at_k",
    f"""WITH {_probed_ctes(10)}
    SELECT round(count(s.id) / count(*)::DOUBLE, 6) AS recall, (SELECT nprobe FROM probing) AS nprobe,
      (SELECT round(count(*) / ((SELECT count(*) FROM v) * (SELECT count(*) FROM v))::DOUBLE, 6) FROM probes JOIN cells USING (cell)) AS share_read
    FROM exact e LEFT JOIN (SELECT * FROM seen WHERE rank <= 10) s ON s.query_id = e.query_id AND s.id = e.id""",
)
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a search in as many cells as sampled queries need: the recall for all queries and the part of the pairs read."""
    embeddings = _embeddings(spark, sf_dir)
    cells, centres = stored_cells(spark, sf_dir)
    nprobe = search.nprobe_for(embeddings, cells, centres, 10)
    approximate = search.ivf_topk(embeddings, cells, centres, 10, nprobe)
    recall = search.recall_at_k(approximate, search.exact_topk(embeddings, embeddings, 10))
    read = search.share_read(embeddings, cells, centres, nprobe).first()["share_read"]
    return recall.select(
        six("recall").alias("recall"), F.lit(nprobe).cast("long").alias("nprobe"), six(F.lit(read)).alias("share_read")
    )


@query("ivf_topk", f"WITH {_probed_ctes(5)} SELECT query_id, id, round(score, 6) + 0.0 AS score, rank FROM seen WHERE rank <= 5")
def ivf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of the vectors in the cells probed; the number of cells follows a recall on sampled queries."""
    embeddings = _embeddings(spark, sf_dir)
    cells, centres = stored_cells(spark, sf_dir)
    nprobe = search.nprobe_for(embeddings, cells, centres, 5)
    found = search.ivf_topk(embeddings, cells, centres, 5, nprobe)
    return found.select("query_id", "id", six("score").alias("score"), F.col("rank").cast("long").alias("rank"))


# --- TF-IDF --------------------------------------------------------------------------------------


def tfidf_ctes(rows: str) -> str:
    """``w``: unit weights per document and term, over the 1,000 most frequent terms of ``rows``."""
    return f"""tok AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM ({rows})),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
    vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 1000),
    raw AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM ({rows}))) / (1 + df)::DOUBLE) + 1) AS x FROM tf JOIN vocab USING (term)),
    w AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM raw)"""


@query(
    "tfidf_vectors",
    f"WITH {tfidf_ctes('SELECT * FROM documents')} SELECT doc_id, term, round(x, 6) AS weight FROM w",
)
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir)
    model = tfidf.fit_tfidf(documents)
    return model.long(documents, "doc_id").withColumn("weight", six("weight"))


_COMPARED_SQL = f"SELECT * FROM ({SPLIT_SQL}) WHERE split <> 'val'"
PRODUCT_CTES = f"""parts AS ({_COMPARED_SQL}), {tfidf_ctes('SELECT * FROM parts')},
test AS (SELECT doc_id FROM parts WHERE split = 'test'), train AS (SELECT doc_id FROM parts WHERE split = 'train'),
met AS (SELECT a.doc_id, b.doc_id AS other, sum(a.x * b.x) AS dot FROM (SELECT * FROM w WHERE doc_id IN (FROM test)) a
  JOIN (SELECT * FROM w WHERE doc_id IN (FROM train)) b USING (term) GROUP BY a.doc_id, b.doc_id),
sims AS (SELECT doc_id, (SELECT count(*) FROM train) AS n, coalesce(sum(dot), 0) / (SELECT count(*) FROM train) AS mean_score,
  coalesce(max(dot), 0) AS max_score, count(*) FILTER (dot > 0.85) AS n_above FROM test LEFT JOIN met USING (doc_id) GROUP BY doc_id)"""


def _train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, tfidf.TfIdf]:
    parts = ranking.hash_split(texts(spark, sf_dir), "doc_id").filter(F.col("split") != "val")
    model = tfidf.fit_tfidf(parts)
    return parts.filter(F.col("split") == "test"), parts.filter(F.col("split") == "train"), model


@query(
    "split_product",
    f"WITH {PRODUCT_CTES} SELECT doc_id, n, round(mean_score, 6) AS mean_score, round(max_score, 6) AS max_score, n_above FROM sims",
)
def split_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All test rows against all train rows."""
    sums = tfidf.split_product(*_train_test(spark, sf_dir))
    return sums.select("doc_id", "n", six("mean_score").alias("mean_score"), six("max_score").alias("max_score"), "n_above")


@query(
    "tfidf_similarity",
    f"""WITH {PRODUCT_CTES} SELECT doc_id, other AS train_id, round(dot, 6) AS similarity, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(dot, 12) DESC, other) AS rank FROM met) WHERE rank <= 3 AND dot > 0""",
)
def tfidf_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most similar train rows of every test row."""
    test, train, model = _train_test(spark, sf_dir)
    as_vectors = [model.encode(df, out="vector").select("doc_id", "vector") for df in (test, train)]
    found = search.exact_topk(*as_vectors, 3, "doc_id", "doc_id", "vector").filter(F.col("score") > 0)
    return found.select(
        F.col("query_id").alias("doc_id"), F.col("id").alias("train_id"), six("score").alias("similarity"), F.col("rank").cast("long").alias("rank")
    )


@query("max_similarity", f"WITH {PRODUCT_CTES} SELECT doc_id, round(max_score, 6) AS max_similarity FROM sims")
def max_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tfidf.max_similarity(*_train_test(spark, sf_dir))
    return found.withColumn("max_similarity", six("max_similarity"))


@query(
    "near_duplicate_count",
    f"WITH {PRODUCT_CTES} SELECT count(*) FILTER (max_score > 0.85) AS near_duplicates, count(*) AS compared FROM sims",
)
def near_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.near_duplicate_count(tfidf.near_copies(*_train_test(spark, sf_dir)))


_SETS_SQL = f"""SELECT split, min(doc_id) AS id, words FROM (
SELECT doc_id, split, list_sort(list_distinct({TOKENS_SQL})) AS words FROM ({_COMPARED_SQL})) WHERE len(words) > 0 GROUP BY split, words"""


@query(
    "minhash_similarity",
    f"""WITH sets AS ({_SETS_SQL}), met AS (SELECT a.id AS doc_id, b.id AS train_id, len(list_intersect(a.words, b.words)) AS common,
      len(a.words) + len(b.words) AS total FROM sets a JOIN sets b ON a.split = 'test' AND b.split = 'train')
    SELECT doc_id, train_id, round(common / (total - common)::DOUBLE, 6) AS jaccard FROM met WHERE common / (total - common)::DOUBLE >= 0.8""",
)
def minhash_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test and train rows that share four fifths of their words, found by equal bands; SQL compares all pairs."""
    parts = ranking.hash_split(texts(spark, sf_dir), "doc_id")
    found = minhash.minhash_join(*(parts.filter(F.col("split") == name) for name in ("test", "train")))
    return found.select(F.col("left_id").alias("doc_id"), F.col("right_id").alias("train_id"), six("jaccard").alias("jaccard"))


# --- metrics -------------------------------------------------------------------------------------

_PAIRS_OF_LABELS_SQL = f"SELECT label, pred FROM ({PREDICTIONS_SQL})"


def scores_ctes(pairs: str) -> str:
    return f"""pairs AS ({pairs}), classes AS (SELECT label FROM pairs UNION SELECT pred FROM pairs),
    counted AS (SELECT c.label, (SELECT count(*) FROM pairs p WHERE p.label = c.label AND p.pred = c.label) AS tp,
      (SELECT count(*) FROM pairs p WHERE p.label = c.label) AS support, (SELECT count(*) FROM pairs p WHERE p.pred = c.label) AS predicted FROM classes c),
    scores AS (SELECT label, support, tp, CASE WHEN predicted > 0 THEN tp / predicted::DOUBLE ELSE 0 END AS precision,
      CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0 END AS recall,
      CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted)::DOUBLE ELSE 0 END AS f1 FROM counted)"""


_SCORES = scores_ctes(_PAIRS_OF_LABELS_SQL)


@query("confusion_matrix", f"SELECT label, pred, count(*) AS n FROM ({_PAIRS_OF_LABELS_SQL}) GROUP BY label, pred")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(scored_embeddings(spark, sf_dir)[0])


@query("accuracy", f"SELECT round(avg((label = pred)::INTEGER), 6) AS accuracy FROM ({_PAIRS_OF_LABELS_SQL})")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(scored_embeddings(spark, sf_dir)[0]).select(six("accuracy").alias("accuracy"))


@query("macro_f1", f"WITH {_SCORES} SELECT round(avg(f1), 6) AS macro_f1 FROM scores")
def macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro_f1(scored_embeddings(spark, sf_dir)[0]).select(six("macro_f1").alias("macro_f1"))


@query("weighted_f1", f"WITH {_SCORES} SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM scores")
def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weighted_f1(scored_embeddings(spark, sf_dir)[0]).select(six("weighted_f1").alias("weighted_f1"))


def _report_sql(ctes: str) -> str:
    return f"""WITH {ctes}, a AS (SELECT sum(tp) / sum(support) AS acc, sum(support)::BIGINT AS n FROM scores)
    SELECT label::VARCHAR AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores
    UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM scores
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM scores"""


@query("classification_report", _report_sql(_SCORES))
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(metrics.confusion_matrix(scored_embeddings(spark, sf_dir)[0]))
    return report.select("label", *[six(m).alias(m) for m in ("precision", "recall", "f1")], "support")


# Held-out evaluation: centroids of the train part, judged on the other parts.
_PARTS_SQL = f"SELECT *, {SPLIT_CASE_SQL.format('vec_id')} AS split FROM embeddings"
_LONG_PARTS_SQL = f"SELECT vec_id, label, split, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM ({_PARTS_SQL})"


def held_out_sql(part: str, unit: bool = False) -> str:
    """(label, pred) of one part under the centroids of train."""
    weights = f"SELECT label AS class, pos, avg(x) AS c FROM ({_LONG_PARTS_SQL}) WHERE split = 'train' GROUP BY label, pos"
    if unit:
        weights = f"SELECT class, pos, c / sqrt(sum(c * c) OVER (PARTITION BY class)) AS c FROM ({weights})"
    return f"""SELECT label, class AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, class) AS r FROM (
      SELECT vec_id, l.label, class, sum(x * c) AS logit FROM ({_LONG_PARTS_SQL}) l JOIN ({weights}) USING (pos)
      WHERE split = '{part}' GROUP BY vec_id, l.label, class)) WHERE r = 1"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.hash_split(_embeddings(spark, sf_dir), "vec_id")


@query(
    "evaluate_model",
    f"""WITH {scores_ctes(held_out_sql('test'))} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
    round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM scores""",
)
def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    scorer = classify.centroid_scorer(parts.filter(F.col("split") == "train"))
    record = scoring.evaluate_model(parts.filter(F.col("split") == "test"), scorer)
    return record.select(*[six(c).alias(c) for c in record.columns])


@query(
    "best_model",
    f"""WITH a AS (WITH {scores_ctes(held_out_sql('val'))} SELECT 'mean' AS model, 0 AS position, avg(f1) AS macro_f1 FROM scores),
    b AS (WITH {scores_ctes(held_out_sql('val', True))} SELECT 'unit' AS model, 1 AS position, avg(f1) AS macro_f1 FROM scores),
    c AS (WITH {scores_ctes(held_out_sql('val', True))} SELECT 'unit again' AS model, 2 AS position, avg(f1) AS macro_f1 FROM scores)
    SELECT model, position, round(macro_f1, 6) AS macro_f1 FROM (FROM a UNION ALL FROM b UNION ALL FROM c)
    ORDER BY macro_f1 DESC, position LIMIT 1""",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ways to weigh classes and a repeat, which must lose the tie."""
    parts = _parts(spark, sf_dir)
    train, val = parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "val")
    candidates = [("mean", False), ("unit", True), ("unit again", True)]
    records = None
    for position, (name, unit) in enumerate(candidates):
        scorer = classify.centroid_scorer(train, unit=unit)
        record = scoring.evaluate_model(val, scorer).select(
            F.lit(name).alias("model"), F.lit(position).alias("position"), six("macro_f1").alias("macro_f1")
        )
        records = record if records is None else records.unionByName(record)
    return metrics.best_model(records)


# --- encoding and training -----------------------------------------------------------------------


@query("encode_texts", f"SELECT doc_id, 128 AS dimensions, CASE WHEN len({TOKENS_SQL}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents")
def encode_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL knows only what must hold: the dimensions, and unit length unless a text has no word."""
    documents = texts(spark, sf_dir)
    encoder = classify.fit_encoder(documents, dimensions=128)
    encoded = classify.encode_texts(documents, encoder)
    return encoded.select("doc_id", F.size("embedding").alias("dimensions"), six(vx.norm(F.col("embedding"))).alias("norm"))


@query(
    "train_classifier",
    """SELECT doc_id, text[1:100] AS text, true AS known_class,
    CASE WHEN (SELECT count(*) FROM labels) > 0 THEN true END AS sure FROM documents""",
)
def train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the rated documents, applied to all. SQL knows the rows, and what must hold of a prediction."""
    rated = rated_documents(spark, sf_dir)
    predicted = scoring.predict_batch(texts(spark, sf_dir), classify.train_classifier(rated))
    classes = rated.select(F.col("label").alias("fallacy")).distinct().withColumn("known", F.lit(True))
    return predicted.join(F.broadcast(classes), "fallacy", "left").select(
        "doc_id",
        "text",
        F.coalesce("known", F.lit(False)).alias("known_class"),
        # The likeliest of at most four classes.
        F.col("confidence").between(0.25, 1.0).alias("sure"),
    )


# --- grounding and fusion -------------------------------------------------------------------------

# Two explanations per case, as vectors: two other vectors stand in for what a text encoder makes of
# the two texts. Only rated documents are passages, so of the three nearest vectors of a case some,
# or all, are dropped; without any passage both scores are 0, a tie.
_OWN_SQL = """SELECT a.vec_id, list_transform(b.embedding, lambda x: x::DOUBLE) AS first,
list_transform(c.embedding, lambda x: x::DOUBLE) AS second FROM embeddings a
JOIN embeddings b ON b.vec_id = (a.vec_id * 7 + 3) % (SELECT count(*) FROM embeddings)
JOIN embeddings c ON c.vec_id = (a.vec_id * 11 + 5) % (SELECT count(*) FROM embeddings)"""
_HITS3_SQL = f"SELECT query_id, id FROM ({RANKED_SQL}) WHERE rank <= 3 AND id IN (SELECT doc_id FROM labels)"
_GROUNDED_SQL = f"""SELECT c.vec_id, coalesce(avg(list_dot_product(c.first, p.v)), 0.0) AS first_score,
coalesce(avg(list_dot_product(c.second, p.v)), 0.0) AS second_score FROM ({_OWN_SQL}) c
LEFT JOIN ({_HITS3_SQL}) h ON h.query_id = c.vec_id
LEFT JOIN (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) p ON p.vec_id = h.id GROUP BY c.vec_id"""


def _grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _embeddings(spark, sf_dir)
    rows = embeddings.count()

    def other(name: str) -> DataFrame:
        return embeddings.select(F.col("vec_id").alias(f"{name}_id"), F.col("embedding").alias(name))

    cases = (
        embeddings.select(
            "vec_id",
            ((F.col("vec_id") * 7 + 3) % rows).alias("first_id"),
            ((F.col("vec_id") * 11 + 5) % rows).alias("second_id"),
        )
        .join(other("first"), "first_id")
        .join(other("second"), "second_id")
        .select("vec_id", "first", "second")
    )
    rated = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id"))
    passages = embeddings.join(rated, "vec_id", "left_semi")
    found = stage(search.exact_topk(embeddings, embeddings, 3), "hits")
    scores = {"first": "first_score", "second": "second_score"}
    return hits.grounding_score(cases, found, passages, "vec_id", scores, "vec_id")


@query("grounding_score", f"SELECT vec_id, round(first_score, 6) + 0.0 AS first_score, round(second_score, 6) + 0.0 AS second_score FROM ({_GROUNDED_SQL})")
def grounding_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grounded(spark, sf_dir).select(
        "vec_id", six("first_score").alias("first_score"), six("second_score").alias("second_score")
    )


def _fused(spark: SparkSession, sf_dir: str, margin: float | None) -> DataFrame:
    texts = _grounded(spark, sf_dir).select(
        "vec_id",
        F.concat(F.lit("retrieved "), F.col("vec_id").cast("string")).alias("retrieved"),
        F.concat(F.lit("contrast "), F.col("vec_id").cast("string")).alias("contrast"),
        F.round("first_score", 9).alias("first_score"),
        F.round("second_score", 9).alias("second_score"),
    )
    return hits.fusion_select(texts, "retrieved", "contrast", "first_score", "second_score", margin).select(
        "vec_id", "explanation", "source"
    )


_SCORES9_SQL = f"SELECT vec_id, round(first_score, 9) AS a, round(second_score, 9) AS b FROM ({_GROUNDED_SQL})"


@query(
    "fusion_select",
    f"SELECT vec_id, CASE WHEN a >= b THEN 'retrieved ' || vec_id ELSE 'contrast ' || vec_id END AS explanation, "
    f"CASE WHEN a >= b THEN '{fixed.RETRIEVAL_SOURCE}' ELSE '{fixed.CONTRAST_SOURCE}' END AS source FROM ({_SCORES9_SQL})",
)
def fusion_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir, None)


@query(
    "fusion_concat",
    f"""SELECT vec_id, CASE WHEN abs(a - b) < 0.1 THEN 'retrieved ' || vec_id || ' contrast ' || vec_id
    WHEN a >= b THEN 'retrieved ' || vec_id ELSE 'contrast ' || vec_id END AS explanation,
    CASE WHEN abs(a - b) < 0.1 THEN '{fixed.RETRIEVAL_SOURCE}+{fixed.CONTRAST_SOURCE}' WHEN a >= b THEN '{fixed.RETRIEVAL_SOURCE}'
    ELSE '{fixed.CONTRAST_SOURCE}' END AS source FROM ({_SCORES9_SQL})""",
)
def fusion_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir, 0.1)
