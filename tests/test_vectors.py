import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from argulith.functions import vectors as vx
from argulith.operators import classify, hits, metrics, search, tfidf


def vectors(spark, n=400, dims=8, seed=0, hot=False):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dims))
    if hot:  # a third of the vectors are copies of one
        points[: n // 3] = points[0]
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    return points, df


def brute(queries, corpus, k):
    scores = np.round(queries @ corpus.T, search.SCORE_PLACES)
    return {
        (q, int(i), rank + 1)
        for q in range(len(queries))
        for rank, i in enumerate(sorted(range(len(corpus)), key=lambda j: (-scores[q, j], j))[:k])
    }


def found(df):
    return {(r["query_id"], r["id"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("hot", [False, True])
def test_exact_topk_is_brute_force(spark, hot):
    points, df = vectors(spark, hot=hot)
    assert found(search.exact_topk(df, df.repartition(5), 7)) == brute(points, points, 7)


def test_many_query_blocks_give_the_same_hits(spark):
    points, df = vectors(spark, 300)
    blocks = search.exact_topk(df, df.repartition(3), 4, block_bytes=8 * 16 * 60)
    assert found(blocks) == brute(points, points, 4)
    sums = search.query_corpus_product(df, df, above=0.5, block_bytes=8 * 8 * 60)
    product = points @ points.T
    for row in sums.collect():
        mine = product[row["query_id"]]
        assert (row["n"], row["n_above"]) == (300, int((mine > 0.5).sum()))
        assert (row["mean_score"], row["max_score"]) == pytest.approx((mine.mean(), mine.max()))


def test_cells_in_many_blocks_read_only_near_cells(spark, tmp_path):
    points, df = vectors(spark, 400, hot=True)
    centres = search.train_cells(df, 12)
    search.assign_cells(df, centres).write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    whole = search.ivf_topk(df, cells, centres, 4, nprobe=2)
    assert "PartitionFilters: [cell" in plan_of(whole)
    blocks = search.ivf_topk(df, cells, centres, 4, nprobe=2, block_bytes=8 * 16 * 50)
    assert found(blocks) == found(whole)


def test_hits_below_those_of_a_first_share_stay_in_their_task(spark, monkeypatch):
    points, df = vectors(spark, 1_200, hot=True)
    sent = []
    ranked = search.topk_per_query
    monkeypatch.setattr(search, "topk_per_query", lambda hits, *args: sent.append(hits.count()) or ranked(hits, *args))
    assert found(search.exact_topk(df, df.repartition(40), 5, first_share=1 / 8)) == brute(points, points, 5)
    assert found(search.exact_topk(df, df.repartition(40), 5)) == brute(points, points, 5)
    first, bounded, unbounded = sent
    assert unbounded == 1_200 * 40 * 5 and bounded < unbounded / 4
    few = df.limit(3)
    assert found(search.exact_topk(df, few, 5, first_share=1 / 8)) == found(search.exact_topk(df, few, 5))


def test_small_corpus_and_no_queries(spark):
    points, df = vectors(spark, 3)
    assert found(search.exact_topk(df, df, 5)) == brute(points, points, 5)
    assert search.exact_topk(df.limit(0), df, 5).count() == 0
    assert search.exact_topk(df, df.limit(0), 5).count() == 0


def test_dimensions_must_agree(spark):
    _, df = vectors(spark, 10, 8)
    _, other = vectors(spark, 10, 4)
    with pytest.raises(Exception, match="dimensions"):
        search.exact_topk(df, other, 5).count()


RAGGED = [(1, [1.0]), (2, [2.0, 3.0, 4.0])]


def test_vectors_of_different_lengths_are_an_error_everywhere(spark):
    ragged = spark.createDataFrame(RAGGED, "vec_id long, embedding array<double>")
    even = spark.createDataFrame([(1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    scorer = classify.LinearScorer(["a", "b"], np.eye(2))
    for made in (
        lambda: search.exact_topk(even, ragged, 2),
        lambda: search.exact_topk(ragged, even, 2),
        lambda: search.assign_cells(ragged, [[1.0, 0.0]]),
        lambda: classify.score(ragged, scorer),
    ):
        with pytest.raises(Exception, match="dimensions"):
            made().collect()


def test_rows_without_a_vector_stay_without_a_result(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    scored = classify.score(df, classify.LinearScorer(["a", "b"], np.eye(2))).orderBy("vec_id").collect()
    assert [r["pred"] for r in scored] == ["a", None, "b"]
    assert scored[1]["confidence"] is None and scored[1]["probabilities"] is None
    cells = search.assign_cells(df, [[1.0, 0.0], [0.0, 1.0]]).orderBy("vec_id").collect()
    assert [r["cell"] for r in cells] == [0, None, 1]
    assert found(search.exact_topk(df, df, 1)) == {(1, 1, 1), (3, 3, 1)}


def test_a_query_key_too_frequent_for_a_block_is_an_error(spark):
    _, df = vectors(spark, 30)
    same = df.withColumn("vec_id", F.lit(5).cast("long"))
    with pytest.raises(ValueError, match="query key"):
        search.exact_topk(same, df, 2, block_bytes=8 * 12 * 10)
    some = df.withColumn("vec_id", F.col("vec_id") % 6)
    assert search.exact_topk(some, df, 1, block_bytes=8 * 12 * 10).count() == 6


def test_blocks_leave_no_broadcast_behind(spark, monkeypatch):
    _, df = vectors(spark, 60)
    sent = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(broadcast(self, value)) or sent[-1])
    search.exact_topk(df, df, 2, block_bytes=8 * 12 * 10).collect()
    assert len(sent) >= 6 and all(b._jbroadcast is None or not b._jbroadcast.isValid() for b in sent)


def test_no_train_rows_means_no_likeness(spark):
    rows = spark.createDataFrame([(1, "red fish"), (2, "blue fish"), (3, "red fish")], "doc_id long, text string")
    model = tfidf.fit_tfidf(rows)
    none = rows.limit(0)
    assert {(r["doc_id"], r["max_similarity"]) for r in tfidf.max_similarity(rows, none, model).collect()} == {(1, 0.0), (2, 0.0), (3, 0.0)}
    assert [r["n"] for r in tfidf.split_product(rows, none, model).collect()] == [0, 0, 0]
    counted = tfidf.near_duplicate_count(tfidf.distinct_similarity(rows, none, model)).first()
    assert (counted["near_duplicates"], counted["compared"]) == (0, 3)


def test_search_neither_shuffles_passages_nor_pairs_rows(spark):
    _, df = vectors(spark, 50)
    plan = plan_of(search.exact_topk(df, df, 5))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.index("MapInArrow") > plan.index("Exchange")  # the exchange is above the search


def test_all_cells_probed_is_exact_and_fewer_cells_lose_little(spark):
    points, df = vectors(spark, 500, hot=True)
    centres = search.train_cells(df, 10)
    cells = search.assign_cells(df, centres)
    exact = search.exact_topk(df, df, 10)
    full = search.ivf_topk(df, cells, centres, 10, nprobe=10)
    assert found(full) == found(exact)
    recalls = [
        search.recall_at_k(search.ivf_topk(df, cells, centres, 10, nprobe=n), exact).first()["recall"] for n in (1, 4, 10)
    ]
    assert recalls == sorted(recalls) and recalls[0] < 1 and recalls[-1] == 1.0


def test_cells_probed_follow_the_recall_wanted(spark, tmp_path):
    points, df = vectors(spark, 600, hot=True)
    centres = search.sampled_cells(df, search.cells_for(600))
    assert len(centres) == 98 and np.allclose(np.linalg.norm(centres, axis=1), 1)
    search.assign_cells(df, centres).write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    exact = search.exact_topk(df, df, 5)
    wanted = {}
    for recall in (0.5, 0.9, 1.0):  # all rows are asked, so the recall is exact
        wanted[recall] = search.nprobe_for(df, cells, centres, 5, recall, sample=600)
        got, before = (
            search.recall_at_k(search.ivf_topk(df, cells, centres, 5, n), exact).first()["recall"] for n in (wanted[recall], max(1, wanted[recall] - 1))
        )
        assert got >= recall and (before < recall or wanted[recall] == 1)
    assert wanted[0.5] < wanted[0.9] < wanted[1.0]
    cell = dict(tuple(r) for r in cells.select("vec_id", "cell").collect())
    order = np.argsort(-np.round(points @ np.array(centres).T, 12), axis=1, kind="stable")[:, : wanted[0.9]]
    met = sum((np.array(list(cell.values()))[:, None] == row).sum() for row in order)
    assert search.share_read(df, cells, centres, wanted[0.9]).first()["share_read"] == pytest.approx(met / 600**2)


def test_cells_of_tiny_and_empty_tables(spark):
    _, df = vectors(spark, 3)
    centres = search.sampled_cells(df, search.cells_for(3))
    cells = search.assign_cells(df, centres)
    assert len(centres) == 3 and search.nprobe_for(df, cells, centres, 5) <= 3
    assert search.nprobe_for(df.limit(0), cells, centres, 5) == 1
    rows = spark.createDataFrame([(1, None), (2, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert search.sampled_cells(rows, 2) == [[1.0, 0.0], [1.0, 0.0]]


def test_vector_columns(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    unit, zero = [r[0] for r in df.select(vx.l2_normalize(F.col("v"))).collect()]
    assert unit == pytest.approx([0.6, 0.8]) and zero == [0.0, 0.0]
    row = spark.createDataFrame([([1000.0, 1000.0, 999.0],)], "v array<double>").select(
        vx.softmax(F.col("v")), vx.argmax(F.col("v"))
    ).first()
    assert sum(row[0]) == pytest.approx(1.0) and row[0][0] == row[0][1] and row[1] == 0


TEXTS = [
    "the cat sat on the mat with a hat", "the cat sat on the mat with the hat", "a dog ran in the park by the lake",
    "the dog ran in a park by the lake today", "", "x", "cats and dogs are animals", "the cat sat on the mat with a hat",
]


def python_tfidf(texts, most):
    tokens = [re.findall(r"(?u)\b\w\w+\b", t.lower()) for t in texts]
    total = Counter(t for doc in tokens for t in doc)
    vocab = sorted(sorted(total, key=lambda t: (-total[t], t))[:most])
    df = Counter(t for doc in tokens for t in set(doc))
    weight = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in vocab}
    rows = np.array([[doc.count(t) * weight[t] for t in vocab] for doc in tokens])
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return vocab, rows / np.where(lengths > 0, lengths, 1)


@pytest.mark.parametrize("most", [1000, 6])
def test_tfidf_by_hand(spark, most):
    vocab, rows = python_tfidf(TEXTS, most)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    model = tfidf.fit_tfidf(df, max_features=most)
    assert model.terms == vocab
    got = {(r["doc_id"], r["term"]): r["weight"] for r in model.long(df, "doc_id").collect()}
    want = {(d, t): rows[d][i] for d in range(len(TEXTS)) for i, t in enumerate(vocab) if rows[d][i] > 0}
    assert got == pytest.approx(want)


def test_similarity_of_splits(spark):
    _, rows = python_tfidf(TEXTS, 1000)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    model = tfidf.fit_tfidf(df)
    test, train = df.filter("doc_id >= 5"), df.filter("doc_id < 5")
    got = {r["doc_id"]: r["max_similarity"] for r in tfidf.max_similarity(test, train, model).collect()}
    want = {d: (rows[d] @ rows[:5].T).max() for d in (5, 6, 7)}
    assert got == pytest.approx(want)
    counted = tfidf.near_duplicate_count(tfidf.max_similarity(test, train, model)).first()
    assert (counted["near_duplicates"], counted["compared"]) == (1, 3)
    copied = test.unionByName(spark.createDataFrame([(i, TEXTS[7]) for i in range(100, 140)], "doc_id long, text string"))
    weighed = tfidf.near_duplicate_count(tfidf.distinct_similarity(copied, train, model)).first()
    assert (weighed["near_duplicates"], weighed["compared"]) == (41, 43)
    assert tfidf.max_similarity(copied, train, model).count() == 43


PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [("b", "d")] * 2


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(PAIRS, "label string, pred string")
    classes = sorted({x for p in PAIRS for x in p})
    f1, support, scores = {}, Counter(t for t, _ in PAIRS), {}
    for c in classes:
        tp = sum(t == p == c for t, p in PAIRS)
        predicted = sum(p == c for _, p in PAIRS)
        precision = tp / predicted if predicted else 0.0
        recall = tp / support[c] if support[c] else 0.0
        f1[c] = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        scores[c] = (precision, recall, f1[c], support[c])
    n = len(PAIRS)
    accuracy = sum(t == p for t, p in PAIRS) / n
    confusion = metrics.confusion_matrix(df)
    record = metrics.metrics_record(confusion).first()
    assert record["accuracy"] == pytest.approx(accuracy) == metrics.accuracy(df).first()[0]
    assert record["macro_f1"] == pytest.approx(sum(f1.values()) / 4)
    assert record["weighted_f1"] == pytest.approx(sum(f1[c] * support[c] for c in classes) / n)
    report = {r["label"]: tuple(r)[1:] for r in metrics.classification_report(confusion).collect()}
    for c in classes:
        assert report[c] == pytest.approx(scores[c])
    assert report["accuracy"][3] == report["macro avg"][3] == n
    assert report["weighted avg"][1] == pytest.approx(accuracy)  # weighted recall is the accuracy


def test_best_model_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.7), ("c", 2, 0.7)], "model string, position int, macro_f1 double")
    assert tuple(metrics.best_model(df).first()) == ("b", 1, 0.7)


def test_scores_and_top_labels(spark):
    points, df = vectors(spark, 60, 4)
    labelled = df.withColumn("label", F.concat(F.lit("l"), (F.col("vec_id") % 3).cast("string")))
    scorer = classify.centroid_scorer(labelled)
    centroids = np.array([points[c::3].mean(axis=0) for c in range(3)])
    assert scorer.labels == ["l0", "l1", "l2"] and np.allclose(scorer.weights, centroids)
    logits = points @ centroids.T
    powers = np.exp(logits)
    probabilities = powers / powers.sum(axis=1, keepdims=True)
    for row in classify.score(labelled, scorer).withColumn(
        "best", classify.topn_labels(F.col("probabilities"), scorer.labels, 2)
    ).collect():
        mine = probabilities[row["vec_id"]]
        assert row["probabilities"] == pytest.approx(mine) and row["confidence"] == pytest.approx(mine.max())
        order = [f"l{c}" for c in np.argsort(-mine)]
        assert row["pred"] == order[0] and [b["label"] for b in row["best"]] == order[:2]


def test_text_classifier_learns_and_favours_no_large_class(spark):
    rows = [(i, "red apple fruit sweet" if i % 10 else "blue ocean water deep", "fruit" if i % 10 else "sea") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    fitted = classify.train_classifier(df, dimensions=64)
    assert fitted.labels == ["fruit", "sea"]
    scored = fitted.transform(df)
    assert scored.filter("pred = label").count() == 200
    assert scored.filter("abs(aggregate(probabilities, 0D, (a, p) -> a + p) - 1) > 1e-9").count() == 0


def test_encoders(spark):
    df = spark.createDataFrame([(0, "some words here"), (1, "other words there"), (2, "")], "doc_id long, text string")
    encoder = classify.fit_encoder(df, dimensions=32)
    norms = [r[0] for r in classify.encode_texts(df, encoder).orderBy("doc_id").select(vx.norm(F.col("embedding"))).collect()]
    assert norms == pytest.approx([1.0, 1.0, 0.0])

    def load():
        return lambda texts: [[len(t), 1.0] for t in texts]

    vectors_of = [r[0] for r in df.orderBy("doc_id").select(classify.encode_texts_with(load, 2, 2)("text")).collect()]
    assert vectors_of[0] == pytest.approx([15 / math.hypot(15, 1), 1 / math.hypot(15, 1)])
    with pytest.raises(Exception, match="dimensions"):
        df.select(classify.encode_texts_with(load, 3)("text")).collect()


def test_grounding_and_fusion(spark):
    cases = spark.createDataFrame([(0, [1.0, 0.0], [0.0, 1.0]), (1, [0.0, 1.0], [1.0, 0.0]), (2, [1.0, 0.0], [0.0, 1.0])], "case long, a array<double>, b array<double>")
    passages = spark.createDataFrame([(10, [1.0, 0.0]), (11, [0.8, 0.6])], "id long, embedding array<double>")
    matched = spark.createDataFrame([(0, 10), (0, 11), (1, 10), (1, 99)], "query_id long, id long")
    scored = hits.grounding_score(cases, matched, passages, "case", {"a": "sa", "b": "sb"})
    got = {r["case"]: (r["sa"], r["sb"]) for r in scored.collect()}
    assert got[0] == pytest.approx((0.9, 0.3)) and got[1] == pytest.approx((0.0, 1.0)) and got[2] == (0.0, 0.0)
    texts = scored.withColumn("ta", F.lit("first")).withColumn("tb", F.lit("second"))
    chosen = {r["case"]: (r["explanation"], r["source"]) for r in hits.fusion_select(texts, "ta", "tb", "sa", "sb").collect()}
    assert chosen == {0: ("first", "RAG"), 1: ("second", "CPACE"), 2: ("first", "RAG")}
    joined = {r["case"]: r["explanation"] for r in hits.fusion_select(texts, "ta", "tb", "sa", "sb", 0.1).collect()}
    assert joined == {0: "first", 1: "second", 2: "first second"}


def test_enrichment_keeps_rows_without_facts(spark):
    df = spark.createDataFrame([(0, ["senator", "senator", "x"]), (1, [])], "i long, names array<string>")
    edges = spark.createDataFrame([("senator", "IsA", "politician"), ("senator", "IsA", "politician"), ("senator", "AtLocation", "senate")], "concept string, relation string, target string")
    got = {r["i"]: r["facts"] for r in hits.concept_enrichment(df, edges, "i", "names").collect()}
    assert got == {0: ["senator AtLocation senate", "senator IsA politician"], 1: []}


def test_predictions_with_a_stored_index(spark, tmp_path):
    from argulith.plans import corpus, scoring

    words = ["river boat water", "engine road wheel", "river fish water", "road car wheel", "sky bird wing"]
    passages = spark.createDataFrame([(i, w, w) for i, w in enumerate(words)], "id long, text string, text_normalized string")
    index = corpus.corpus_to_index(passages, str(tmp_path / "index"), n_cells=2, dimensions=64)
    rows = [(i, words[i % 4] + " today", "wet" if i % 2 == 0 else "dry") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    fitted = classify.train_classifier(df, dimensions=64)
    for nprobe in (None, 1):
        got = scoring.predict_with_index(df, fitted, index, 2, nprobe).collect()
        assert len(got) == 40
        assert all((r["fallacy"] == "wet") == (r["doc_id"] % 2 == 0) for r in got)
        assert all(r["similar_examples"][0]["text"] == words[r["doc_id"] % 4] for r in got)
        assert all(len(r["similar_examples"]) <= 2 for r in got)


def test_the_chosen_classifier_is_the_best_on_validation(spark):
    rows = [(i, f"{'sun' if i % 3 else 'rain'} word{i % 7}", "a" if i % 3 else "b", ("train", "train", "val", "test")[i % 4]) for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, split string")
    chosen, candidates, report = classify.choose_classifier(df, (0.01, 100.0), dimensions=64)
    scores = {r["position"]: r["macro_f1"] for r in candidates.collect()}
    assert scores[0] == 1.0 and scores[1] <= scores[0]
    assert report.first()["accuracy"] == 1.0
    assert chosen.transform(df).filter("pred <> label").count() == 0


def test_related_concepts_walk_breadth_first_and_end_in_circles(spark):
    edges = [("a", "IsA", "b"), ("b", "PartOf", "c"), ("c", "PartOf", "a"), ("c", "IsA", "d"), ("a", "PartOf", "c"), ("d", "IsA", None), ("x", "IsA", "x")]
    graph = spark.createDataFrame(edges, "concept string, relation string, target string")
    starts = spark.createDataFrame([("a",), ("x",), ("lost",), ("a",)], "concept string")
    for depth, want in (
        (0, {("a", "a", 0), ("x", "x", 0), ("lost", "lost", 0)}),
        (1, {("a", "a", 0), ("a", "b", 1), ("a", "c", 1), ("x", "x", 0), ("lost", "lost", 0)}),
        (9, {("a", "a", 0), ("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("x", "x", 0), ("lost", "lost", 0)}),
    ):
        rows = hits.related_concepts(graph, starts, depth).collect()
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    df = spark.createDataFrame([(1, ["x", "b"]), (2, []), (3, None)], "i int, names array<string>")
    facts = {r["i"]: r["facts"] for r in hits.concept_enrichment(df, graph, "i", "names", 2).collect()}
    assert facts == {1: ["b PartOf c", "c IsA d", "c PartOf a", "x IsA x"], 2: [], 3: []}


def _sparse_rows(count, seed, width=400):
    draw = np.random.default_rng(seed)
    rows = np.where(draw.random((count, width)) < 0.05, draw.normal(size=(count, width)), 0.0)
    rows[count // 2] = 0.0
    rows[-20:] = rows[:20]  # equal scores, which keys decide
    return rows


def _sparse_frame(spark, rows, first=0):
    made = [(first + n, (len(row), np.flatnonzero(row).tolist(), row[np.flatnonzero(row)].tolist())) for n, row in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, vector struct<size: int, indices: array<int>, values: array<double>>")


@pytest.mark.parametrize("block_bytes", [64 << 20, 100 * 1_700])
def test_sparse_vectors_are_searched_exactly(spark, block_bytes):
    """Lengths differ, components are negative, rows are equal or zero: the sketches must lose nothing."""
    asked, held = _sparse_rows(230, 1), _sparse_rows(900, 2)
    held[40:44] = asked[:4] * 3
    sides = _sparse_frame(spark, asked).repartition(2), _sparse_frame(spark, held, 1_000).repartition(2)
    product = np.round(asked @ held.T, 12)
    got = search.exact_topk(*sides, 3, "doc_id", "doc_id", "vector", block_bytes)
    found = {(r["query_id"], r["rank"]): (r["id"], round(r["score"], 9)) for r in got.collect()}
    for n, row in enumerate(product):
        best = np.lexsort((np.arange(len(row)), -row))[:3]
        assert [found[n, r] for r in (1, 2, 3)] == [(1_000 + b, round(row[b], 9)) for b in best]
    sums = search.query_corpus_product(*sides, "doc_id", "doc_id", "vector", 2.0, block_bytes).collect()
    for r in sums:
        row = product[r["query_id"]]
        assert (r["n"], r["n_above"]) == (900, (row > 2.0).sum())
        assert [r["mean_score"], r["max_score"]] == pytest.approx([row.mean(), row.max()], abs=1e-9)
    assert len(sums) == 230


def test_few_pairs_of_sparse_vectors_are_multiplied(monkeypatch):
    import pyarrow as pa

    from argulith.operators.sketches import Sparse, columns

    asked, held = np.abs(_sparse_rows(100, 1)), np.abs(_sparse_rows(4_000, 2))
    held[:100] = asked
    lists = [
        pa.array([{"size": 400, "indices": np.flatnonzero(r), "values": r[np.flatnonzero(r)]} for r in rows / np.maximum(np.linalg.norm(rows, axis=1), 1e-9)[:, None]],
                 pa.struct([("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))
        for rows in (asked, held)
    ]
    pairs = []
    products = Sparse.products
    monkeypatch.setattr(Sparse, "products", lambda self, rows, *more: pairs.append(len(rows)) or products(self, rows, *more))
    queries = Sparse(lists[0])
    block = search._SparseBlock(np.arange(100), queries, columns(400, np.bincount(queries.index, queries.value**2, 400)), 1)
    block.add(np.arange(4_000), lists[1])
    assert sum(pairs) < 100 * 4_000 / 50
    assert (np.round(block.scores[:50, 0], 9) == 1).all()


def test_cells_that_are_probed_travel_as_bits_in_bounded_pieces(spark, monkeypatch):
    """A query of 600 cells, 270 of them probed, brings 75 bytes, and few rows of scores stand at a time."""
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(50, 8))
    centres = draw.normal(size=(600, 8))
    df = spark.createDataFrame([(n, [float(x) for x in r]) for n, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = search.probed_cells(df, centres.tolist(), 270).collect()
    for r in got:
        order = np.argsort(-np.round(rows[r["vec_id"]] @ centres.T, 12), kind="stable")
        bits = np.unpackbits(np.frombuffer(bytes(r["cells"]), dtype=np.uint8))
        assert len(r["cells"]) == 75 and r["near"] == order[0]
        assert set(np.flatnonzero(bits)) == set(order[:270])
    import pyarrow as pa

    sizes, product = [], search.matrix_of
    monkeypatch.setattr(search, "matrix_of", lambda v, w=None: sizes.append(len(v)) or product(v, w))
    search._nearest(pa.array([r.tolist() for r in np.tile(rows, (200, 1))]), centres, 5)
    assert max(sizes) * 600 <= 1 << 21 and sum(sizes) == 10_000


def _sparse_array(rows):
    import pyarrow as pa

    kind = pa.struct([("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    return pa.array([{"size": rows.shape[1], "indices": np.flatnonzero(r), "values": r[np.flatnonzero(r)]} for r in rows], kind)


def _multiplied(monkeypatch, queries):
    """Pairs that are multiplied by components or, for queries with their zeros, at once."""
    from argulith.operators.sketches import Sparse

    pairs, products, dense = [], Sparse.products, Sparse.dense
    monkeypatch.setattr(Sparse, "products", lambda self, rows, *more: pairs.append(len(rows)) or products(self, rows, *more))
    monkeypatch.setattr(Sparse, "dense", lambda self, rows, width: pairs.append(256 * len(rows) * (self is queries)) or dense(self, rows, width))
    return pairs


@pytest.mark.parametrize("kind", ["best", "totals"])
def test_passages_of_many_components_are_bounded_as_closely(monkeypatch, kind):
    from argulith.operators.sketches import Sparse, columns

    seed = np.random.default_rng(5)
    held = seed.random((3_000, 1_000)) * (seed.random((3_000, 1_000)) < 0.5)
    asked = seed.random((60, 1_000)) * (seed.random((60, 1_000)) < 0.08)
    held[::50] = 0.0
    held[::50] = asked + 0.05 * held[1::50]  # one passage near every query
    held, asked = (rows / np.linalg.norm(rows, axis=1)[:, None] for rows in (held, asked))
    queries = Sparse(_sparse_array(asked))
    column = columns(1_000, np.bincount(queries.index, queries.value**2, 1_000))
    block = search._SparseBlock(np.arange(60), queries, column, 2) if kind == "best" else search._SparseTotals(np.arange(60), queries, column, 0.2)
    pairs = _multiplied(monkeypatch, queries)
    block.add(np.arange(3_000), _sparse_array(held))
    assert sum(pairs) < 60 * 3_000 / 20
    product = asked @ held.T
    if kind == "best":
        order = np.lexsort((np.broadcast_to(np.arange(3_000), product.shape), -np.round(product, 12)), axis=1)[:, :2]
        assert (block.hits == order).all()
    else:
        assert (block.batch()["n_above"].to_numpy() == (product > 0.2).sum(axis=1)).all()
        assert block.largest == pytest.approx(product.max(axis=1), abs=1e-12)


def test_queries_without_components_are_not_multiplied(monkeypatch):
    from argulith.operators.sketches import Sparse, columns

    held = _sparse_array(np.abs(_sparse_rows(3_000, 2)))
    queries = Sparse(_sparse_array(np.zeros((40, 400))))
    column = columns(400, np.zeros(400))
    best, sums = search._SparseBlock(np.arange(40), queries, column, 2), search._SparseTotals(np.arange(40), queries, column, -1.0)
    pairs = _multiplied(monkeypatch, queries)
    for at, keys in ((0, np.arange(3_000)[::-1] + 10), (0, np.arange(3_000) + 3_000)):
        best.add(keys, held)
        sums.add(keys, held)
    assert sum(pairs) == 0
    assert (best.scores == 0).all() and (best.hits == [10, 11]).all()
    assert [c.tolist() for c in (sums.count, sums.largest, sums.over)] == [[6_000] * 40, [0.0] * 40, [6_000] * 40]


def test_classes_of_encoded_texts_need_no_second_encoding(spark, monkeypatch):
    rows = [(1, "red red green", "b"), (2, "green blue", "a"), (2, "green blue", "a"), (3, "blue", "b"), (4, "", "a"), (5, "red", "b")]
    texts = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = tfidf.fit_tfidf(texts)
    plain, encoded = tfidf.term_scorer(texts, model), model.encode(texts)
    monkeypatch.setattr(tfidf.TfIdf, "transform", None)
    known = tfidf.term_scorer(encoded, model, vector_col="embedding")
    assert known.labels == plain.labels == ["a", "b"]
    assert known.weights == pytest.approx(plain.weights, abs=1e-14)
