import os

import pytest
from pyspark.sql import functions as F

from argulith.functions.udfs import map_texts, map_with_setup
from argulith.operators import classify, search
from argulith.plans import corpus, leakage, prepare, scoring
from argulith.session import drop_scratch, scratch_path, scratch_root, stage
from argulith.sources import readers, stores, writers
from argulith.streaming.score import stream_score, text_stream

TRICKY = ['plain', 'comma, "quoted" and \'single\'', 'two\nlines\r\nand\ttab', ' edges kept ', 'back\\slash "\\', 'ünïcödé 😀', None]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(i, t, "ad hominem" if i % 2 else None) for i, t in enumerate(TRICKY)]
    writers.sink_csv(spark.createDataFrame(rows, "key long, body string, tag string"), path)
    back = readers.scan_keyed_csv(spark, path, "key", "body", "tag").orderBy("doc_id").collect()
    assert [tuple(r) for r in back] == [(i, t or "", tag) for i, t, tag in rows]
    assert readers.scan_csv(spark, path, "body", "tag").columns == ["text", "raw_label"]


def test_csv_takes_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('other,source_article,logical_fallacies\n1,"a ""b""\nc",ad hominem\n2,,\n')
    got = readers.scan_csv(spark, str(tmp_path / "a.csv"), "source_article", "logical_fallacies").collect()
    assert [tuple(r) for r in got] == [('a "b"\nc', "ad hominem"), ("", None)]


def test_taxonomy_with_cells_over_several_lines(spark, tmp_path):
    header = "Original Name,Understandable Name,Description,Logical Form,Source for Logical Form ,Masked Logical Form"
    (tmp_path / "t.csv").write_text(f'{header}\ndoubt,doubt, leading blank,"A occurred.\nTherefore, B.\n ",https://example.org,"<MSK1> occurred.\n"\nmisc,misc,misc,misc,,misc\n')
    rows = readers.scan_taxonomy(spark, str(tmp_path / "t.csv")).collect()
    assert tuple(rows[0]) == ("doubt", "doubt", "leading blank", "A occurred.\nTherefore, B.", "https://example.org", "<MSK1> occurred.")
    assert rows[1]["logical_form_source"] is None


def test_jsonl_round_trip_and_blank_lines(spark, tmp_path):
    path = str(tmp_path / "jsonl")
    rows = [(i, t, "n", None, "assistant") for i, t in enumerate(TRICKY)]
    writers.sink_jsonl(spark.createDataFrame(rows, readers.PASSAGE_SCHEMA).coalesce(1), path)
    part = next(p for p in os.listdir(path) if p.endswith(".json"))
    written = open(os.path.join(path, part), encoding="utf-8").read()
    assert "ünïcödé 😀" in written and '"question":null' in written
    assert [tuple(r) for r in readers.scan_jsonl(spark, path).orderBy("id").collect()] == rows
    (tmp_path / "blank.jsonl").write_text('{"id": 1, "text": "a"}\n\n   \n{"id": 2, "text": "b"}\n')
    assert readers.scan_jsonl(spark, str(tmp_path / "blank.jsonl")).count() == 2


def test_explanations_sink(spark, tmp_path):
    df = spark.createDataFrame([("t", "ad_hominem", 0.5, "because\n\nexample", 1)], "text string, predicted_fallacy string, confidence double, explanation string, extra int")
    writers.sink_explanations(df, str(tmp_path / "e"))
    assert tuple(spark.read.json(str(tmp_path / "e")).select("text", "predicted_fallacy", "confidence", "explanation").first()) == ("t", "ad_hominem", 0.5, "because\n\nexample")


def test_resolve_source(spark, tmp_path):
    there = tmp_path / "there.csv"
    there.write_text("a\n1\n")
    missing = str(tmp_path / "missing.csv")
    assert readers.resolve_source(spark, [missing, str(there)]) == str(there)
    assert readers.resolve_sources(spark, {"a": missing, "b": str(there)}) == {"b": str(there)}
    with pytest.raises(FileNotFoundError):
        readers.resolve_source(spark, [missing])
    with pytest.raises(FileNotFoundError):
        readers.resolve_sources(spark, {"a": missing})


def test_label_map_is_saved_or_rebuilt(spark, tmp_path):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    path = str(tmp_path / "map")
    rebuilt = stores.load_label_map(spark, path, train)
    stores.save_label_map(rebuilt, path)
    assert {tuple(r) for r in stores.load_label_map(spark, path).collect()} == {("a", 0), ("b", 1)}
    assert stores.inverse_label_map(rebuilt).columns == ["label_id", "label"]
    with pytest.raises(FileNotFoundError):
        stores.load_label_map(spark, str(tmp_path / "none"))


def test_index_and_model_are_saved(spark, tmp_path):
    rows = [(i, [float(i % 4 == d) for d in range(4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    centres = [[float(c == d) for d in range(4)] for c in range(4)]
    stores.save_index(search.assign_cells(df, centres), str(tmp_path / "index"))
    stores.save_centres(spark, centres, str(tmp_path / "centres"))
    index = stores.load_index(spark, str(tmp_path / "index"))
    assert {r["vec_id"]: r["cell"] for r in index.collect()} == {i: i % 4 for i in range(40)}
    assert stores.load_centres(spark, str(tmp_path / "centres")) == centres
    assert "PartitionFilters: [isnotnull(cell" in index.filter("cell = 2")._jdf.queryExecution().executedPlan().toString()

    texts = spark.createDataFrame([(0, "good thing", "p"), (1, "bad thing", "n")] * 10, "doc_id long, text string, label string")
    fitted = classify.train_classifier(texts, dimensions=32)
    stores.save_model(spark, fitted, str(tmp_path / "model"))
    again = stores.load_model(spark, str(tmp_path / "model"))
    assert again.labels == fitted.labels
    assert [r["pred"] for r in again.transform(texts).collect()] == [r["pred"] for r in fitted.transform(texts).collect()]


def test_scratch_folder_follows_the_session(spark):
    root = scratch_root(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert root == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert stage(spark.range(5), "five").count() == 5
    drop_scratch(spark)
    assert not readers.exists(spark, f"{root}/{spark.sparkContext.applicationId}")
    assert readers.exists(spark, root)


def test_user_functions_keep_keys(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "i long, text string").repartition(4)
    upper = {r["i"]: r["result"] for r in map_texts(df, str.upper).collect()}
    assert upper == {i: t and t.upper() for i, t in enumerate(TRICKY)}

    def setup():
        calls = []

        def number(text):
            calls.append(text)
            return len(calls)

        return number

    assert all(r["result"] >= 1 for r in map_with_setup(df.dropna(), setup, returns="long").collect())


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    points = [(i, [float((i * 7) % 5), float(i % 3)]) for i in range(90)]
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    scorer = classify.LinearScorer(["x", "y"], __import__("numpy").eye(2))
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.repartition(6).write.parquet(folder)

    def plan(rows):
        return scoring.predict(rows, scorer).select("vec_id", "pred", "confidence")

    for _ in range(2):  # the second run finds nothing new
        requests = text_stream(spark, folder, df.schema, files_per_batch=2)
        query = stream_score(requests, plan, out, str(tmp_path / "checkpoint"))
        query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    streamed, batch = spark.read.parquet(out), plan(df)
    assert streamed.count() == 90
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0


def test_prepare_dataset(spark):
    long = "word " * 20
    one = spark.createDataFrame([(0, long + "<b>a</b> on 2024-03-15", "ad hominem"), (1, long + "<b>a</b> on 2024-03-15", "straw man"), (2, "short", "straw man"), (3, None, "straw man")], "doc_id long, text string, raw_label string")
    two = spark.createDataFrame([(4, long + "Z", "miscellaneous"), (5, long + "é", "fallacy of extension"), (6, long + "Ｚ", None)], "doc_id long, text string, raw_label string")
    got = {r["doc_id"]: (r["text"], r["label"], r["label_id"], r["split"]) for r in prepare.prepare_dataset([one, two]).collect()}
    words = long.strip()
    assert got == {0: (f"{words} a on [DATE]", "ad_hominem", 0, "train"), 5: (f"{words} é", "straw_man", 1, "train")}


def test_sources_without_keys(spark, tmp_path):
    long = "some words that are longer than fifty characters in all of them "
    (tmp_path / "one.csv").write_text(f'id,source_article,logical_fallacies\n9,"{long}A\nB",ad hominem\n8,{long}C,false cause\n')
    (tmp_path / "two.csv").write_text(f'updated_label,masked_articles\nstraw man,{long}C\nequivocation,{long}D\n')
    raw = prepare.load_sources(spark, [
        (str(tmp_path / "none.csv"), "x", "y"),
        (str(tmp_path / "one.csv"), "source_article", "logical_fallacies"),
        (str(tmp_path / "two.csv"), "masked_articles", "updated_label"),
    ])
    rows = raw.orderBy("doc_id").collect()
    assert [r["raw_label"] for r in rows] == ["ad hominem", "false cause", "straw man", "equivocation"]
    got = {r["text"]: r["label"] for r in prepare.prepare_dataset([raw]).collect()}
    assert got == {f"{long}a b": "ad_hominem", f"{long}c": "false_cause", f"{long}d": "equivocation"}


def test_dataset_is_saved_by_split(spark, tmp_path):
    rows = [(i, f'text "{i}"\nline, two', f"c{i % 2}", i % 2, ["train", "val", "test"][i % 3]) for i in range(30)]
    dataset = spark.createDataFrame(rows, "doc_id long, text string, label string, label_id int, split string")
    prepare.save_dataset(dataset, str(tmp_path))
    for split in ("train", "val", "test"):
        got = {tuple(r) for r in prepare.load_split(spark, str(tmp_path), split).collect()}
        assert got == {r[:4] for r in rows if r[4] == split}
    saved = stores.load_label_map(spark, str(tmp_path / "label_map"))
    assert {tuple(r) for r in saved.collect()} == {("c0", 0), ("c1", 1)}


def test_texts_are_scored_as_they_arrive(spark, tmp_path):
    train = spark.createDataFrame([(i, "red apple" if i % 2 else "blue sea", "fruit" if i % 2 else "water") for i in range(40)], "doc_id long, text string, label string")
    fitted = classify.train_classifier(train, dimensions=32)
    folder, out = tmp_path / "requests", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.json").write_text('{"doc_id": 1, "text": "an apple"}\n{"doc_id": 2, "text": "the sea"}\n')
    (folder / "b.json").write_text('{"doc_id": 3, "text": "%s"}\n' % ("apple " * 40))
    requests = text_stream(spark, str(folder), "doc_id long, text string", 1, file_format="json")
    stream_score(requests, lambda df: scoring.predict_batch(df, fitted), out, str(tmp_path / "checkpoint")).awaitTermination()
    got = {r["doc_id"]: r for r in spark.read.parquet(out).collect()}
    assert {i: r["fallacy"] for i, r in got.items()} == {1: "fruit", 2: "water", 3: "fruit"}
    assert len(got[3]["text"]) == 100 and got[3]["confidence"] > 0.5


def test_prediction_without_similar_passages(spark):
    import numpy as np

    scorer = classify.LinearScorer(["x", "y"], np.eye(2))
    df = spark.createDataFrame([(1, "t", [1.0, 0.0])], "doc_id long, text string, embedding array<double>")
    corpus_rows = df.select(F.col("doc_id").alias("id"), "text", "embedding")
    one = scoring.predict_with_retrieval(df, scorer, corpus_rows).first()
    assert (one["fallacy"], one["similar_examples"][0]["text"], one["similar_examples"][0]["score"]) == ("x", "t", 1.0)
    none = scoring.predict_with_retrieval(df, scorer, corpus_rows.limit(0)).first()
    assert none["similar_examples"] == []


def test_build_corpus(spark):
    rows = [(1, "x" * 50, "q", "con"), (2, "X" * 700, "q" * 300, None), (3, None, None, "pro"), (4, "<i>" + "y" * 60, None, "pro")]
    got = {r["id"]: r for r in corpus.build_corpus(spark.createDataFrame(rows, "id long, argument string, question string, type string")).collect()}
    assert set(got) == {2, 4}
    assert (got[2]["text"], got[2]["text_normalized"], got[2]["question"], got[2]["type"]) == ("X" * 500, "x" * 700, "q" * 200, "")
    assert (got[4]["text_normalized"], got[4]["question"]) == ("y" * 60, "")


def test_a_passage_finds_itself_in_a_reopened_index(spark, tmp_path):
    words = ["tax", "school", "river", "music", "health", "road", "bread", "space"]
    rows = [(i, " ".join([words[i % 8]] * 3 + [words[(i // 8) % 8], f"number{i}"]), "", "", "") for i in range(64)]
    passages = spark.createDataFrame([(i, t, t, q, k) for i, t, q, k, _ in rows], readers.PASSAGE_SCHEMA)
    corpus.corpus_to_index(passages, str(tmp_path / "index"), n_cells=8, dimensions=512)
    index = corpus.open_index(spark, str(tmp_path / "index"))
    queries = passages.select("id", "text")
    exact = {(r["query_id"], r["rank"]): (r["id"], r["text"]) for r in corpus.search_index(index, queries, 3).collect()}
    assert len(exact) == 64 * 3
    assert sum(exact[i, 1] == (i, rows[i][1]) for i in range(64)) >= 60  # the prefix word may tip a few
    probed = corpus.search_index(index, queries, 3, nprobe=8)
    assert {(r["query_id"], r["rank"]): (r["id"], r["text"]) for r in probed.collect()} == exact


def test_conversation_turns(spark):
    rows = [(7, 0, "system", "s"), (7, 1, "user", "q"), (7, 2, "assistant", "a"), (7, 2000, "assistant", "late"), (9, 0, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["argument"], r["question"]) for r in corpus.conversation_arguments(df).collect()}
    assert got == {("a", "q"), ("late", None), ("first", None)}


def test_leakage_report(spark):
    rows = [(i, f"alpha beta gamma delta w{i}", "a", "train") for i in range(5)]
    rows += [(10, "alpha beta gamma delta w0", "a", "test"), (11, "omega psi chi [MSK1]", "b", "test"), (12, "alpha beta gamma delta w1", "b", "val")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, split string")
    got = leakage.leakage_report(df, near_duplicate_limit=0).first()
    assert (got["train_rows"], got["val_rows"], got["test_rows"], got["test_labels"]) == (5, 1, 2, 2)
    assert (got["train_val_overlap"], got["train_test_overlap"], got["test_masked"], got["train_masked"]) == (1, 1, 1, 0)
    assert (got["near_duplicates"], got["compared"], got["exact_leak"], got["near_leak"]) == (1, 2, True, True)
    sampled = leakage.leakage_report(df, sample_train=3, sample_test=1).first()
    assert (sampled["compared"], sampled["test_rows"]) == (1, 2)


def test_sources_with_and_without_line_breaks(spark, tmp_path):
    from argulith.plans.prepare import load_sources
    from argulith.sources.readers import scan_arguments

    path = str(tmp_path / "flat.csv")
    spark.createDataFrame([("a, \"b\"", "x"), ("c", "y")], "t string, l string").coalesce(1).write.csv(path, header=True, escape='"')
    for multi_line in (True, False):
        rows = load_sources(spark, [(path, "t", "l"), (str(tmp_path / "absent.csv"), "t", "l")], multi_line).collect()
        assert sorted((r["text"], r["raw_label"]) for r in rows) == [('a, "b"', "x"), ("c", "y")]
    path = str(tmp_path / "arguments.csv")
    cells = [("Because it rains", "why?", "pro"), ("It is dry", None, None)]
    spark.createDataFrame(cells, "argument string, question string, type string").write.csv(path, header=True, escape='"')
    found = scan_arguments(spark, path).collect()
    assert sorted(tuple(r)[1:] for r in found) == sorted(cells) and len({r["id"] for r in found}) == 2
