"""Quality and toxicity by their accuracy on rows that no label was learned from."""

import zlib

import pytest
from pyspark.sql import functions as F

from argulith.llm import quality, toxicity

DOC = "doc_id long, text string"
SCORED = "/root/testdata/sf0.01"


def judged(spark, scored, label: str) -> tuple:
    rows = scored.join(spark.read.parquet(f"{SCORED}/labels.parquet"), "doc_id").toPandas()
    held = rows[rows["held_out"]]
    share = (held["predicted"] == held[label]).mean()
    order = held["score"].rank()
    ones = held[label] == 1
    area = (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    return share, area


@pytest.fixture(scope="module")
def qualities(spark):
    return quality.op8_quality(spark, SCORED).persist()


@pytest.fixture(scope="module")
def toxicities(spark):
    return toxicity.op9_toxicity(spark, SCORED).persist()


def test_held_out_accuracy(spark, qualities, toxicities):
    share, area = judged(spark, qualities, "quality")
    assert share >= 0.97 and area >= 0.95
    share, area = judged(spark, toxicities, "toxic")
    assert share >= 0.92 and area >= 0.75


@pytest.mark.parametrize("name, folds, held", [("qualities", 3, 1), ("toxicities", 5, 0)])
def test_rows_and_folds(spark, request, name, folds, held):
    rows = request.getfixturevalue(name).toPandas()
    assert list(rows.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert sorted(rows["doc_id"]) == [r[0] for r in spark.read.parquet(f"{SCORED}/documents.parquet").select("doc_id").orderBy("doc_id").collect()]
    assert all((zlib.crc32(str(i).encode()) % folds == held) == h for i, h in zip(rows["doc_id"], rows["held_out"]))
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.5)).all()


def test_only_labels_of_other_folds_are_learned(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    ours, theirs = toxicity.fit_toxicity(documents, labels), toxicity.fit_toxicity(documents, turned)
    assert ours.pair == theirs.pair and ours.beta == theirs.beta


def test_rules_are_conjunctions_of_few_statistics(spark):
    names = list(quality.statistics(F.lit("")))
    rows = spark.range(400).select(
        F.col("id").alias("doc_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(100)) / 100).alias(n) for n in names],
    )
    rows = rows.withColumn("quality", ((F.col("marks") <= 0.5) & (F.col("words") > 0.2)).cast("int"))
    ensemble = quality.fit(rows, "quality")
    used = {part[0] for rule, _ in ensemble.rules for part in rule.parts}
    assert {"marks", "words"} <= used and all(1 <= len(rule.parts) <= quality.DEPTH for rule, _ in ensemble.rules)
    same = {n: n for n in names}
    right = rows.filter((ensemble.chance(same) >= 0.5).cast("int") == F.col("quality")).count()
    assert right >= 392
    # The lasso leaves rules out.
    assert len(ensemble.rules) < 2 ** (quality.DEPTH + 1) * quality.TREES


def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (3, " \n"), (None, "a b"), (7, "word " * 30_000), (8, "x" * 200_000), (9, "é" * 500)]
    table = spark.createDataFrame(rows, DOC)
    for name in ("score", "predicted", "_words", "mean", "most"):
        table = table.withColumn(name, F.lit("own"))
    return table


def test_odd_tables(spark):
    rule = quality.Rule((("words", True, 1.0), ("bars", False, 0.5)))
    models = [
        quality.RuleEnsemble(((rule, 2.0),), -0.5),
        quality.RuleEnsemble((), 10.0),
        toxicity.CompressionModel(None, [0.0] * 4),
        toxicity.CompressionModel(toxicity.dictionaries(["a b c"] * 4, ["you fool"] * 4), [-1.0, 1.0, 1.0, 1.0]),
    ]
    table = odd(spark)
    for model in models:
        done = model.score(table)
        assert done.columns == [*table.columns, "_score", "_predicted"]
        rows = done.collect()
        assert len(rows) == 8 and all(0 <= r["_score"] <= 1 and r["score"] == "own" for r in rows)
        same = [r["_score"] for r in rows if r["doc_id"] == 3]
        assert same[0] == same[1]
        assert model.score(spark.createDataFrame([], DOC)).collect() == []


def test_labels_of_one_kind_or_none(spark):
    documents = odd(spark).select("doc_id", "text")
    for kinds in ([], [(1, None, None)], [(2, 1, 0), (7, 1, 0)]):
        labels = spark.createDataFrame(kinds, "doc_id long, quality int, toxic int")
        model = toxicity.fit_toxicity(documents, labels)
        assert {r["score"] for r in model.score(documents).collect()} == {0.0}
        measured = documents.select("doc_id", *[c.alias(n) for n, c in quality.statistics(F.col("text")).items()])
        ensemble = quality.fit(measured.join(labels, "doc_id"), "quality")
        assert all(r["score"] > 0.9 for r in ensemble.score(documents).collect())


def test_windows_are_the_whole_text():
    for text in ("", "a", "a b " * 100, "x" * 1_000, "A  b\n" + "y" * 300 + " c"):
        cuts = toxicity.windows(text)
        line = b" " + b" ".join(toxicity.words_of(text)) + b" "
        if len(line) > 1 and toxicity.words_of(text):
            assert b"".join([cuts[0], *[c[1:] for c in cuts[1:]]]) == line
        assert all(len(c) <= 2 * toxicity.WINDOW + 1 for c in cuts)


def spoken(count: int, words: list[str], own: list[str], seed: int) -> list[str]:
    import random

    draw = random.Random(seed)
    return [" ".join(draw.choice(own) if own and draw.random() < 0.1 else draw.choice(words) for _ in range(120)) for _ in range(count)]


def test_each_class_trains_its_own_dictionary():
    common = [f"{a}{b}" for a in ("sun", "rain", "wind", "hill") for b in ("set", "fall", "mill", "side", "ward")]
    ordinary = spoken(60, common, ["harvest", "orchard"], 1)
    toxic = spoken(60, common, ["blockhead", "numbskull"], 2) + ["sunset rainonce"] * 500
    for mild, harsh in toxicity.dictionary_pairs(ordinary, toxic):
        assert len(mild) == len(harsh) and mild != harsh
        assert b"harvest" in mild and b"harvest" not in harsh and b"numbskull" in harsh and b"numbskull" not in mild
        assert b"rainonce" not in mild + harsh  # many copies are one window
        saved = [toxicity.measure(text, toxicity.compressor(mild), toxicity.compressor(harsh))[0] for text in ("sunset blockhead rainfall", "orchard hillside", "")]
        assert saved[0] > 0 > saved[1] and saved[2] == 0


def test_windows_of_a_class():
    toxic = ["the old fool sat", "a poor fool ran", "the old fool sat", "one odd fool", "my fool", "big fool", "sad fool"]
    found = toxicity.own_windows(toxic, {b"the", b"old"})
    assert found == sorted({b" old fool ", b" poor fool ", b" odd fool ", b" my fool ", b" big fool ", b" sad fool "})
    assert toxicity.shared_windows(["the old the old", "the old the old"], {b"the", b"old"}) == [b" the old "]
