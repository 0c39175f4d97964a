"""Names found by a join against the pattern that tries them one after the other."""

import re

from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.functions import entities
from argulith.operators import names as nm

LISTED = [
    ("New York", "GPE"), ("York", "GPE"), ("Paris", "GPE"), ("paris", "GPE"), ("Middle East", "LOC"), ("UN", "ORG"), ("Mary Smith", "PERSON"),
    ("GDPR", "LAW"), (None, "GPE"), ("", "GPE"), ("east side", "LOC"), ("a+b", "ORG"), ("x", "GPE"), ("x", "LOC"), ("the end of a long name", "ORG"),
]
TEXTS = [
    "new york beats york, not yorkshire", "the un in the middle east side under gdpr", "mary smith spoke in paris on 2024-03-15",
    "in paris", None, "", "x" * 30 + " paris_ paris! xparis", "a+b and a b meet x\nin\nmiddle  east", "middle\neast middle east",
    "paris " * 3_000, "é paris é", "[paris] (new york)", "the end of a long name, the end of a long day", "new  york new york", ".paris", "paris",
]


def test_masks_are_those_of_the_pattern(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("matches_", F.lit(1))
    table = spark.createDataFrame(LISTED, "name string, kind string")
    lists = {}
    for name, kind in LISTED:
        if name and kind in fixed.ENTITY_PLACEHOLDERS:
            lists.setdefault(kind, []).append(name)
    kinds = tuple(lists)
    got = {r["doc_id"]: r["text"] for r in nm.mask_names(df, table, "doc_id", kinds=kinds).collect()}
    want = {r[0]: r[1] for r in df.select("doc_id", entities.mask_entities(F.col("text"), lists)).collect()}
    assert got == want


def test_overlaps_take_the_first_then_the_longest(spark):
    df = spark.createDataFrame([(1, "new york city hall of york city")], "doc_id long, text string")
    table = spark.createDataFrame([("new york", "GPE"), ("york city hall", "ORG"), ("york city", "LOC"), ("york", "GPE")], "name string, kind string")
    assert nm.mask_names(df, table, "doc_id").first()["text"] == "[GPE] city hall of [LOC]"


def test_first_names_in_the_spelling_of_the_text(spark):
    rows = [(1, "The UN and the un and the Un left PARIS for New York"), (2, "nothing"), (3, None), (None, "Paris here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(LISTED, "name string, kind string")
    got = {r["doc_id"]: (r["orgs"], r["places"]) for r in nm.first_names(df, table, {"ORG": "orgs", "GPE": "places"}, "doc_id").collect()}
    assert got == {1: (["UN", "un"], ["PARIS", "New York"]), 2: ([], []), 3: ([], []), None: ([], [])}


def test_more_than_a_million_names(spark):
    many = spark.range(1_100_000).select(F.concat(F.lit("Name "), F.col("id").cast("string")).alias("name"), F.lit("GPE").alias("kind"))
    texts = [(n, f"we met name {n * 250_000} and name {n * 250_000} x, then name {1_100_000 + n} or name{n}") for n in range(6)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a table that no task could hold
    try:
        got = {r["doc_id"]: r["text"] for r in nm.mask_names(df, many, "doc_id").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for key, text in texts:
        assert got[key] == re.sub(r"name (\d+)\b", lambda m: "[GPE]" if int(m[1]) < 1_100_000 else m[0], text)


def test_no_names_and_no_texts(spark):
    df = spark.createDataFrame([(1, "only words in here")], "doc_id long, text string")
    none = spark.createDataFrame([], "name string, kind string")
    assert nm.mask_names(df, none, "doc_id").first()["text"] == "only words in here"
    assert nm.mask_names(df.limit(0), none, "doc_id").count() == 0
