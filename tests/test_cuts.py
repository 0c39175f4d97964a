"""Samples and heads by a cut through the keys."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from argulith.operators import ranking

KEYS = {
    "dense": list(range(20_000)),
    "skewed": [n**3 for n in range(15_000)] + [2**63 - 1, -(2**63), -5],
    "ties": [7] * 12_000 + [1, 2, 3, 9],
}


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("n", [0, 1, 3, 500, 11_000, 14_999, 50_000])
def test_the_first_rows_by_key(spark, name, n):
    keys = KEYS[name]
    mixed = random.Random(1).sample(keys, len(keys))
    df = spark.createDataFrame([(k, f"text {k}") for k in mixed], "doc_id long, text string")
    got = ranking.head_n(df, n, "doc_id")
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(keys)[:n]


def test_null_and_text_keys(spark):
    rows = [(None, "a"), (3, "b"), (None, "c"), (1, "d"), (2, "e"), (2, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in range(8):
        want = sorted(k for k, _ in rows if k is not None)[:n]
        got = [r["doc_id"] for r in ranking.head_n(df, n, "doc_id").collect()]
        assert sorted(k for k in got if k is not None) == want and len(got) == min(n, 6)
    named = df.withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    assert sorted(r["doc_id"] for r in ranking.head_n(named, 3, "doc_id").collect()) == ["k1", "k2", "k2"]
    assert ranking.head_n(named, 6, "doc_id").count() == 6


def test_samples_repeat_and_nest(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    few, more = ({r[0] for r in ranking.sample_n(df, n, "doc_id", 5).select("doc_id").collect()} for n in (200, 2_000))
    assert len(few) == 200 and len(more) == 2_000 and few < more
    assert few == {r[0] for r in ranking.sample_n(df.repartition(7), 200, "doc_id", 5).select("doc_id").collect()}


def test_no_task_gets_all_candidates(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for made in (ranking.sample_n(df, 50, "doc_id"), ranking.head_n(df, 50, "doc_id")):
        assert made.count() == 50
        plan = plan_of(made)
        assert "SinglePartition" not in plan and "TakeOrdered" not in plan and "Limit" not in plan
        assert plan.rindex("Filter") > plan.rindex("Exchange")  # rows are chosen before any is moved
