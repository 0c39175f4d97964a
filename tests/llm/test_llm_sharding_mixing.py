"""Sharding and mixing against their laws and a brute-force version."""

import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from argulith.llm.common import word_count
from argulith.llm.mixing import mix_rows, op6_mixing, source_targets
from argulith.llm.sharding import hypergeometric, op1_sharding, shard_rows

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_hypergeometric_draws_have_the_exact_law(spark):
    from math import comb

    total, good, draws, n = 30, 12, 9, 4_000
    drawn = spark.range(n).select(
        hypergeometric(F.lit(total).cast("long"), F.lit(good).cast("long"), F.lit(draws).cast("long"), F.col("id")).alias("x")
    )
    seen = Counter(r["x"] for r in drawn.collect())
    chi = 0.0
    for x in range(10):
        expected = n * comb(good, x) * comb(total - good, draws - x) / comb(total, draws)
        if expected >= 5:
            chi += (seen[x] - expected) ** 2 / expected
    assert chi < 27  # 9 degrees of freedom: 0.1 %


def test_hypergeometric_at_its_ends_and_for_huge_counts(spark):
    def one(t, k, n):
        row = spark.range(1).select(
            hypergeometric(F.lit(t).cast("long"), F.lit(k).cast("long"), F.lit(n).cast("long"), 7).alias("x")
        )
        return row.first()["x"]

    assert (one(5, 0, 3), one(5, 5, 3), one(5, 2, 0), one(5, 2, 5)) == (0, 3, 0, 2)
    x = one(30_000_000_000, 2_000_000_000, 40_000_000)
    assert abs(x - 40_000_000 / 15) < 8 * (40_000_000 / 15) ** 0.5


def test_op1_holds_the_law_of_rows(spark, sf_dir):
    rows = op1_sharding(spark, sf_dir).toPandas()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().set_index("doc_id")["text"]
    assert sorted(rows["doc_id"]) == sorted(texts.index)
    sizes = rows.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert all(len(texts[d].encode()) + 1 == s for d, s in zip(rows["doc_id"], rows["size"]))
    assert set(rows["law"]) == {"rows"} and rows["grown_shard"].isna().all()


def test_large_shards_are_several_cells(spark):
    rows = shard_rows(spark.range(1_000).repartition(7), shards=4, cell_rows=60).toPandas()
    sizes = rows.groupby("shard").size()
    assert sizes.tolist() == [250] * 4
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(250))
    # Uniform: neither shards nor slots follow the input's order.
    assert abs(np.corrcoef(rows["id"], rows["shard"])[0, 1]) < 0.15
    assert abs(np.corrcoef(rows["id"], rows["slot"])[0, 1]) < 0.15


def test_sharding_odd_tables(spark):
    assert shard_rows(spark.createDataFrame([], DOC)).collect() == []
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x" * 50_000, "en", "a", 1)]
    table = spark.createDataFrame(rows, DOC).withColumn("shard", F.lit("own")).withColumn("_pid", F.lit(3))
    done = shard_rows(table, 3).toPandas()
    assert list(done.columns) == [*table.columns, "_shard", "slot"]
    assert sorted(done.groupby("_shard").size()) == [1, 1, 2] and set(done["shard"]) == {"own"}


def test_sharding_and_mixing_stay_in_the_jvm(spark, sf_dir):
    for query in (op1_sharding, op6_mixing):
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan_of(query(spark, sf_dir)))


def filled(sizes: dict, weights=(1, 2, 3), epochs=3) -> dict:
    """Targets by resharing until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in target]
        left, heavy = total - sum(target.values()), sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * left / heavy >= epochs * sizes[s]]
        if not full:
            return target | {s: weight[s] * left / heavy for s in open_}
        target |= {s: epochs * sizes[s] for s in full}
        if len(target) == len(names):
            return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, None: 1}, {"a": 1, "B": 1, "é": 1000, "z": 3}, {"only": 9}, {"a": 0, "b": 10}])
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = [(s, n, 1) for s, n in sizes.items()]
    got = source_targets(spark.createDataFrame(rows, "source string, source_size long, rows long"))
    expected = filled(sizes)
    assert {r["source"]: round(r["target"], 6) for r in got.collect()} == {s: round(t, 6) for s, t in expected.items()}


def test_op6_meets_every_target(spark, sf_dir):
    rows = op6_mixing(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    words = docs.set_index("doc_id")["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert (rows.set_index("doc_id")["size"].sort_index() == words.sort_index()).all()
    assert (rows["taken"] <= 3 * rows["size"]).all() and (rows["taken"] >= 0).all()
    by = rows.merge(docs[["doc_id", "source"]], on="doc_id").groupby("source")
    assert ((by["target"].max() - by["taken"].sum()).abs() < 1 + 1e-6).all()
    assert by["source_size"].max().to_dict() == by["size"].sum().to_dict()
    assert {s: round(t, 4) for s, t in by["target"].max().items()} == {
        s: round(t, 4) for s, t in filled(by["size"].sum().to_dict()).items()
    }
    again = op6_mixing(spark, sf_dir).toPandas()
    assert rows.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_mixing_odd_tables(spark):
    def mixed(rows):
        table = spark.createDataFrame(rows, DOC).withColumn("size", word_count(F.col("text"))).withColumn("cut", F.lit("own"))
        return mix_rows(table).toPandas()

    assert mixed([]).empty
    rows = [
        (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (3, "", "en", "s", 0),
        (4, " \t\n", "en", None, 3), (5, "w " * 5_000, "en", "t", 1),
    ]
    done = mixed(rows)
    assert len(done) == len(rows) and set(done["cut"]) == {"own"}
    taken = done["size"] * done["copies"] + done["_cut"]
    assert taken.sum() == done.groupby("source", dropna=False)["target"].max().map(np.floor).sum()
    assert (done["copies"] <= 3).all() and (taken <= 3 * done["size"]).all()
    no_words = mixed([(1, "", "en", "s", 0), (2, None, "en", None, 0)])
    assert no_words["copies"].tolist() == [0, 0]


def window_inputs(node) -> list[str]:
    """The columns that go into every window of a plan."""
    below = [node.children().apply(i) for i in range(node.children().size())]
    own = [below[0].output().mkString(",")] if node.nodeName() == "Window" else []
    return own + [columns for child in below for columns in window_inputs(child)]


@pytest.mark.parametrize("share", [0.3, 0.5, 0.77, 1.0])
def test_no_task_orders_all_rows_of_one_key(spark, share):
    """Null and repeated keys: exact sums, and no text goes into a window."""
    rows = [(None, "w " * (1 + i % 3), "en", "s", 0) for i in range(3_000)] + [(7, "w w", "en", "s", 0)] * 1_000
    rows += [(i, "w " * (i % 5), "en", "s", 0) for i in range(100, 1_100)] + [(None, "w w", "en", None, 0)] * 50
    table = spark.createDataFrame(rows, DOC).repartition(4).withColumn("size", word_count(F.col("text")))
    mixed = mix_rows(table, weights=(1, 1), share=share)
    done = mixed.toPandas()
    taken = done["size"] * done["copies"] + done["cut"]
    assert len(done) == len(rows) and (done["cut"] < done["size"].clip(lower=1)).all()
    for _, part in done.assign(taken=taken).groupby("source", dropna=False):
        assert part["taken"].sum() == np.floor(part["target"].max()) and (part["cut"] > 0).sum() <= 1
        assert part[part["size"] > 0]["copies"].max() - part[part["size"] > 0]["copies"].min() <= 1
    assert not any("text#" in columns for columns in window_inputs(mixed._jdf.queryExecution().optimizedPlan()))


def test_windows_see_few_rows(spark, monkeypatch):
    """Rows that reach a window over rows of one key, counted where the windows are built."""
    from argulith.llm import mixing

    seen = []
    numbers = mixing._row_numbers

    def counted(rows, group, mid):
        seen.append(rows.count())
        return numbers(rows, group, mid)

    monkeypatch.setattr(mixing, "_row_numbers", counted)
    rows = [(None, "w " * (1 + i), "en", "s", 0) for i in range(300)] + [(None, "w", "en", "s", 0)] * 20
    table = spark.createDataFrame(rows, DOC).withColumn("size", word_count(F.col("text")))
    done = mix_rows(table, share=0.5).toPandas()
    assert seen and max(seen) <= 21
    assert (done["size"] * done["copies"] + done["cut"]).sum() == np.floor(done["target"].max())
