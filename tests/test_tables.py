import hashlib
import math

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from argulith.operators import bounded, dedup, labels, ranking


def md5(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def half_up(x):
    return math.floor(x + 0.5)


def skewed(spark, n=3000):
    """A third of the rows share one text and one class."""
    rows = [(i, "copy" if i % 3 == 0 else f"text {i % 700}", "big" if i % 3 == 0 else f"c{i % 5}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, label string")


def test_shuffled_index_is_a_permutation_in_hash_order(spark):
    rows, df = skewed(spark)
    got = {r["doc_id"]: r["row_idx"] for r in ranking.shuffled_index(df, "doc_id", 7).collect()}
    order = sorted((md5(7, i), i) for i, _, _ in rows)
    assert got == {i: n for n, (_, i) in enumerate(order)}


def test_row_index_on_sparse_clustered_keys(spark):
    keys = [i for i in range(500)] + [10**12 + 7 * i for i in range(500)] + [-(3**k) for k in range(30)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["row_idx"] for r in ranking.row_index(df, "k").collect()}
    assert got == {k: n for n, k in enumerate(sorted(keys))}


def test_rank_in_class(spark):
    rows, df = skewed(spark)
    want = {}
    for label in {r[2] for r in rows}:
        members = sorted((md5(42, i), i) for i, _, c in rows if c == label)
        want |= {i: (n + 1, len(members)) for n, (_, i) in enumerate(members)}
    got = {r["doc_id"]: (r["rank_in_class"], r["class_size"]) for r in ranking.rank_in_class(df, "label", "doc_id").collect()}
    assert got == want


@pytest.mark.parametrize("sizes", [[1, 2, 3, 4, 5, 6, 9, 10, 14, 15, 200], [1], [1000, 5]])
def test_stratified_split_quotas(spark, sizes):
    rows = [(c * 10_000 + i, f"class{c}") for c, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    got = {r["doc_id"]: r["split"] for r in ranking.stratified_split(df, "label", "doc_id").collect()}
    assert len(got) == len(rows)
    for c, n in enumerate(sizes):
        members = [i for _, i in sorted((md5(42, c * 10_000 + i), c * 10_000 + i) for i in range(n))]
        n_test = half_up(n * 10 / 100)
        n_val = half_up((n - n_test) * 111 / 1000)
        want = ["test"] * n_test + ["val"] * n_val + ["train"] * (n - n_test - n_val)
        assert [got[i] for i in members] == want
        assert want.count("train") >= 1


def test_stratified_split_moves_no_rows(spark):
    _, df = skewed(spark)
    plan = plan_of(ranking.stratified_split(df, "label", "doc_id"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_hash_split_is_row_local_and_close_to_its_shares(spark):
    df = ranking.hash_split(spark.range(20_000).withColumnRenamed("id", "doc_id"), "doc_id")
    assert "Exchange" not in plan_of(df)
    shares = {r["split"]: r["count"] / 20_000 for r in df.groupBy("split").count().collect()}
    assert abs(shares["test"] - 0.1) < 0.01 and abs(shares["val"] - 0.1) < 0.01


def test_sample_and_head(spark):
    rows, df = skewed(spark)
    want = [i for _, i in sorted((md5(1, i), i) for i, _, _ in rows)[:10]]
    assert [r["doc_id"] for r in ranking.sample_n(df, 10, "doc_id", 1).collect()] == want
    assert ranking.sample_n(df.limit(5), 10, "doc_id").count() == 5
    assert [r["doc_id"] for r in ranking.head_n(df, 3, "doc_id").collect()] == [0, 1, 2]


def first_ids(rows):
    seen = {}
    for i, t, _ in sorted(rows):
        seen.setdefault(t, i)
    return set(seen.values())


def test_dedup_keeps_the_lowest_key(spark):
    rows, df = skewed(spark)
    assert {r["doc_id"] for r in dedup.dedup_exact(df).collect()} == first_ids(rows)
    assert {r["doc_id"] for r in dedup.keep_first(df).collect()} == first_ids(rows)


def test_copies_are_dropped_before_the_shuffle(spark):
    _, df = skewed(spark)
    plan = plan_of(dedup.keep_first(df))
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert plan[partial:].split("\n")[0].rstrip().endswith("Partial")
    keys = plan_of(dedup.dedup_exact(df))
    assert "partial_min(doc_id" in keys and "SortAggregate" not in keys


def test_overlap_and_contamination(spark):
    rows, df = skewed(spark, 900)
    parts = ranking.hash_split(df, "doc_id").cache()
    by = {p: {r["text"] for r in parts.filter(F.col("split") == p).collect()} for p in ("train", "val", "test")}
    got = dedup.split_overlap(parts).first()
    assert (got["train_val_overlap"], got["train_test_overlap"]) == (len(by["train"] & by["val"]), len(by["train"] & by["test"]))
    train, test = parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "test")
    marked = {r["doc_id"]: r["contaminated"] for r in dedup.mark_contaminated(test, train).collect()}
    assert marked == {r["doc_id"]: r["text"] in by["train"] for r in test.collect()}
    dirty = {r["doc_id"] for r in dedup.contaminated_rows(test, train).collect()}
    clean = {r["doc_id"] for r in dedup.contaminated_rows(test, train, clean=True).collect()}
    assert dirty == {i for i, c in marked.items() if c} and clean == set(marked) - dirty


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_are_joined_apart_with_the_same_result(spark, how):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 40}")) for i in range(600)]
    left = spark.createDataFrame(rows, "i long, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zzz", 4)], "k string, v long")
    plain = left.join(right, "k", how)
    assert bounded.hot_keys(left, "k", 100) == ["hot"]
    split = bounded.join_to_unique(left, right, "k", how, hot_rows=100)
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_a_large_side_is_not_broadcast(spark):
    df = spark.range(100)
    joined = spark.range(10).join(bounded.broadcast_bounded(df, 50), "id")
    assert not joined._jdf.queryExecution().logical().toString().lower().count("broadcast")
    small = spark.range(10).join(bounded.broadcast_bounded(df, 100), "id")
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert joined.count() == small.count() == 10


def test_labels(spark):
    df = spark.createDataFrame([(1, "ad populum"), (2, "AD POPULUM"), (3, None), (4, "straw man"), (5, "miscellaneous")], "i int, raw string")
    mapped = labels.canonical_label(df, "raw")
    assert {r["i"]: r["label"] for r in mapped.collect()} == {1: "appeal_to_popularity", 2: None, 3: None, 4: "straw_man", 5: None}
    index = labels.label_index(mapped)
    assert [tuple(r) for r in index.orderBy("label_id").collect()] == [("appeal_to_popularity", 0), ("straw_man", 1)]
    zero = labels.encode_label(mapped, index, unmapped="zero")
    assert {r["i"]: r["label_id"] for r in zero.collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0}
    kept = labels.encode_label(mapped, index)
    assert {r["i"]: r["label_id"] for r in kept.collect()} == {1: 0, 4: 1}
    back = labels.decode_label(kept.select("i", "label_id"), index)
    assert {r["i"]: r["label"] for r in back.collect()} == {1: "appeal_to_popularity", 4: "straw_man"}
    with pytest.raises(ValueError):
        labels.encode_label(mapped, index, unmapped="guess")


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "label string")
    got = {r["label"]: r["weight"] for r in labels.class_weights(df).collect()}
    assert got == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})


def test_corpus_union_prefers_the_first_corpus(spark):
    one = spark.createDataFrame([(5, "same"), (6, "only one")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "same"), (6, "only two")], "doc_id long, text string")
    got = {tuple(r) for r in dedup.corpus_union({"a": one, "b": two}).select("corpus", "doc_id").collect()}
    assert got == {("a", 5), ("a", 6), ("b", 6)}


def test_rows_without_a_class_are_a_class_of_their_own(spark):
    rows = [(i, None if i % 2 else "a") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    ranked = ranking.rank_in_class(df, "label", "doc_id").collect()
    assert len(ranked) == 400
    for label in ("a", None):
        assert sorted(r["rank_in_class"] for r in ranked if r["label"] == label) == list(range(1, 201))
    split = ranking.stratified_split(df, "label", "doc_id").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in split} == {
        (label, part): n for label in ("a", None) for part, n in (("test", 20), ("val", 20), ("train", 160))
    }


def test_rows_without_a_class_have_no_weight(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "label string")
    assert {r["label"]: r["weight"] for r in labels.class_weights(df).collect()} == {"a": 0.75, "b": 1.5}


def test_passage_keys_are_unique_or_an_error(spark):
    from argulith.plans.corpus import conversation_arguments

    def keys(conversation):
        turns = [(conversation, 0, "user", "why"), (conversation, 1, "assistant", "because")]
        return [r["id"] for r in conversation_arguments(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()]

    assert keys(7) == [(7 << 32) + 1] and keys((1 << 31) - 1) == [((1 << 63) - (1 << 32)) + 1]
    for wrong in (1 << 31, (1 << 32) + 7, -1):
        with pytest.raises(Exception, match="no passage key"):
            keys(wrong)
