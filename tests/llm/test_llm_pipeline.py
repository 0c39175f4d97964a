"""Every stage of the pipeline on the rows that its predecessor left."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_llm_texts import plain_components, plain_dedup, plain_fingerprint

from __spark_entry__ import oracle_sql, queries
from argulith.llm.catalog import ORACLES, QUERIES
from argulith.session import stage
from check import compare, connect

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The input of every stage, and what the last one returns."""
    docs = [stage(spark.read.parquet(f"{sf_dir}/documents.parquet"), "documents")]
    for name, apply in corpus_pipeline.STAGES:
        docs.append(stage(apply(spark, docs[-1], sf_dir), name))
    return docs


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(k.startswith(n) for k in queries()) == 1 for n in names)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, key):
    good, note = compare(spark, connect(sf_dir), sf_dir, key)
    assert good, note


def test_columns_stay(steps):
    for docs in steps[:-1]:
        assert docs.columns == COLUMNS
    assert steps[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables hold too few toxic documents to learn from
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, after = set(rows(docs)), set(rows(corpus_pipeline.drop_toxic(spark, docs, sf_dir)))
    gone = {r[0] for r in before - after}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    toxic = {d for d, kind in labels.items() if kind == 1}
    assert after < before and len(gone & toxic) >= len(toxic) / 3
    assert sum(labels.get(d) == 0 for d in gone) <= 0.01 * len(labels)


def test_lines(steps):
    expected = {r[0]: r[1] for r in plain_dedup([(r[0], r[1]) for r in rows(steps[1])])}
    assert {r[0]: r[1] for r in rows(steps[2])} == expected
    assert all(r[4] == len(r[1]) for r in rows(steps[2]))


def test_one_of_each_group_stays(steps):
    before = rows(steps[2])
    roots = plain_components({r[0]: plain_fingerprint(r[1]) for r in before})
    assert rows(steps[3]) == [r for r in before if roots[r[0]] == r[0]]


def test_mix(steps):
    before, after = rows(steps[3]), rows(steps[4])
    times = {r: after.count(r) for r in before}
    assert sum(times.values()) == len(after) and max(times.values()) <= 3
    words = {r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in before}
    for source in {r[3] for r in before}:
        own = [r for r in before if r[3] == source]
        # At most one step between the uses of a source's documents: whole epochs and one broken one.
        assert max(times[r] for r in own if words[r]) - min(times[r] for r in own if words[r]) <= 1
    total, mixed = sum(words.values()), sum(words[r] for r in after)
    assert abs(mixed - total) <= sum(max(words[r] for r in before if r[3] == s) for s in {r[3] for r in before}) / 2


def test_ids(steps):
    import public_tokenizers
    import tiktoken

    from argulith.llm.bpe import RANKS, read_ranks

    ranks = read_ranks(public_tokenizers.path(RANKS))
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((r[0], encoder.encode_ordinary(r[1])) for r in rows(steps[4]))
    assert sorted((r["doc_id"], list(r["ids"])) for r in steps[5].collect()) == expected


def test_run_is_all_stages(spark, sf_dir, steps):
    done = corpus_pipeline.run(spark, sf_dir)
    assert rows(done.drop("ids")) == rows(steps[-1].drop("ids"))


def test_stages_take_odd_tables(spark, sf_dir):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 9_000, "en", "s", 45_000)]
    for given in ([], odd):
        docs = spark.createDataFrame(given, kinds).withColumn("score", F.lit("own")).withColumn("size", F.lit(1))
        for name, apply in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(apply(spark, docs, sf_dir), name)
            assert name == "byte_bpe" or docs.columns == before
        assert docs.count() == (1 if given else 0)
