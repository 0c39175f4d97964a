"""The sparse similarity join against the product of all pairs."""

import numpy as np
import pytest

from argulith.operators import similarity_join, tfidf

SCHEMA = "doc_id long, vector struct<size: int, indices: array<int>, values: array<double>>"


def frame(spark, rows, first=0):
    made = []
    for n, row in enumerate(rows):
        at = np.flatnonzero(row)
        made.append((first + n, (len(row), at.tolist(), row[at].tolist())))
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def vectors(count, width, seed, near=0):
    """Unit vectors of few components; some are near copies of the first ones, two are zero."""
    draw = np.random.default_rng(seed)
    rows = np.where(draw.random((count, width)) < 0.05, draw.random((count, width)), 0.0)
    for n in range(near):
        rows[-n - 1] = rows[n % 4] + np.where(draw.random(width) < 0.01, 0.3, 0.0)
    rows[count // 2] = 0
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


@pytest.mark.parametrize("above", [0.85, 0.5, 0.1])
@pytest.mark.parametrize("block_bytes", [64 << 20, 8 * 900 * 20])
def test_all_pairs(spark, above, block_bytes):
    left, right = vectors(60, 700, 1), vectors(150, 700, 2, near=20)
    right[-20:-10] = left[:10]
    got = similarity_join.near_partners(frame(spark, left), frame(spark, right, 1_000), above, block_bytes=block_bytes)
    product = left @ right.T
    want = {n: ((row > above).sum(), row.max()) for n, row in enumerate(product) if (row > above).any()}
    found = {r["query_id"]: (r["n_above"], r["max_above"]) for r in got.collect() if r["n_above"]}
    assert found.keys() == want.keys()
    for n in want:
        assert found[n] == pytest.approx(want[n])


def test_unrelated_texts_are_not_multiplied(spark):
    """Products grow with the near pairs, not with rows times rows."""
    shares = []
    for rows in (100, 400):
        left, right = vectors(rows, 3_000, 5), vectors(rows, 3_000, 6)
        right[:10] = left[:10]
        got = similarity_join.near_partners(frame(spark, left), frame(spark, right), 0.85).collect()
        assert sum(r["n_above"] for r in got) == 10
        shares.append(sum(r["verified"] for r in got) / rows**2)
    assert shares[1] < shares[0] / 3 and sum(r["verified"] for r in got) < 30


def test_existence_stops_at_the_first_partner(spark):
    rows = np.tile(vectors(1, 50, 3), (1, 1)) + np.eye(1, 50)
    rows = np.tile(rows / np.linalg.norm(rows), (400, 1))
    every = similarity_join.near_partners(frame(spark, rows), frame(spark, rows), 0.85).collect()
    once = similarity_join.near_partners(frame(spark, rows), frame(spark, rows), 0.85, once=True).collect()
    assert {r["query_id"] for r in once if r["n_above"]} == {r["query_id"] for r in every if r["n_above"]} == set(range(400))
    assert sum(r["verified"] for r in once) < sum(r["verified"] for r in every) / 10


def test_other_dimensions_are_an_error(spark):
    with pytest.raises(Exception, match="dimensions"):
        similarity_join.near_partners(frame(spark, vectors(3, 20, 1)), frame(spark, vectors(3, 30, 1)), 0.5).collect()


def test_empty_sides_and_empty_texts(spark):
    texts = spark.createDataFrame([(1, ""), (2, "red fish swim"), (3, "red fish swim"), (4, None)], "doc_id long, text string")
    model = tfidf.fit_tfidf(texts.na.fill(""))
    some = texts.na.fill("")
    both = tfidf.near_duplicate_count(tfidf.near_copies(some, some, model)).first()
    assert tuple(both) == (2, 4)
    assert tuple(tfidf.near_duplicate_count(tfidf.near_copies(some, some.limit(0), model)).first()) == (0, 4)
    assert tuple(tfidf.near_duplicate_count(tfidf.near_copies(some.limit(0), some, model)).first()) == (0, 0)
