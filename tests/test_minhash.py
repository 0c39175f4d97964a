"""Banded MinHash against all pairs of word sets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from argulith.operators import minhash


def all_pairs(left, right, at_least):
    def sets(rows):
        out = {}
        for key, text in sorted(rows):
            words = frozenset(re.findall(r"(?u)\b\w\w+\b", (text or "").lower()))
            if words:
                out.setdefault(words, key)
        return out

    return {
        (a_key, b_key): len(a & b) / len(a | b)
        for a, a_key in sets(left).items() for b, b_key in sets(right).items() if len(a & b) / len(a | b) >= at_least
    }


def texts(count, seed):
    words = [f"word{n}" for n in range(400)]
    draw = random.Random(0)
    base = [draw.sample(words, 30) for _ in range(12)]
    draw = random.Random(seed)
    rows = []
    for key in range(count):
        kept = [w if draw.random() > 0.04 else draw.choice(words) for w in draw.choice(base)]
        rows.append((key, " ".join(draw.sample(kept, len(kept)))))
    return rows


@pytest.mark.parametrize("bucket_rows", [minhash.BUCKET_ROWS, 3])
def test_every_similar_pair_is_found(spark, bucket_rows):
    left, right = texts(60, 1), [(key + 1_000, text) for key, text in texts(150, 2)]
    left += [(900, None), (901, ""), (902, left[0][1].upper()), (903, "x y z")]
    right += [(2_900, ""), (2_901, left[0][1] + " " + left[0][1])]
    frames = [spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1)) for rows in (left, right)]
    want = all_pairs(left, right, 0.8)
    got = {(r["left_id"], r["right_id"]): r["jaccard"] for r in minhash.minhash_join(*frames, bucket_rows=bucket_rows).collect()}
    assert len(want) > 50 and got == pytest.approx(want)


def test_recall_follows_the_bands(spark):
    left, right = texts(80, 3), [(key + 1_000, text) for key, text in texts(200, 4)]
    frames = [spark.createDataFrame(rows, "doc_id long, text string") for rows in (left, right)]
    want = all_pairs(left, right, 0.8)
    shares = [minhash.minhash_join(*frames, bands=b, rows=r).count() / len(want) for b, r in ((1, 12), (32, 4))]
    assert shares[0] < 0.9 and shares[1] == 1.0


def test_unrelated_texts_make_few_candidates(spark):
    rows = [(n, " ".join(f"t{n}w{i}" for i in range(20))) for n in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = minhash.word_sets(frame, "doc_id", "text")
    banded = minhash._banded(sets, 32, 4, 42)
    assert banded.groupBy("band", "key").count().filter("count > 1").count() == 0


def test_empty_side(spark):
    some = spark.createDataFrame([(1, "a few words here")], "doc_id long, text string")
    assert minhash.minhash_join(some, some.limit(0)).count() == 0
