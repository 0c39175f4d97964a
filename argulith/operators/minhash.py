"""Similar word sets by banded MinHash: equal bands make candidates, their sets decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argulith.functions.text import word_tokens
from argulith.session import stage

BUCKET_ROWS = 1_000  # rows of one band key that a task meets; larger buckets are split
_WORDS = 4_096  # hashed words that stand as a matrix at a time


def band_keys(words: Column, bands: int, rows: int, seed: int = 42) -> Column:
    """One long per band of a set of hashed words; null for an empty or missing set.

    Each of ``bands * rows`` functions multiplies by an odd number and mixes; its least value over the set
    agrees between two sets with about the chance of their Jaccard similarity. A band's key is the
    mix of its ``rows`` least values.
    """
    draw = np.random.default_rng(seed)
    odd = draw.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = draw.integers(0, 2**64, bands * rows, dtype=np.uint64)
    fold = draw.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = np.uint64(29)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(sets: pa.Array) -> pa.Array:
        out = []
        for held in sets:
            if not held.is_valid or not len(held.values):
                out.append(None)
                continue
            hashed = held.values.to_numpy(zero_copy_only=False).view(np.uint64)
            least = np.full(bands * rows, np.uint64(2**64 - 1))
            for at in range(0, len(hashed), _WORDS):
                mixed = hashed[at : at + _WORDS, None] * odd + add
                mixed = (mixed ^ (mixed >> shift)) * odd
                least = np.minimum(least, (mixed ^ (mixed >> shift)).min(axis=0))
            folded = (least.reshape(bands, rows) * fold).sum(axis=1, dtype=np.uint64)
            out.append((folded ^ (folded >> shift)).view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    return keys(words)


def word_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, words)``: the hashed word set of the row with the smallest key among those that share it."""
    words = F.array_sort(F.array_distinct(F.transform(word_tokens(F.col(text_col)), lambda w: F.xxhash64(w))))
    sets = df.select(F.col(id_col).cast("long").alias("id"), words.alias("words"))
    digest = F.sha2(F.array_join(F.transform("words", lambda w: w.cast("string")), ","), 256).alias("digest")
    firsts = sets.filter(F.size("words") > 0).groupBy(digest).agg(F.min("id").alias("id")).select("id")
    return stage(sets.join(firsts, "id", "left_semi"), "word_sets")


def _banded(sets: DataFrame, bands: int, rows: int, seed: int) -> DataFrame:
    return sets.select("id", F.size("words").alias("n"), F.posexplode(band_keys(F.col("words"), bands, rows, seed)).alias("band", "key"))


def minhash_join(
    left: DataFrame, right: DataFrame, at_least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    bands: int = 32, rows: int = 4, seed: int = 42, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(left_id, right_id, jaccard)`` of word sets that share at least ``at_least`` of their words.

    Texts with the same words are one set under its smallest key, so copies add no pairs; texts
    without words have no partners; keys are unique, a row without one takes no part. A pair of
    similarity s is missed with probability ``(1 - s ** rows) ** bands``, 5e-8 at 0.8 with the defaults; pairs
    found are always right. A bucket of more right rows than ``bucket_rows`` is cut into parts
    which the left rows of that bucket meet one by one, so a band that a third of all rows share is many
    tasks' work.
    """
    sides = [word_sets(df.filter(F.col(id_col).isNotNull()), id_col, text_col) for df in (left, right)]
    asked, held = (stage(_banded(side, bands, rows, seed), "bands") for side in sides)
    sizes = held.groupBy("band", "key").count().filter(F.col("count") > bucket_rows)
    sizes = sizes.select("band", "key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts"))
    split = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("id"), split).cast("int")
    cut = held.join(sizes, ["band", "key"], "left").select("band", "key", part.alias("part"), F.col("id").alias("right_id"), F.col("n").alias("right_n"))
    every = F.explode(F.sequence(F.lit(0), split - 1)).alias("part")
    met = asked.join(sizes, ["band", "key"], "left").select("band", "key", every, F.col("id").alias("left_id"), F.col("n").alias("left_n"))
    # Sets share no more words than the smaller one has: other pairs are left out before any words move.
    alike = F.least("left_n", "right_n") / F.greatest("left_n", "right_n") >= at_least
    pairs = met.join(cut, ["band", "key", "part"]).filter(alike).select("left_id", "right_id").distinct()
    words = [side.select(F.col("id").alias(f"{n}_id"), F.col("words").alias(f"{n}_words")) for n, side in zip(("left", "right"), sides)]
    both = pairs.join(words[0], "left_id").join(words[1], "right_id")
    common = F.size(F.array_intersect("left_words", "right_words"))
    jaccard = common / (F.size("left_words") + F.size("right_words") - common)
    return both.select("left_id", "right_id", jaccard.alias("jaccard")).filter(F.col("jaccard") >= at_least)
