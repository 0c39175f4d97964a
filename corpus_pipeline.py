"""From raw documents to token ids: five stages, each one operator of ``argulith.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``docs``. SQL cannot express
the first, third and last stage, so there is no oracle; the tests hold every stage against
brute force.

In every stage a null text counts as empty, very long texts are whole, an empty table gives no rows and other
columns pass through. Empty texts are scored, mixed (size 0) and encoded (no ids) like any other; SimHash keeps
one of them. Rows without an id keep their place in all stages but count as one key where a smallest id decides
between equals; repeated rows are scored and encoded one by one, and SimHash keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith.llm import bpe, line_dedup, mixing, simhash, toxicity
from argulith.llm.common import spare, table, word_count
from argulith.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on this table's labelled rows, does not reject."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = model.score(docs)
    predicted = scored.columns[-1]
    return scored.filter(F.col(predicted) == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier passage; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them; one that stands across a budget's end if half is inside."""
    words = spare("_words", docs.columns)
    mixed = mixing.mix_rows(docs.withColumn(words, word_count(F.col("text"))), size=words)
    copies, cut = mixed.columns[-2:]
    times = F.col(copies) + ((2 * F.col(cut) > F.col(words)) & (F.col(cut) > 0)).cast("int")
    repeated = mixed.withColumn(spare("_copy", mixed.columns), F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
