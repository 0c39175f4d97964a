"""The registry: a query over the given tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.operators.ranking import hash_split
from argulith.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(key)
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for costly work per text: on all cores, however few row groups the file has."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


def six(column: Column | str) -> Column:
    """Doubles are compared at six places."""
    return F.round(column, 6)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- inputs derived from the tables, once for Spark and once as SQL ----------------------------

RAW_NAMES: list[str | None] = [*fixed.LABEL_ALIASES, "miscellaneous", None]


def pick(values: list, key: str = "doc_id") -> Column:
    """One of the values for every row, by its key."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int"))


def pick_sql(values: list, key: str = "doc_id") -> str:
    listed = ", ".join("NULL" if v is None else quoted(v) for v in values)
    return f"list_extract([{listed}], ({key} % {len(values)})::BIGINT + 1)"


def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a raw label name, some of them unknown or null."""
    return table(spark, sf_dir, "documents").withColumn("raw_label", pick(RAW_NAMES))


NAMED_SQL = f"SELECT *, {pick_sql(RAW_NAMES)} AS raw_label FROM documents"

ALIASES_SQL = "SELECT * FROM (VALUES {}) AS a(raw_label, label)".format(
    ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in fixed.LABEL_ALIASES.items())
)


def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with one of the 13 labels and a confidence."""
    return (
        table(spark, sf_dir, "documents")
        .withColumn("label", pick(fixed.CANONICAL_LABELS))
        .withColumn("confidence", (F.col("doc_id") % 100) / 100)
    )


CANONICAL_SQL = (
    f"SELECT *, {pick_sql(fixed.CANONICAL_LABELS)} AS label, (doc_id % 100) / 100.0::DOUBLE AS confidence FROM documents"
)


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rated documents; their class is the pair of ratings."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("class_"), (F.col("quality") * 2 + F.col("toxic")).cast("string")).alias("label")
    )
    return texts(spark, sf_dir, "lang", "source").join(labels, "doc_id")


RATED_SQL = (
    "SELECT d.doc_id, d.text, d.lang, d.source, 'class_' || (l.quality * 2 + l.toxic) AS label "
    "FROM documents d JOIN labels l USING (doc_id)"
)


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of three parts, copies included, so that parts overlap."""
    return hash_split(canonical_documents(spark, sf_dir), "doc_id")


SPLIT_CASE_SQL = (
    "CASE WHEN md5('42:' || {0})[1:4] < '1999' THEN 'test' WHEN md5('42:' || {0})[1:4] < '3333' THEN 'val' ELSE 'train' END"
)
SPLIT_SQL = f"SELECT *, {SPLIT_CASE_SQL.format('doc_id')} AS split FROM ({CANONICAL_SQL})"

# Texts with entities of every kind the rules know, put behind the documents.
ENTITY_TAILS = [
    " on 2024-03-15 at 10:30 am we paid $1,200.50 million in NATION_12 .",
    " March 3, 2021 and 45% of all NATION_3 trade with EUROPE about Grain prices .",
    " every Monday since 5 may 2020 some 12.5 percent left MIDDLE EAST . Mary Smith said so !",
    " £30 by 9 pm in December 1999 .",
    "",
]


def documents_with_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "lang", "source").withColumn("text", F.concat("text", pick(ENTITY_TAILS)))


ENTITIES_SQL = f"SELECT * REPLACE (text || {pick_sql(ENTITY_TAILS)} AS text) FROM documents"

MASK_TAILS = [" [MSK1] and [MSK22]", " [msk3]", " <MSK2> is <MSK4>", " [MSK]", "", "", ""]


def documents_with_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir).withColumn("text", F.concat("text", pick(MASK_TAILS)))


MASKS_SQL = f"SELECT * REPLACE (text || {pick_sql(MASK_TAILS)} AS text) FROM ({SPLIT_SQL})"

# --- SQL of the text functions ------------------------------------------------------------------

BLANK_SQL = r"[\s\x{A0}\x0B\x1C-\x1F]"
NOT_BLANK_SQL = r"[^\s\x{A0}\x0B\x1C-\x1F]"


def strip_html_sql(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def strip_urls_sql(x: str) -> str:
    return f"regexp_replace({x}, 'https?://{NOT_BLANK_SQL}+|www\\.{NOT_BLANK_SQL}+', ' ', 'g')"


def collapse_ws_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANK_SQL}+', ' ', 'g'))"


def clean_cased_sql(x: str) -> str:
    return collapse_ws_sql(strip_urls_sql(strip_html_sql(f"coalesce({x}, '')")))


def clean_sql(x: str) -> str:
    return f"lower({clean_cased_sql(x)})"
