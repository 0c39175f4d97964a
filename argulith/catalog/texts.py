"""Scalar text functions, entities and explanations."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argulith import fixed_values as fixed
from argulith.catalog.base import (
    BLANK_SQL,
    CANONICAL_SQL,
    ENTITIES_SQL,
    MASKS_SQL,
    NOT_BLANK_SQL,
    canonical_documents,
    clean_cased_sql,
    clean_sql,
    collapse_ws_sql,
    documents_with_entities,
    documents_with_masks,
    pick,
    pick_sql,
    query,
    quoted,
    strip_html_sql,
    strip_urls_sql,
    table,
)
from argulith.functions import entities, explain, text as tx
from argulith.functions.udfs import map_texts, map_with_setup
from argulith.operators import names

_PAGES = "SELECT page_id, md5({}) AS text_md5, length({}) AS n FROM pages"


def _pages(spark: SparkSession, sf_dir: str, function) -> DataFrame:
    done = table(spark, sf_dir, "pages").select("page_id", function(F.col("html")).alias("t"))
    return done.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


def _pages_sql(expression: str) -> str:
    return _PAGES.format(expression, expression)


@query("strip_html", _pages_sql(strip_html_sql("html")))
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, tx.strip_html)


@query("strip_urls", _pages_sql(strip_urls_sql("html")))
def strip_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, tx.strip_urls)


@query("collapse_ws", _pages_sql(collapse_ws_sql("html")))
def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, tx.collapse_ws)


# Characters that NFKC rewrites, and what it makes of them.
_COMPATIBLE = "ﬁne Ｔｅｘｔ ① ½"
_COMPOSED = "fine Text 1 1⁄2"


@query("nfkc", f"SELECT doc_id, md5(text || {quoted(' ' + _COMPOSED)}) AS text_md5 FROM documents")
def nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat("text", F.lit(" " + _COMPATIBLE))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.nfkc(marked)).alias("text_md5"))


@query("lower_text", "SELECT doc_id, md5(lower(text)) AS text_md5 FROM documents")
def lower_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.lower_text(F.col("text"))).alias("text_md5"))


@query("clean_text", _pages_sql(clean_sql("html")))
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, tx.clean_text)


@query("clean_text_cased", _pages_sql(clean_cased_sql("html")))
def clean_text_cased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir, tx.clean_text_cased)


def _listed(spark: SparkSession, sf_dir: str, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Names of several tables, each of a kind: ``(name, kind)``."""
    tables = [table(spark, sf_dir, source).select(F.col(name).alias("name"), F.lit(kind).alias("kind")) for kind, (source, name) in kinds.items()]
    return tables[0].unionByName(tables[1])


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, {"GPE": ("nation", "n_name"), "LOC": ("region", "r_name")})


def _re2(pattern: str) -> str:
    """The pattern without look-behind and possessive repetition, which only spare work in Java."""
    return pattern.replace("(?<![0-9])", "").replace("++", "+").replace("?+", "?")


def mask_sql(x: str) -> str:
    for kind, pattern in entities.RULES:
        x = f"regexp_replace({x}, '{_re2(pattern)}', '[{kind}]', 'g')"
    for kind, name, source in (("GPE", "n_name", "nation"), ("LOC", "r_name", "region")):
        names = f"(SELECT '\\b(?:' || string_agg(lower({name}), '|' ORDER BY length({name}) DESC, {name}) || ')\\b' FROM {source})"
        x = f"regexp_replace({x}, {names}, '[{kind}]', 'g')"
    return x


def masked_sql(x: str) -> str:
    return f"CASE WHEN length({x}) >= 10 THEN {mask_sql(x)} ELSE {x} END"


@query("mask_entities", f"SELECT doc_id, md5({masked_sql('t')}) AS text_md5, length({masked_sql('t')}) AS n FROM (SELECT doc_id, {clean_sql('text')} AS t FROM ({ENTITIES_SQL}))")
def mask_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = documents_with_entities(spark, sf_dir).select("doc_id", tx.clean_text(F.col("text")).alias("t"))
    masked = names.mask_names(cleaned, gazetteer(spark, sf_dir), "doc_id", "t")
    return masked.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n"))


_MARKERS = "|".join(fixed.TOPIC_MARKERS)
_TOPIC_RE = f"(?:^|{BLANK_SQL})(?:{_MARKERS}){BLANK_SQL}+({NOT_BLANK_SQL}+)"
_PERSON_RE = f"[A-Z][a-z]+(?:{BLANK_SQL}+[A-Z][a-z]+)?"
TOPIC_SQL = f"coalesce(nullif(regexp_extract(lower(text), '{_TOPIC_RE}', 1), ''), '{fixed.DEFAULT_TOPIC}')"
PERSON_SQL = f"coalesce(nullif(regexp_extract(text, '{_PERSON_RE}', 0), ''), '{fixed.DEFAULT_PERSON}')"
CLAIM_SQL = "text[1:50] || '...'"


@query("topic_keyword", f"SELECT doc_id, {TOPIC_SQL} AS topic FROM documents")
def topic_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.topic_keyword(F.col("text")).alias("topic"))


@query("person_keyword", f"SELECT doc_id, {PERSON_SQL} AS person FROM documents")
def person_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.person_keyword(F.col("text")).alias("person"))


SLOTS_SQL = {
    "topic": TOPIC_SQL,
    "person": PERSON_SQL,
    "claim": CLAIM_SQL,
    **{name: quoted(value) for name, value in fixed.CONSTANT_SLOTS.items()},
}


@query("keyword_slots", "SELECT doc_id, " + ", ".join(f"{sql} AS {name}" for name, sql in SLOTS_SQL.items()) + " FROM documents")
def keyword_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = tx.keyword_slots(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(name) for name, c in slots.items()])


def fill_sql(template: str, slots: dict[str, str]) -> str:
    parts = []
    for literal, slot, _, _ in Formatter().parse(template):
        parts += [quoted(literal)] if literal else []
        parts += [slots[slot]] if slot is not None else []
    return " || ".join(parts)


def case_sql(per_label: dict[str, str], default: str, label: str = "label") -> str:
    whens = " ".join(f"WHEN {quoted(name)} THEN {value}" for name, value in per_label.items())
    return f"CASE {label} {whens} ELSE {default} END"


BUCKET_SQL = "CASE {} ELSE {} END".format(
    " ".join(f"WHEN confidence > {bound} THEN {quoted(text)}" for bound, text in fixed.CONFIDENCE_TEXTS),
    quoted(fixed.LOW_CONFIDENCE_TEXT),
)


def explanation_sql(label: str = "label") -> str:
    filled = {
        name: f"{fill_sql(template, SLOTS_SQL)} || {BUCKET_SQL} || chr(10) || chr(10) || {quoted(example)}"
        for name, (template, example) in fixed.EXPLANATIONS.items()
    }
    return case_sql(filled, filled[fixed.FALLBACK_LABEL], label)


EXPLANATION_SQL = explanation_sql()

# Two labels more than there are, one of them unknown to every template.
_ANY_LABEL = [*fixed.CANONICAL_LABELS, "red_herring", "default"]


@query(
    "template_explanation",
    f"SELECT doc_id, label, {EXPLANATION_SQL} AS explanation FROM (SELECT * REPLACE ({pick_sql(_ANY_LABEL)} AS label) FROM ({CANONICAL_SQL}))",
)
def template_explanation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = canonical_documents(spark, sf_dir).withColumn("label", pick(_ANY_LABEL))
    explained = explain.template_explanation(F.col("text"), F.col("label"), F.col("confidence"))
    return labelled.select("doc_id", "label", explained.alias("explanation"))


@query("confidence_bucket", f"SELECT doc_id, {BUCKET_SQL} AS bucket FROM ({CANONICAL_SQL})")
def confidence_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_documents(spark, sf_dir).select("doc_id", explain.confidence_bucket(F.col("confidence")).alias("bucket"))


DISPLAY_SQL = case_sql({n: quoted(n.replace("_", " ").title()) for n in _ANY_LABEL}, "''")


@query("display_label", f"SELECT doc_id, {DISPLAY_SQL} AS display FROM ({CANONICAL_SQL})")
def display_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_documents(spark, sf_dir).select("doc_id", explain.display_label(F.col("label")).alias("display"))


def _names_sql(name: str, source: str) -> str:
    return f"(SELECT '(?i)\\b(?:' || string_agg({name}, '|' ORDER BY length({name}) DESC, {name}) || ')\\b' FROM {source})"


CONCEPTS_SQL = f"""SELECT *,
  regexp_extract_all(text, '{_PERSON_RE}')[1:2] AS persons0,
  regexp_extract_all(text, {_names_sql('r_name', 'region')})[1:2] AS organizations,
  regexp_extract_all(text, {_names_sql('n_name', 'nation')})[1:2] AS locations,
  regexp_extract_all(text, '(?i){entities.DATE}')[1:1] AS dates,
  list_transform(list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'),
    lambda s: trim(regexp_replace(s, '{BLANK_SQL}+', ' ', 'g'))), lambda s: s <> '')[1:2], lambda s: s[1:100]) AS clauses,
  regexp_extract_all(lower(text), '{_TOPIC_RE}', 1)[1:2] AS topics0
FROM ({ENTITIES_SQL})"""
CONCEPTS_SQL = f"""SELECT *, CASE WHEN len(persons0) > 0 THEN persons0 ELSE ['{fixed.DEFAULT_PERSON}'] END AS persons,
  CASE WHEN len(topics0) > 0 THEN topics0 ELSE ['{fixed.DEFAULT_TOPIC}'] END AS topics FROM ({CONCEPTS_SQL})"""
_CONCEPT_LISTS = ["persons", "organizations", "locations", "dates", "clauses", "topics"]


def concept_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions stand in for organizations, nations are the places."""
    return _listed(spark, sf_dir, {"ORG": ("region", "r_name"), "GPE": ("nation", "n_name")})


def documents_with_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.concepts_with_names(documents_with_entities(spark, sf_dir), concept_names(spark, sf_dir), "doc_id")


@query(
    "extract_concepts",
    "SELECT doc_id, " + ", ".join(f"array_to_string({c}, '|') AS {c}" for c in _CONCEPT_LISTS) + f", 1 AS count FROM ({CONCEPTS_SQL})",
)
def extract_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_with_concepts(spark, sf_dir).select(
        "doc_id", *[F.array_join(f"concepts.{c}", "|").alias(c) for c in _CONCEPT_LISTS], "concepts.count"
    )


_ALTERNATIVES: list[str | None] = [*fixed.CANONICAL_LABELS[3:], None, *fixed.CANONICAL_LABELS[:3], "bandwagon"]
_CONTRAST_SLOTS_SQL = {
    "fallacy": case_sql({n: quoted(n.replace("_", " ").title()) for n in _ANY_LABEL}, "''"),
    "alt_fallacy": f"coalesce(replace(alt, '_', ' '), {quoted(fixed.CONTRAST_NO_ALTERNATIVE)})",
    "person": f"coalesce(persons[1], {quoted(fixed.CONTRAST_FALLBACKS['person'])})",
    "topic": f"coalesce(topics[1], {quoted(fixed.CONTRAST_FALLBACKS['topic'])})",
    "event_a": f"coalesce(clauses[1][1:50], {quoted(fixed.CONTRAST_FALLBACKS['event_a'])})",
    "event_b": f"coalesce(clauses[2][1:50], {quoted(fixed.CONTRAST_FALLBACKS['event_b'])})",
    "option_a": f"coalesce(topics[1], {quoted(fixed.CONTRAST_FALLBACKS['option_a'])})",
    "option_b": f"coalesce(topics[2], {quoted(fixed.CONTRAST_FALLBACKS['option_b'])})",
    "group": f"coalesce(organizations[1], {quoted(fixed.CONTRAST_FALLBACKS['group'])})",
    "term": f"coalesce(topics[1][1:30], {quoted(fixed.CONTRAST_FALLBACKS['term'])})",
    "emotion_topic": f"coalesce(topics[1], {quoted(fixed.CONTRAST_FALLBACKS['emotion_topic'])})",
    "claim": f"coalesce(clauses[1][1:50], {quoted(fixed.CONTRAST_FALLBACKS['claim'])})",
    **{name: quoted(value) for name, value in fixed.CONTRAST_CONSTANTS.items()},
}
CONTRAST_SQL = case_sql(
    {name: fill_sql(t, _CONTRAST_SLOTS_SQL) for name, t in fixed.CONTRASTS.items()},
    fill_sql(fixed.CONTRAST_DEFAULT, _CONTRAST_SLOTS_SQL),
)


@query(
    "contrastive_explanation",
    f"SELECT doc_id, {CONTRAST_SQL} AS explanation FROM (SELECT *, {pick_sql(fixed.CANONICAL_LABELS)} AS label, {pick_sql(_ALTERNATIVES)} AS alt FROM ({CONCEPTS_SQL}))",
)
def contrastive_explanation(spark: SparkSession, sf_dir: str) -> DataFrame:
    explained = explain.contrastive_explanation(pick(fixed.CANONICAL_LABELS), pick(_ALTERNATIVES), F.col("concepts"))
    return documents_with_concepts(spark, sf_dir).select("doc_id", explained.alias("explanation"))


_ALT_SQL = case_sql({k: quoted(v) for k, v in fixed.ALTERNATIVE_DESCRIPTIONS.items()}, quoted(fixed.ALTERNATIVE_DESCRIPTION_DEFAULT))
_STANDARD_SQL = case_sql({k: quoted(v) for k, v in fixed.STANDARD_EXPLANATIONS.items()}, quoted(fixed.STANDARD_EXPLANATION_DEFAULT))


@query("alt_description", f"SELECT doc_id, {_ALT_SQL} AS description FROM ({CANONICAL_SQL})")
def alt_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_documents(spark, sf_dir).select("doc_id", explain.alt_description(F.col("label")).alias("description"))


@query("standard_explanation", f"SELECT doc_id, {_STANDARD_SQL} AS explanation FROM ({CANONICAL_SQL})")
def standard_explanation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_documents(spark, sf_dir).select("doc_id", explain.standard_explanation(F.col("label")).alias("explanation"))


@query("encoder_prefix", "SELECT doc_id, md5('passage: ' || text) AS passage_md5, md5('query: ' || text) AS query_md5 FROM documents")
def encoder_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(tx.encoder_prefix(text, fixed.PASSAGE_PREFIX)).alias("passage_md5"),
        F.md5(tx.encoder_prefix(text, fixed.QUERY_PREFIX)).alias("query_md5"),
    )


@query(
    "mask_tokens",
    rf"""SELECT doc_id, regexp_matches(text, '\[MSK\d+\]') AS has_mask,
    len(regexp_extract_all(text, '(?i)\[MSK\d+\]|<MSK\d+>')) AS n_any,
    array_to_string(regexp_extract_all(text, '\[MSK\d+\]|<MSK\d+>'), ',') AS tokens FROM ({MASKS_SQL})""",
)
def mask_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return documents_with_masks(spark, sf_dir).select(
        "doc_id",
        tx.has_mask(text).alias("has_mask"),
        tx.count_masks(text, angle=True, any_case=True).cast("long").alias("n_any"),
        F.array_join(tx.mask_tokens(text, angle=True), ",").alias("tokens"),
    )


TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')"


@query(
    "tokenize_words",
    f"""SELECT doc_id, len(list_filter(string_split_regex(text, '{BLANK_SQL}+'), lambda w: w <> '')) AS n_words,
    len({TOKENS_SQL}) AS n_tokens, md5(array_to_string({TOKENS_SQL}, ' ')) AS tokens_md5 FROM documents""",
)
def tokenize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tx.word_tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(tx.words(F.col("text"))).cast("long").alias("n_words"),
        F.size(tokens).cast("long").alias("n_tokens"),
        F.md5(F.array_join(tokens, " ")).alias("tokens_md5"),
    )


# --- user functions ------------------------------------------------------------------------------


@query("map_texts", "SELECT doc_id, length(text) - length(replace(text, 'e', '')) AS n_e FROM documents")
def map_all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_texts(documents, lambda t: t.count("e"), out="n_e", returns="long").select("doc_id", "n_e")


def _load_counter():
    """Stands for a model that is expensive to load."""
    import re

    word = re.compile(r"[^\W_]{2,}")
    return lambda t: len(word.findall(t))


@query("map_with_setup", r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}]{2,}')) AS n_found FROM documents")
def map_texts_with_setup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_with_setup(documents, _load_counter, out="n_found", returns="long").select("doc_id", "n_found")
