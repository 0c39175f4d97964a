"""Licence scans: an Aho-Corasick automaton for tags and notices, a parser for licence expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from argulith.llm.common import query, spare, table, with_text_columns

# The phrases of the contract and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices beyond the contract's, in the words of the licences themselves.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}

TAG = "spdx license identifier"

# How freely a text under the licence may be used, from 0 (not) to 1 (without conditions to speak of).
FREEDOM = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "cc0": 1.0,
    "public-domain": 1.0, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl-2": 0.4,
    "gpl-3": 0.4, "agpl": 0.3, "cc-by-nc": 0.1, "cc-by-nd": 0.1, "reserved": 0.0,
}
UNKNOWN = 0.2  # a licence that has a name but is not in the table
EXCEPTION = 0.2  # what an exception adds to its licence

TAGGED = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[()]|(?<=[a-z0-9.+)])/(?=[a-z0-9(])|[a-z0-9.+:-]+")
# Everything but a-z, 0-9 and bytes from 128 on separates words.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 0x20 for b in range(256))
STRENGTH = {"or": 1, "and": 2, "with": 3}


def family(name: str) -> str:
    """The label of a licence identifier: the longest known label that begins it, else itself."""
    known = [label for label in FREEDOM if name == label or name.startswith((label + "-", label + "."))]
    return max(known, key=len, default=name)


@dataclass(frozen=True)
class Terms:
    """What an expression comes to: its licences, and how freely it lets the text be used."""

    labels: frozenset[str]
    freedom: float


def evaluate(expression: str) -> Terms | None:
    """A licence expression in lower case, or None if it is none.

    Shunting yard: ``with`` binds more tightly than ``and``, ``and`` more than ``or``. Under ``and``
    the stricter side counts, under ``or`` the freer one; an exception loosens its licence.
    """
    output: list = []
    waiting: list[str] = []

    def apply(operator: str) -> bool:
        if len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        if operator == "with":
            output.append(Terms(left.labels, min(1.0, left.freedom + EXCEPTION)))
        else:
            pick = min if operator == "and" else max
            output.append(Terms(left.labels | right.labels, pick(left.freedom, right.freedom)))
        return True

    operand_next = True
    for token in TOKEN.findall(expression):
        token = "or" if token == "/" else token  # as in mit/apache-2.0
        if token in STRENGTH:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[token]:
                if not apply(waiting.pop()):
                    return None
            waiting.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break  # the expression has ended, prose follows
            waiting.append(token)
        elif token == ")":
            if operand_next:
                return None
            if "(" not in waiting:
                break  # it closes a bracket of the prose around the expression
            while waiting[-1] != "(":
                if not apply(waiting.pop()):
                    return None
            waiting.pop()
        else:
            if not operand_next:
                break  # the expression has ended, prose follows
            label = family(token.rstrip("+"))
            output.append(Terms(frozenset([label]), FREEDOM.get(label, UNKNOWN)))
            operand_next = False
    while waiting:
        if waiting[-1] == "(" or not apply(waiting.pop()):
            return None
    return output[0] if len(output) == 1 and not operand_next else None


def automaton(phrases: list[str]):
    """Finds every phrase between single blanks, overlaps included."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: str | None, finder, base: dict[str, str], notices: dict[str, str]) -> tuple:
    """(words, base places, first, last, base labels, labels, score, starts, phrases) of one text."""
    lowered = (text or "").encode().lower()
    words = lowered.translate(WORD_BYTES).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    # An automaton reports matches by their ends; a phrase's first word is counted from its start.
    places = sorted((end - len(phrase) - 1, phrase) for end, phrase in finder.iter(line)) if words else []
    starts, at, seen = [], 0, 0
    for start, _ in places:
        seen += line.count(" ", at, start)
        at = start
        starts.append(seen)
    based = [(s, p) for s, (_, p) in zip(starts, places) if p in base]
    labels = {base[p] for _, p in based}
    own = {notices[p] for _, p in places if p in notices}
    terms = []
    if any(p == TAG for _, p in places):
        terms = [t for t in map(evaluate, TAGGED.findall(lowered.decode("utf-8"))) if t]
    every = labels | own | {label for t in terms for label in t.labels}
    plain = [FREEDOM.get(label, UNKNOWN) for label in labels | own]
    score = min(plain + [t.freedom for t in terms], default=0.0)
    return (
        len(words),
        len(based),
        min((s for s, _ in based), default=None),
        max((s for s, _ in based), default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(every)),
        score,
        starts,
        [p for _, p in places],
    )


def scan_licenses(
    df: DataFrame, text: str = "text", base: dict[str, str] | None = None, notices: dict[str, str] | None = None
) -> DataFrame:
    """``df`` with what its whole texts say about their licences.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``, ``base_labels``: places and labels of the
    base phrases (null places if there are none); ``labels``: with the notices' and the tags'
    licences; ``score``: 0 if no terms are found, else how freely the strictest terms let the text
    be used; ``starts`` and ``phrases``: all places found. Labels are distinct, sorted and joined by
    commas. A tag whose expression cannot be parsed adds nothing. A null text counts as empty;
    repeated rows are scanned each; an empty table gives no rows. Clashing column names: the new ones
    get underscores.
    """
    base = dict(BASE if base is None else base)
    notices = {p: label for p, label in (NOTICES if notices is None else notices).items() if p not in base}
    kinds = {
        "n_words": LongType(), "n_base": LongType(), "first_word": LongType(), "last_word": LongType(),
        "base_labels": StringType(), "labels": StringType(), "score": DoubleType(),
        "starts": ArrayType(LongType()), "phrases": ArrayType(StringType()),
    }
    arrow = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.int64()), pa.list_(pa.string())]
    fields = StructType([StructField(spare(n, df.columns), kind) for n, kind in kinds.items()])
    held: list = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.append(automaton([*base, *notices, TAG]))
        columns = list(zip(*[scan(t, held[0], base, notices) for t in texts])) or [()] * len(arrow)
        return [pa.array(list(c), kind) for c, kind in zip(columns, arrow)]

    return with_text_columns(df, text, fields, run)


@query("op10_license_scan")
def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every whole document."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "starts", "phrases")
