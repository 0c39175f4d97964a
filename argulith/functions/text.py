"""Column functions on texts. All of them run in the JVM except NFKC."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argulith import fixed_values as fixed

# Java's \s is ASCII without (?U), and even then lacks U+001C..U+001F.
BLANK = r"[\s\x1c-\x1f]"
NOT_BLANK = r"[^\s\x1c-\x1f]"


def null_text_to_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def longer_than(text: Column, n: int = 50) -> Column:
    """More than ``n`` code points."""
    return F.length(text) > n


def truncate_text(text: Column, n: int, tail: str = "") -> Column:
    """The first ``n`` code points, with ``tail`` always appended."""
    head = F.substring(text, 1, n)
    return F.concat(head, F.lit(tail)) if tail else head


def strip_html(text: Column) -> Column:
    """Tags become a blank.

    Only the part up to the last ``>`` is searched, where every tag is closed: behind it each ``<``
    would be followed to the end of the text in vain.
    """
    rest = F.substring_index(text, ">", -1)
    closed = F.substr(text, F.lit(1), F.length(text) - F.length(rest))
    return F.concat(F.regexp_replace(closed, "<[^>]+>", " "), rest)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)https?://{NOT_BLANK}+|www\.{NOT_BLANK}+", " ")


def collapse_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"(?U){BLANK}+", " "))


_HELD = 256  # texts that stand as Python strings at a time


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    done = []
    for at in range(0, len(texts), _HELD):
        some = texts.slice(at, _HELD)
        if not pc.all(pc.string_is_ascii(some)).as_py() and some.null_count < len(some):  # ASCII is its own normal form
            some = pa.array([t if t is None else unicodedata.normalize("NFKC", t) for t in some.to_pylist()], texts.type)
        done.append(some)
    return pa.concat_arrays(done) if done else texts


def nfkc(text: Column) -> Column:
    """Unicode NFKC; Spark has no such function, hence the Arrow batches."""
    return _nfkc(text)


def lower_text(text: Column) -> Column:
    return F.lower(text)


def clean_text_cased(text: Column, normalise: bool = True) -> Column:
    """Tags, URLs and runs of blanks out, then NFKC; null becomes empty.

    ``normalise=False`` keeps the whole expression in the JVM, for texts known to be in NFKC.
    """
    blank_free = collapse_ws(strip_urls(strip_html(null_text_to_empty(text))))
    return nfkc(blank_free) if normalise else blank_free


def clean_text(text: Column, normalise: bool = True) -> Column:
    return lower_text(clean_text_cased(text, normalise))


def words(text: Column) -> Column:
    """Pieces between blanks."""
    return F.filter(F.split(text, rf"(?U){BLANK}+"), lambda w: w != "")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w\w+)"), F.lit(1))


def _or_default(found: Column, default: str) -> Column:
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


_TOPIC = rf"(?U)(?:^|{BLANK})(?:{'|'.join(fixed.TOPIC_MARKERS)}){BLANK}+({NOT_BLANK}+)"
_PERSON = rf"(?U)[A-Z][a-z]+(?:{BLANK}+[A-Z][a-z]+)?"


def topic_keyword(text: Column) -> Column:
    """The word after the first topic marker, lower-cased."""
    return _or_default(F.regexp_extract(F.lower(text), _TOPIC, 1), fixed.DEFAULT_TOPIC)


def topic_keywords(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TOPIC), F.lit(1))


def person_keyword(text: Column) -> Column:
    """The first one or two capitalised words."""
    return _or_default(F.regexp_extract(text, _PERSON, 0), fixed.DEFAULT_PERSON)


def person_keywords(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PERSON), F.lit(0))


def keyword_slots(text: Column) -> dict[str, Column]:
    """All slots that an explanation template may name."""
    return {
        "topic": topic_keyword(text),
        "person": person_keyword(text),
        "claim": truncate_text(text, 50, "..."),
        **{name: F.lit(value) for name, value in fixed.CONSTANT_SLOTS.items()},
    }


def encoder_prefix(text: Column, prefix: str = fixed.PASSAGE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), text)


def mask_pattern(angle: bool = False, any_case: bool = False) -> str:
    """``[MSKn]`` tokens; optionally ``<MSKn>`` too, optionally in any case."""
    body = r"\[MSK\d+\]|<MSK\d+>" if angle else r"\[MSK\d+\]"
    return f"(?i){body}" if any_case else body


def has_mask(text: Column, **options: bool) -> Column:
    return text.rlike(mask_pattern(**options))


def mask_tokens(text: Column, **options: bool) -> Column:
    return F.regexp_extract_all(text, F.lit(mask_pattern(**options)), F.lit(0))


def count_masks(text: Column, **options: bool) -> Column:
    return F.regexp_count(text, F.lit(mask_pattern(**options)))
