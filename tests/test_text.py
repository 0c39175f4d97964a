import re
import time
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from argulith.functions import text as tx


def column(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", function(F.col("t")).alias("r")).orderBy("i").collect()]


def python_clean(text):
    text = re.sub(r"<[^>]+>", " ", text or "")
    text = re.sub(r"https?://\S+|www\.\S+", " ", text)
    return unicodedata.normalize("NFKC", " ".join(text.split()))


EDGES = [
    None,
    "",
    "   ",
    "<p>Hello</p>\n\tWorld &amp; <br/>more",
    "see https://example.org/a?b=c, and www.example.org now",
    "HTTPS://UPPER.example stays",
    "no break em\x1funit\x85next",
    "ﬁne Ｔｅｘｔ ① ½",
    "ideographic　blank and Ａ",
    "a < b > c",
    "<unclosed tag",
    "emoji 😀 and ünïcödé ẞ İ",
]


def test_clean_text_cased_follows_python(spark):
    assert column(spark, EDGES, tx.clean_text_cased) == [python_clean(t) for t in EDGES]


def test_clean_text_is_lower_case(spark):
    assert column(spark, EDGES, tx.clean_text) == [python_clean(t).lower() for t in EDGES]


def test_tags_follow_python(spark):
    texts = ["a<b>c", "<>x", "<a<b>c", "a>b<c", "<<x>>", "no tags", "", None, "<i>😀</i> é > <u", "x<y z"]
    assert column(spark, texts, tx.strip_html) == [t and re.sub(r"<[^>]+>", " ", t) for t in texts]


def test_junk_texts_take_linear_time(spark):
    from argulith.functions.entities import mask_entities

    junk = ["<" * 400_000, "1" * 400_000, "1." * 200_000, " " * 400_000, "<a" * 200_000 + ">", "Aa " * 130_000]
    started = time.time()
    cleaned = column(spark, junk, lambda c: F.length(mask_entities(tx.clean_text(c))))
    assert cleaned[0] == cleaned[1] == 400_000 and cleaned[3] == 0
    assert time.time() - started < 20


def test_blanks_that_nfkc_makes_are_kept(spark):
    # NFKC comes after the blanks are collapsed; U+FDFA contains blanks once normalised.
    assert column(spark, ["ﷺ"], tx.clean_text_cased)[0].count(" ") == 3


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=60), min_size=20, max_size=40))
def test_cleaning_follows_python_on_any_text(spark, texts):
    assert column(spark, texts, tx.clean_text_cased) == [python_clean(t) for t in texts]


def test_min_length_is_strict_and_counts_code_points(spark):
    kept = column(spark, ["x" * 50, "x" * 51, "😀" * 51, "😀" * 50], lambda c: tx.longer_than(c, 50))
    assert kept == [False, True, True, False]


def test_truncate_counts_code_points(spark):
    assert column(spark, ["😀" * 60], lambda c: tx.truncate_text(c, 50, "...")) == ["😀" * 50 + "..."]
    assert column(spark, ["short"], lambda c: tx.truncate_text(c, 50, "...")) == ["short..."]


def python_topic(text):
    words = text.lower().split()
    found = [words[i + 1] for i, w in enumerate(words) if w in ("about", "regarding", "concerning", "on") and i + 1 < len(words)]
    return found[0] if found else "the issue"


def python_person(text):
    found = re.findall(r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?", text)
    return found[0] if found else "the speaker"


KEYWORD_TEXTS = [
    "Talk ABOUT Climate change",
    "about",
    "about on x",
    "on everything else",
    "roundabout way; based onto",
    "nothing here",
    "McDonald and Mary\nSmith",
    "ALL CAPS",
    "é Ünal Émile Zola",
    "",
]


def test_keywords_follow_python(spark):
    assert column(spark, KEYWORD_TEXTS, tx.topic_keyword) == [python_topic(t) for t in KEYWORD_TEXTS]
    assert column(spark, KEYWORD_TEXTS, tx.person_keyword) == [python_person(t) for t in KEYWORD_TEXTS]


def test_tokens_follow_python(spark):
    texts = ["The cat's a_b c 12 3", "été über 中文 字", "", "x"]
    assert column(spark, texts, tx.word_tokens) == [re.findall(r"(?u)\b\w\w+\b", t.lower()) for t in texts]
    assert column(spark, ["  a  b\x1fc "], tx.words) == [["a", "b", "c"]]


def test_mask_tokens(spark):
    texts = ["[MSK1] and [msk2]", "<MSK3> [MSK]", "none"]
    assert column(spark, texts, tx.has_mask) == [True, False, False]
    assert column(spark, texts, lambda c: tx.mask_tokens(c, angle=True, any_case=True)) == [["[MSK1]", "[msk2]"], ["<MSK3>"], []]
    assert column(spark, texts, lambda c: tx.count_masks(c, any_case=True)) == [2, 0, 0]


def test_nfkc_holds_few_texts_as_strings(monkeypatch):
    """A batch of long texts is normalised piece by piece; pieces of ASCII alone are never taken apart."""
    import pyarrow as pa

    from argulith.functions import text as tx

    taken = []

    class Seen:
        @staticmethod
        def normalize(form, text):
            taken.append(text)
            return unicodedata.normalize(form, text)

    import unicodedata

    monkeypatch.setattr(tx, "unicodedata", Seen)
    texts = ["plain"] * 600 + ["\ufb01ne", None, "\u2460"] + ["plain"] * 600
    got = tx._nfkc.func(pa.array(texts)).to_pylist()
    assert got == ["plain"] * 600 + ["fine", None, "1"] + ["plain"] * 600
    assert len(taken) <= 2 * tx._HELD
    assert tx._nfkc.func(pa.array([None, None], pa.string())).to_pylist() == [None, None]
    assert tx._nfkc.func(pa.array([], pa.string())).to_pylist() == []
