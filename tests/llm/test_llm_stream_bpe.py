"""The streaming BPE transducer against the tokenizers library."""

import random
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from argulith.llm import stream_bpe as sb

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"),
    (6, "é　日本語 'll 'S 12 ３４ \U0001f600‍ x y\r\n\r\n  z"), (7, "word " * 30_000), (8, "x" * 40_000), (9, "中文" * 9_000),
    (10, "a<|endoftext|>b <|startoftext|> <|endof" + "-" * 5_000 + "'s"),
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(sb.TOKENIZER))


@pytest.fixture(scope="module")
def streamer():
    return sb.Streamer(sb._spec(None))


def ids(streamer, text):
    return [i for part in streamer.ids(text) for i in part]


def expected(library, text):
    found = library.encode(text or "", add_special_tokens=False).ids
    return found, library.decode(found, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_the_library_s(streamer, library, text):
    assert ids(streamer, text) == expected(library, text)[0]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abhtΣς İé́각ᆨ '.<|>0\x1c\x85 -", max_size=120))
def test_ids_are_the_library_s_at_awkward_places(streamer, library, text):
    assert ids(streamer, text) == expected(library, text)[0]


def test_long_runs_stream_and_stay_right(streamer, library):
    draw = random.Random(7)
    parts = [t.removesuffix("</w>") for t in streamer.rules.tokens.values() if t.removesuffix("</w>").isalpha() and t.isascii()]
    runs = ["".join(draw.choice(parts) for _ in range(2_000)), "".join(draw.choice("aeiourstln") for _ in range(9_000))]
    for text in [*runs, "ab" * 7_000, "=-" * 7_000, "a" * 9_001, runs[0] + "'s" + runs[1]]:
        assert ids(streamer, text) == expected(library, text)[0]


def test_the_window_is_bounded(streamer):
    machine, widest = sb.Transducer(streamer.rules), 0
    for _ in range(20):
        list(machine.feed(b"straightforwardly" * 50))
        widest = max(widest, len(machine.window))
    assert widest < machine.full
    machine.finish()


def test_lookahead_of_small_lists():
    assert sb.sufficient_lookahead([0, 1], []) == 0
    assert sb.sufficient_lookahead([0, 1], [(0, 1, 2)]) == 1
    # 1+2 then 0+1: a 2 behind takes the 1 away from the 0, which moves the border by one symbol and one more.
    assert sb.sufficient_lookahead([0, 1, 2], [(1, 2, 3), (0, 1, 4)]) == 2
    with pytest.raises(ValueError):
        sb.sufficient_lookahead([0, 1], [(2, 0, 3), (0, 1, 2)])


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_emitted_tokens_are_final_for_random_merge_lists(data):
    """Small random lists: every prefix's settled tokens begin the tokens of the whole."""
    symbols, merges = list(range(3)), []
    for made in range(3, 3 + data.draw(st.integers(1, 8))):
        pair = (data.draw(st.sampled_from(symbols)), data.draw(st.sampled_from(symbols)))
        if pair not in {m[:2] for m in merges}:
            merges.append((*pair, made))
            symbols.append(made)

    class Small:
        lookahead, inner, last = sb.sufficient_lookahead([0, 1, 2], merges), [0, 1, 2], [0, 1, 2]

    Small.merges = merges
    text = bytes(data.draw(st.lists(st.integers(0, 2), min_size=1, max_size=60)))
    whole = sb.Transducer(Small)
    whole.full = 10**9
    assert not list(whole.feed(text))
    eager = sb.Transducer(Small)
    eager.full = Small.lookahead + 1
    assert [*eager.feed(text), *eager.finish()] == whole.finish()


def test_encode_decode_and_digests(spark, library):
    frame = spark.createDataFrame(ODD, "doc_id long, text string")
    for name in ("ids", "decoded", "n_tokens", "plain"):
        frame = frame.withColumn(name, F.lit("own"))
    rows = sb.decode(sb.encode(frame).withColumnRenamed("_ids", "made"), ids="made").collect()
    digests = {(r.doc_id, r.text): r for r in sb.round_trip(frame).collect()}
    assert len(rows) == len(ODD)
    for row in rows:
        found, decoded = expected(library, row.text)
        assert row.made == found and row["_decoded"] == decoded and row.ids == row.decoded == "own"
        digest = digests[row.doc_id, row.text]
        assert digest["_n_tokens"] == len(found)
        assert digest.ids_sha256 == sha256(" ".join(map(str, found)).encode()).hexdigest()
        assert digest.decoded_sha256 == sha256(decoded.encode()).hexdigest()
        assert digest.plain_sha256 == sha256(row["_plain"].encode()).hexdigest()


def test_plain_text_comes_back(spark):
    frame = spark.createDataFrame([(["x"], "Hello  Wörld 日本 \U0001f600")], "own array<string>, text string")
    assert sb.decode(sb.encode(frame)).first().plain == "hello wörld 日本 \U0001f600 "


def test_unknown_and_missing_ids(spark):
    frame = spark.createDataFrame([([320, None, 99_999_999],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in sb.decode(frame).collect()] == ["a</w>", None, ""]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sb.round_trip(empty).count() == 0 and sb.decode(sb.encode(empty)).count() == 0


def test_query_is_the_library_s(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sb.op13_stream_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found, decoded = expected(library, texts[row.doc_id])
        assert (row.n_tokens, row.decoded_sha256) == (len(found), sha256(decoded.encode()).hexdigest())
        assert row.ids_sha256 == sha256(" ".join(map(str, found)).encode()).hexdigest()
