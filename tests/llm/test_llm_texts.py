"""BPE, SimHash, line dedup and licence scans against other libraries and brute force."""

import re

import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from argulith.llm import bpe, licenses, line_dedup, simhash
from argulith.llm.components import components

DOC = "doc_id long, text string"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"),
    (6, "é　日本語 'll 'S 12 ３４ \U0001f600‍ x y\r\n\r\n  z"), (7, "word " * 30_000), (8, "x" * 40_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns with the operators' own names."""
    frame = spark.createDataFrame(ODD, DOC)
    for name in ("ids", "fingerprint", "removed", "labels", "score", "_row", "_doc", "bytes"):
        frame = frame.withColumn(name, F.lit("own"))
    return frame


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path(bpe.RANKS))


@pytest.fixture(scope="module")
def reference_encoder(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    import public_tokenizers

    return bpe.Codec(bpe.tokenizer_json(ranks), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_ids_are_those_of_the_rank_library(codec, reference_encoder, text):
    assert codec.ids(text).tolist() == reference_encoder.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab e=-\n\t'é", max_size=200))
def test_runs_of_few_characters(codec, reference_encoder, text):
    assert codec.ids(text).tolist() == reference_encoder.encode_ordinary(text)
    assert codec.bytes(codec.ids(text).tolist()) == text.encode()


def test_the_split_knows_every_character(codec, reference_encoder):
    for first in range(0, 0x110000, 0x400):
        text = " ".join(f"a{chr(c)}b1{chr(c)}2" for c in range(first, first + 0x400) if not 0xD800 <= c < 0xE000)
        assert codec.ids(text).tolist() == reference_encoder.encode_ordinary(text), hex(first)


def test_encode_and_decode_odd_tables(spark, odd, ranks, reference_encoder):
    import public_tokenizers

    done = bpe.decode(bpe.encode(odd, ranks, public_tokenizers.PATTERN, offsets=True), ranks, "_ids").toPandas()
    assert list(done.columns) == [*odd.columns, "_ids", "starts", "_bytes", "decoded"]
    for _, row in done.iterrows():
        text = row["text"] or ""
        assert list(row["_ids"]) == reference_encoder.encode_ordinary(text)
        assert row["decoded"] == text and bytes(row["_bytes"]) == text.encode()
        if text:
            _, starts = reference_encoder.decode_with_offsets(list(row["_ids"]))
            assert list(row["starts"]) == starts
    empty = bpe.encode(spark.createDataFrame([], DOC), ranks, public_tokenizers.PATTERN)
    assert bpe.decode(empty, ranks).collect() == []


def test_split_characters_and_broken_bytes(spark, ranks):
    smile = "\U0001f600".encode()
    pieces = [ranks[smile[i : i + 1]] for i in range(4)]
    table = spark.createDataFrame([(pieces,), (pieces[:2],), (None,), ([],)], "ids array<int>")
    done = bpe.decode(table, ranks).toPandas()
    assert done["decoded"][0] == "\U0001f600" and "�" in done["decoded"][1]
    assert bytes(done["bytes"][1]) == smile[:2] and done["decoded"][2] is None and done["decoded"][3] == ""


def test_op2_digests(spark, sf_dir, reference_encoder):
    import hashlib
    import struct

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = bpe.op2_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference_encoder.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


# --- SimHash -------------------------------------------------------------------------------------


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict) -> dict:
    root = {i: i for i in prints}
    ids = sorted(prints)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_op4_equals_all_pairs(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(prints)
    rows = simhash.op4_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == roots


@pytest.mark.parametrize("max_bits, segments", [(2, 2), (3, 2), (3, 4), (2, 4)])
def test_near_fingerprints_lose_no_pair(spark, max_bits, segments):
    import random

    random.seed(max_bits * 10 + segments)
    seeds = [random.getrandbits(64) for _ in range(20)]
    values = {s ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 4))) for s in seeds for _ in range(10)}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {frozenset(r) for r in simhash.near_fingerprints(frame, max_bits, segments).collect()}
    expected = {
        frozenset((a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits
    }
    assert got == expected


def test_simhash_odd_tables(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    prints = {i: plain_fingerprint(t) for i, t in ODD if i is not None}
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    roots = plain_components(prints)
    assert all(r["fingerprint"] == signed[r["doc_id"]] and r["component_id"] == roots[r["doc_id"]] for r in rows if r["doc_id"])
    assert next(r["component_id"] for r in rows if r["doc_id"] is None) == 5
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))
    empty = spark.createDataFrame([], DOC)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []
    nameless = simhash.keep_one(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "q r s t")], DOC))
    assert sorted(r["text"] for r in nameless.collect()) == ["a b c", "q r s t"]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1_000, 1_000 + i) for i in range(1, 50)]
    odd_ones = [(5_000, 5_000), (7, 7), (None, 3), (2_001, 2_000), (2_000, 2_001), (2_000, 2_001)]
    edges = spark.createDataFrame([*chain, *star, *odd_ones], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    expected = {i: 0 for i in range(61)} | {1_000 + i: 1_000 for i in range(50)} | {2_000: 2_000, 2_001: 2_000}
    assert roots == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- Line dedup ----------------------------------------------------------------------------------


def plain_dedup(rows: list[tuple]) -> list[tuple]:
    """Rows with unique keys, in key order."""
    first, gone = {}, {}
    for key, text in sorted(rows):
        lines = text.split("\n") if text is not None else []
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if all(re.fullmatch(r"[\x20\x09-\x0D]*", line) for line in window):
                continue
            if first.setdefault(window, (key, at)) != (key, at):
                gone.setdefault(key, set()).update((at, at + 1, at + 2))
    out = []
    for key, text in rows:
        lost = gone.get(key, set())
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)
        out.append((key, kept, sorted(lost)))
    return out


def test_dedup_lines_equals_brute_force(spark):
    import random

    random.seed(3)
    rows = [(i, "\n".join(random.choice("abc ") for _ in range(random.randint(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "x\n" * 3_000), (104, "x\nx"), (105, "q\r\nr\ns\nq\r\nr\ns")]
    got = [(r["doc_id"], r["text"], r["removed"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOC)).collect()]
    assert sorted(got, key=lambda r: r[0]) == sorted(plain_dedup(rows), key=lambda r: r[0])


def test_line_dedup_odd_tables(spark, odd):
    passage = "one\ntwo\nthree"
    more = spark.createDataFrame([(9, passage), (9, passage), (10, f"a\n{passage}\nb"), (None, passage)], DOC)
    table = odd.unionByName(more, allowMissingColumns=True)
    done = line_dedup.dedup_lines(table)
    assert done.columns == [*table.columns, "_removed"]
    got = [(r["doc_id"], r["text"]) for r in done.collect()]
    assert len(got) == len(ODD) + 4
    assert got.count((9, passage)) == 2 and (10, "a\nb") in got and (None, "") in got
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOC)).collect() == []


def test_copies_without_a_key_lose_their_lines(spark):
    passage = "one\ntwo\nthree"
    rows = [(None, passage)] * 5 + [(None, f"{passage}\nfour")] * 2 + [(None, None)] * 2 + [(None, "x\ny")] * 2
    got = [r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOC).repartition(4)).collect()]
    assert len(got) == len(rows) and got.count(None) == 2 and got.count("x\ny") == 2
    lines = [line for text in got if text is not None for line in text.split("\n")]
    assert lines.count("one") == lines.count("two") == lines.count("three") == 1
    with_key = [r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame([(1, passage), *rows], DOC)).collect()]
    assert with_key.count(passage) == 1


# --- Licences ------------------------------------------------------------------------------------


def test_op10_equals_plain_counting(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = licenses.op10_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[row["doc_id"]] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [
            (i, label)
            for phrase, label in licenses.BASE.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((i for i, _ in places), default=None)
        assert row["last_word"] == max((i for i, _ in places), default=None)
        base = {label for _, label in places}
        assert row["base_labels"] == ",".join(sorted(base))
        assert base <= set(row["labels"].split(",")) | {""} and 0 <= row["score"] <= 1


@pytest.mark.parametrize(
    "expression, labels, freedom",
    [
        ("mit", {"mit"}, 1.0),
        ("mit or gpl-3.0-only and cc-by-nc-4.0", {"mit", "gpl-3", "cc-by-nc"}, 1.0),
        ("(mit or gpl-3.0-only) and cc-by-nc-4.0", {"mit", "gpl-3", "cc-by-nc"}, 0.1),
        ("gpl-2.0 with classpath-exception-2.0 and apache-2.0", {"gpl-2", "apache-2"}, 0.6),
        ("apache-2.0+ see the file", {"apache-2"}, 1.0),
        ("made-up-9", {"made-up-9"}, 0.2),
        ("mit)", {"mit"}, 1.0),
        ("(mit and gpl-3.0-only)) or so", {"mit", "gpl-3"}, 0.4),
        ("mit/apache-2.0 // file", {"mit", "apache-2"}, 1.0),
    ],
)
def test_expressions(expression, labels, freedom):
    terms = licenses.evaluate(expression)
    assert terms.labels == labels and terms.freedom == pytest.approx(freedom)


@pytest.mark.parametrize("expression", ["", "and mit", "mit or", "mit or)", "(mit", "()", ")", "mit with"])
def test_what_is_no_expression(expression):
    assert licenses.evaluate(expression) is None


def test_licences_odd_tables(spark, odd):
    more = [
        (20, "Under the MIT licence. Under  the\nMIT-license! CC BY-NC under the mit license"),
        (21, "// SPDX-License-Identifier: (MIT OR GPL-3.0-only)\nApache License, Version 2"),
        (22, "xunder the mit license"),
    ]
    table = odd.unionByName(spark.createDataFrame(more, DOC), allowMissingColumns=True)
    done = licenses.scan_licenses(table)
    assert done.columns == [*table.columns, "n_words", "n_base", "first_word", "last_word", "base_labels", "_labels", "_score", "starts", "phrases"]
    rows = {r["doc_id"]: r for r in done.collect()}
    assert (rows[20]["n_base"], rows[20]["first_word"], rows[20]["last_word"]) == (3, 4, 11)
    assert rows[20]["base_labels"] == "cc-by-nc,mit" and rows[20]["_score"] == 0.1
    assert rows[21]["base_labels"] == "apache-2" and rows[21]["_labels"] == "apache-2,gpl-3,mit"
    assert rows[22]["n_base"] == 0 and rows[22]["first_word"] is None and rows[22]["_score"] == 0.0
    assert (rows[1]["n_words"], rows[2]["n_words"], rows[7]["n_words"], rows[8]["n_words"]) == (0, 0, 30_000, 1)
    assert licenses.scan_licenses(spark.createDataFrame([], DOC)).collect() == []
    assert pd.notna(rows[6]["n_words"])
