"""Byte-level BPE with the tokenizers library: ids, offsets, and back to bytes.

A rank file names byte strings. The library wants printable characters and merges, so every byte
gets a character (the usual byte table) and every rank is split into the two parts that merging by
rank leaves last. Texts are split by the pattern, each piece is encoded by the library once per
task and looked up after that.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from argulith.llm.common import query, spare, table, with_text_columns

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = 100_000  # encoded pieces that a task remembers; it forgets them all when it has more
LONG_PIECE = 64  # longer pieces are not remembered


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string to id, from a file of ``base64 rank`` lines: 50,000 lines, read by the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two parts that are left of a token when only lower ranks have been merged."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
        at = min(range(len(pairs)), key=pairs.__getitem__)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A byte-level BPE model of the library for these ranks, as the library writes it."""
    from tokenizers import Tokenizer, models

    character = byte_characters()

    def shown(token: bytes) -> str:
        return "".join(character[b] for b in token)

    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            parts = last_parts(token, ranks)
            if max(ranks.get(p, len(ranks)) for p in parts) < ranks[token]:
                merges.append((shown(parts[0]), shown(parts[1])))
    model = models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    return Tokenizer(model).to_str()


class Codec:
    """Texts to ids and back, in one task."""

    def __init__(self, model_json: str, pattern: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model_json).model
        character = byte_characters()
        self.table = dict(enumerate(character))
        self.split = regex.compile(pattern, regex.V0).findall
        self.seen: dict[str, list[int]] = {}
        byte = {c: b for b, c in enumerate(character)}
        vocabulary = json.loads(model_json)["model"]["vocab"]
        self.tokens = {rank: bytes(byte[c] for c in token) for token, rank in vocabulary.items()}

    def piece(self, piece: str) -> list[int]:
        shown = piece.encode().decode("latin-1").translate(self.table)
        return [token.id for token in self.model.tokenize(shown)]

    def ids(self, text: str | None) -> np.ndarray:
        seen, out = self.seen, array("i")
        for piece in self.split(text) if text else ():
            found = seen.get(piece)
            if found is None:
                found = array("i", self.piece(piece))
                if len(piece) <= LONG_PIECE:
                    if len(seen) >= PIECES:
                        seen.clear()
                    seen[piece] = found
            out += found
        return np.frombuffer(out, dtype=np.int32) if out else np.empty(0, dtype=np.int32)

    def bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def character_starts(text: str, lengths: np.ndarray) -> np.ndarray:
    """First character that each token touches, from the tokens' lengths in bytes."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # continuation bytes belong to the character before
    first = np.cumsum(lengths) - lengths
    return character[first].astype(np.int32)


def encode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", offsets: bool = False
) -> DataFrame:
    """``df`` with ``ids`` (array of int) of every whole text, without special tokens.

    Each match of ``pattern`` is encoded by itself. ``offsets`` adds ``starts``: the first character
    that each token touches; tokens that share a character have the same start. A null text counts
    as empty; an empty text has no ids. Repeated rows are encoded one by one, an empty table gives no
    rows, and very long texts are whole. Clashing column names: the new ones get underscores.
    """
    model = tokenizer_json(ranks)
    sizes = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int32)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    fields = [StructField(spare("ids", df.columns), ArrayType(IntegerType(), False), False)]
    if offsets:
        fields.append(StructField(spare("starts", df.columns), ArrayType(IntegerType(), False), False))
    held: list[Codec] = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.append(Codec(model, pattern))
        ids = [held[0].ids(t) for t in texts]
        made = [_lists(ids)]
        if offsets:
            made.append(_lists([character_starts(t or "", sizes[i]) for t, i in zip(texts, ids)]))
        return made

    return with_text_columns(df, text, StructType(fields), run, limit=2 << 20)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``df`` with ``bytes``, what the ids stand for, and ``decoded``, the same as text.

    Tokens' characters are turned back into bytes and joined before they are read as UTF-8, so a
    character whose bytes are split over tokens comes out whole; bytes that are no UTF-8 become
    U+FFFD in ``decoded`` only. Null ids give null, no ids give nothing; an id outside the
    vocabulary, or a null among the ids, is an error.
    """
    model = tokenizer_json(ranks)
    at = df.columns.index(ids)
    names = [spare("bytes", df.columns), spare("decoded", df.columns)]
    schema = StructType([*df.schema.fields]).add(names[0], "binary").add(names[1], "string")
    held: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Codec(model, ""))
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows = [None if i is None else held[0].bytes(i) for i in part.column(at).to_pylist()]
                texts = [None if r is None else r.decode("utf-8", "replace") for r in rows]
                made = [pa.array(rows, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` and the SHA-256 of the ids and of what they decode to, in lowercase hex.

    The same as ``encode`` and ``decode`` one after the other, in one pass with one worker per task.
    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over
    the decoded bytes.
    """
    model = tokenizer_json(ranks)
    kinds = {"ids": ArrayType(IntegerType(), False), "ids_sha256": StringType(), "decoded_sha256": StringType()}
    fields = [StructField(spare(name, df.columns), kind, False) for name, kind in kinds.items()]
    held: list[Codec] = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.append(Codec(model, pattern))
        ids = [held[0].ids(t) for t in texts]
        packed = [sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids]
        decoded = [sha256(held[0].bytes(i.tolist())).hexdigest() for i in ids]
        return [_lists(ids), pa.array(packed, pa.string()), pa.array(decoded, pa.string())]

    return with_text_columns(df, text, StructType(fields), run, limit=2 << 20)


def token_digests(documents: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document."""
    import public_tokenizers

    ranks = read_ranks(ranks_path or public_tokenizers.path(RANKS))
    done = round_trip(documents.select("doc_id", "text"), ranks, pattern or public_tokenizers.PATTERN)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256", "ids")


@query("op2_byte_bpe")
def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded; digests of both."""
    return token_digests(table(spark, sf_dir, "documents")).drop("ids")
