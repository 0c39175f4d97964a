"""BPE as a streaming transducer: ids leave as soon as no later symbol can change them.

Rules apply in the order of the merge list. Take two texts that share a beginning, and the last token
border up to which their tokens agree so far. A rule moves that border only by merging across it, to
the left by the length of its left part; the next rule that moves it has a higher number and a right part
that begins with a token grown from that left part. The heaviest such chain, found in one pass over the rules,
bounds how far a border can move at all: the sufficient lookahead. Tokens that end that many symbols
before the last one read are final, and what follows them is tokenized as if it stood alone. So a piece
of any length needs a window of bounded size. Decoding feeds the tokens' bytes to an incremental
UTF-8 decoder, which holds the at most three bytes of an unfinished character.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from argulith.llm.bpe import byte_characters
from argulith.llm.common import query, slices, spare, table, with_text_columns

TOKENIZER = "word_bpe_49k.json"
BLOCK = 1 << 16  # characters that are split into pieces at a time
LONG = 256  # pieces beyond this many characters are streamed and not remembered
PIECES = 400_000  # pieces whose ids a task remembers; it forgets them all when it has more

BLANKS = " \t\n\v\f\r"


class Rules:
    """A merge list over bytes with a mark at the end of a word, and its sufficient lookahead."""

    def __init__(self, spec: dict) -> None:
        model, added = spec["model"], spec["added_tokens"]
        plain = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
        other = [k for k, v in plain.items() if model.get(k, v) not in (v, "")]
        flags = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if other or flags or not model["end_of_word_suffix"]:
            raise ValueError(f"not a plain list of merges with word ends: {other or flags or 'no word ends'}")
        self.end = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        character = byte_characters()
        self.inner = [vocabulary[c] for c in character]
        self.last = [vocabulary[c + self.end] for c in character]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.added = {t["content"]: t["id"] for t in added}
        self.tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.lookahead = sufficient_lookahead([*self.inner, *self.last], self.merges)


def sufficient_lookahead(symbols: list[int], merges: list[tuple[int, int, int]]) -> int:
    """Symbols after a token's end that decide whether it is final, for any text.

    The parts of a rule must come from earlier rules; then applying rules in order and taking
    the lowest, leftmost pair each time are the same. Other lists are an error.
    """
    length = dict.fromkeys(symbols, 1)
    starts = {s: frozenset([s]) for s in symbols}  # the token itself and all it grew from at its left end
    heaviest: dict[int, int] = {}  # by left part: the longest way of a border that ends with such a rule
    seen = set()
    for left, right, made in merges:
        if left not in length or right not in length or (left, right) in seen:
            raise ValueError("a merge uses what only a later merge makes, or stands twice")
        seen.add((left, right))
        way = length[left] + max(heaviest.get(s, 0) for s in starts[right])
        heaviest[left] = max(heaviest.get(left, 0), way)
        length[made] = length[left] + length[right]
        starts[made] = starts.get(made, frozenset([made])) | starts[left]
    return max(heaviest.values(), default=0)


class Transducer:
    """Symbols of one piece in, final ids out; holds a window of bounded length."""

    def __init__(self, rules: Rules) -> None:
        self.rules = rules
        self.pairs = {(a, b): rank for rank, (a, b, _) in enumerate(rules.merges)}
        self.made = [made for _, _, made in rules.merges]
        self.window: list[int] = []
        self.held: int | None = None  # the last byte: it may be the end of the word
        self.full = 2 * rules.lookahead + 64

    def feed(self, data: bytes) -> Iterator[int]:
        """Ids that the bytes read so far make final."""
        for byte in data:
            if self.held is not None:
                self.window.append(self.rules.inner[self.held])
                if len(self.window) >= self.full:
                    yield from self._settled()
            self.held = byte

    def finish(self) -> list[int]:
        """The other ids of the piece; the transducer is ready for the next one."""
        symbols = self.window
        if self.held is not None:
            symbols.append(self.rules.last[self.held])
        self.window, self.held = [], None
        return self._merge_few(symbols) if len(symbols) < 64 else [token for token, _ in self._merge(symbols)]

    def whole(self, data: bytes) -> list[int]:
        """The ids of one complete piece; one that fits the window is all of it at once."""
        if len(data) >= self.full:
            return [*self.feed(data), *self.finish()]
        self.window, self.held = [self.rules.inner[byte] for byte in data[:-1]], data[-1]
        return self.finish()

    def _settled(self) -> list[int]:
        ends, out = len(self.window) - self.rules.lookahead, []
        used = 0
        for token, size in self._merge(self.window):
            if used + size > ends:
                break
            out.append(token)
            used += size
        self.window = self.window[used:]
        return out

    def _merge(self, symbols: list[int]) -> list[tuple[int, int]]:
        """Tokens of a window and how many symbols each covers: always the lowest, leftmost pair."""
        pairs, count = self.pairs, len(symbols)
        token: list[int] = [*symbols, -1, -1]  # the last ones stand behind the end and before the start
        after, before = list(range(1, count + 1)), list(range(-1, count))
        heap = [(pairs[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            other = after[at] if token[at] >= 0 else count
            if pairs.get((token[at], token[other])) != rank:
                continue
            token[at], token[other] = made, _ = self.made[rank], -1
            after[at] = behind = after[other]
            before[behind] = at
            if (found := pairs.get((made, token[behind]))) is not None:
                heapq.heappush(heap, (found, at))
            if (found := pairs.get((token[before[at]], made))) is not None:
                heapq.heappush(heap, (found, before[at]))
        return [(t, after[i] - i) for i, t in enumerate(token[:count]) if t >= 0]

    def _merge_few(self, symbols: list[int]) -> list[int]:
        """The tokens alone, faster than with a heap while there are few symbols."""
        rank, none = self.pairs.get, len(self.made)
        ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) < none:
            at = ranks.index(least)
            symbols[at : at + 2] = [made] = [self.made[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((symbols[at - 1], made), none)
            if at < len(ranks):
                ranks[at] = rank((made, symbols[at + 1]), none)
        return symbols


# Where a run without blanks may be cut. Both sides of these cuts are normalized by themselves, and
# the pieces beside the cut are parts of one: as many letters (or signs) as precede it are in no added
# token and no contraction. Scripts with joining marks are not cut: such a run is one part.
RUN = 24
CUTS = re.compile(
    rf"(?<=[A-Za-zぁ-ゖァ-ヺ一-鿿]{{{RUN}}})(?=[A-Za-zぁ-ゖァ-ヺ一-鿿])"
    rf"|(?<=[!\"#%()*,\-./:;=?@\[\\\]_{{}}~]{{{RUN}}})(?=[!\"#%()*,\-./:;=?@\[\\\]_{{}}~])"
)


# Characters whose classes are the same in every version of Unicode that a regex library may follow.
SETTLED = re.compile("[ -~\xa0-\u024f\u0400-\u04ff\u2010-\u2027\u20ac\u3001\u3002\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]*")

Entry = tuple[tuple[int, ...], bytes, bytes, bytes]  # ids; in decimal; the tokens; their own bytes


class Streamer:
    """Texts to ids, in one task: blocks to pieces, pieces through the transducer.

    Blocks are normalized by the library. It also splits them, unless all their characters are
    settled: then the file's pattern alone does, several times as fast. Every different short piece goes
    through the transducer once and is looked up after that.
    """

    def __init__(self, spec: dict) -> None:
        import regex
        from tokenizers import Tokenizer

        self.rules = Rules(spec)
        if self.rules.added and max(map(len, self.rules.added)) > RUN:
            raise ValueError(f"an added token has more than {RUN} characters")
        bare = spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        front = Tokenizer.from_str(json.dumps(bare))
        self.normal, self.pieces = front.normalizer, front.pre_tokenizer
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.pattern = None
        if [t["type"] for t in steps] == ["Split", "ByteLevel"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]:
            if (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True) and "Regex" in steps[0]["pattern"]:
                self.pattern = regex.compile(steps[0]["pattern"]["Regex"], regex.V0).findall
        self.byte = {c: b for b, c in enumerate(byte_characters())}
        self.transducer = Transducer(self.rules)
        self.words = re.compile(f"[^{BLANKS}]+").findall
        added = "|".join(map(re.escape, sorted(self.rules.added, key=len, reverse=True)))
        self.split = re.compile(f"({added})").split if added else lambda part: [part]
        self.seen: dict[str, Entry] = {}
        self.decimal = {i: str(i).encode() for i in self.rules.tokens}
        self.shown = {i: t.encode() for i, t in self.rules.tokens.items()}
        end = self.rules.end
        self.raw = {
            i: t.encode() if t in self.rules.added
            else bytes(self.byte[c] for c in t.removesuffix(end)) + b" " * t.endswith(end)
            for i, t in self.rules.tokens.items()
        }

    def blocks(self, text: str) -> Iterator[str]:
        """Parts of a text that end before a blank; a part is longer than a block only if a word is."""
        at, size = 0, len(text)
        while size - at > BLOCK:
            cut = max(text.rfind(b, at + 1, at + BLOCK) for b in BLANKS)
            if cut < 0:
                cut = min((c for b in BLANKS if (c := text.find(b, at + BLOCK)) >= 0), default=size)
            yield text[at:cut]
            at = cut
        yield text[at:]

    def cut(self, part: str) -> list[str]:
        """The pieces of a part without added tokens."""
        if self.normal:
            part = self.normal.normalize_str(part)
        if self.pattern and SETTLED.fullmatch(part):
            return self.pattern(part)
        byte = self.byte.__getitem__
        return [bytes(map(byte, piece)).decode() for piece, _ in self.pieces.pre_tokenize_str(part)]

    def entry(self, ids: tuple[int, ...]) -> Entry:
        return (
            ids,
            b" ".join(map(self.decimal.__getitem__, ids)),
            b" ".join(map(self.shown.__getitem__, ids)),
            b"".join(map(self.raw.__getitem__, ids)),
        )

    def piece(self, piece: str) -> Entry:
        """A piece that has not been seen yet; a long one is put together from what the transducer emits."""
        made = self.entry(tuple(self.transducer.whole(piece.encode())))
        if len(piece) <= LONG:
            if len(self.seen) >= PIECES:
                self.seen.clear()
            self.seen[piece] = made
        return made

    def entries(self, text: str | None) -> Iterator[list[Entry]]:
        """The ids of a text, a block at a time."""
        for block in self.blocks(text or ""):
            if len(block) > BLOCK:
                for word in self.words(block):
                    for section in self.split(word):
                        yield from self.section(section)
                continue
            for section in self.split(block):
                if section in self.rules.added:
                    yield [self.entry((self.rules.added[section],))]
                elif section:
                    seen = self.seen.get
                    yield [seen(p) or self.piece(p) for p in self.cut(section)]

    def section(self, section: str) -> Iterator[list[Entry]]:
        """The same for a run without blanks of any length, part by part; a piece may go on in the next part."""
        if section in self.rules.added:
            yield [self.entry((self.rules.added[section],))]
            return
        ahead, waiting = 0, False
        while ahead < len(section):
            cut = len(section)
            if cut - ahead > 2 * LONG:
                found = CUTS.search(section, ahead + LONG)
                cut = found.start() if found else cut
            for n, piece in enumerate(self.cut(section[ahead:cut])):
                if n and waiting:
                    yield [self.entry(tuple(self.transducer.finish()))]
                waiting = True
                if ids := tuple(self.transducer.feed(piece.encode())):
                    yield [self.entry(ids)]
            ahead = cut
        if waiting:
            yield [self.entry(tuple(self.transducer.finish()))]

    def ids(self, text: str | None) -> Iterator[tuple[int, ...]]:
        """The ids of a text, some at a time."""
        for entries in self.entries(text):
            for entry in entries:
                yield entry[0]


def _spec(path: str | None) -> dict:
    import public_tokenizers

    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return json.load(file)


def encode(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) of every whole text, as the tokenizers library gives them.

    ``path`` names a tokenizer file of byte-level merges with word ends, without a post-processor;
    it is read by the driver. Added tokens in a text are found as the library finds them. A null text
    counts as empty, an empty text has no ids. Repeated rows are encoded one by one, an empty table gives
    no rows, texts are whole. Clashing column names: the new one gets underscores.
    """
    spec = _spec(path)
    Rules(spec)  # unsuitable files stop here, not in a task
    out = StructType([StructField(spare("ids", df.columns), ArrayType(IntegerType(), False), False)])
    held: list[Streamer] = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.append(Streamer(spec))
        rows = [[i for part in held[0].ids(t) for i in part] for t in texts]
        return [pa.array(rows, pa.list_(pa.int32()))]

    return with_text_columns(df, text, out, run, limit=2 << 20)


def decode(df: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the library's text for the ids, and ``plain``, what they spell.

    The file has no decoder of its own, so ``decoded`` is the tokens with blanks between them, special ones
    included; ``plain`` is their bytes read as UTF-8 with a blank after each word. Bytes that are no
    UTF-8 become U+FFFD. Null ids and ids outside the vocabulary are left out, as the library
    does; null arrays give null, empty ones empty texts. Repeated rows and empty tables as in ``encode``.
    """
    spec = _spec(path)
    if spec.get("decoder"):
        raise ValueError("files with a decoder of their own are not supported")
    at = df.columns.index(ids)
    schema = StructType([*df.schema.fields])
    for name in ("decoded", "plain"):
        schema = schema.add(spare(name, df.columns), "string")
    held: list[Streamer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Streamer(spec))
        tokens, raw = held[0].rules.tokens, held[0].raw
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                shown, plain = [], []
                for row in part.column(at).to_pylist():
                    known = None if row is None else [i for i in row if i in tokens]
                    shown.append(None if known is None else " ".join(map(tokens.__getitem__, known)))
                    plain.append(None if known is None else "".join(spelled(map(raw.__getitem__, known))))
                made = [pa.array(shown, pa.string()), pa.array(plain, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)

    return df.mapInArrow(run, schema)


def spelled(parts: Iterator[bytes]) -> Iterator[str]:
    """Text of a stream of bytes; a character leaves when its last byte has come."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        yield machine.decode(part)
    yield machine.decode(b"", True)


def digests(streamer: Streamer, text: str | None) -> tuple[int, str, str, str]:
    """Number of a text's ids and digests of them, of the tokens and of what they spell, block by block."""
    numbers, decoded, plain, count, between = sha256(), sha256(), sha256(), 0, b""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for entries in streamer.entries(text):
        if entries:
            ids, shown, tokens, raw = zip(*entries)
            count += sum(map(len, ids))
            numbers.update(between + b" ".join(shown))
            decoded.update(between + b" ".join(tokens))
            plain.update(machine.decode(b"".join(raw)).encode())
            between = b" "
    plain.update(machine.decode(b"", True).encode())
    return count, numbers.hexdigest(), decoded.hexdigest(), plain.hexdigest()


def round_trip(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and the SHA-256 of a text's ids, of ``decoded`` and of ``plain``.

    The same as ``encode`` and ``decode``, but ids and decoded parts are hashed as they leave the
    transducer and kept nowhere, so memory does not grow with a text's ids. Ids are decimal with a blank
    between. Nulls, empty and repeated rows as in ``encode``.
    """
    spec = _spec(path)
    Rules(spec)
    if spec.get("decoder"):
        raise ValueError("files with a decoder of their own are not supported")
    kinds = {"n_tokens": LongType(), "ids_sha256": StringType(), "decoded_sha256": StringType(), "plain_sha256": StringType()}
    out = StructType([StructField(spare(n, df.columns), k, False) for n, k in kinds.items()])
    held: list[Streamer] = []

    def run(texts: list) -> list[pa.Array]:
        if not held:
            held.append(Streamer(spec))
        columns = list(zip(*(digests(held[0], t) for t in texts))) or [()] * 4
        return [pa.array(c, pa.int64() if n == 0 else pa.string()) for n, c in enumerate(columns)]

    return with_text_columns(df, text, out, run, limit=2 << 20)


@query("op13_stream_bpe")
def op13_stream_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document through the streaming transducer and back; digests of both."""
    done = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "plain_sha256")
