"""Least repairs of conversations: Viterbi over chunks that start from guessed cost vectors.

A row of a conversation is a 4 x 4 matrix over (min, +): from each state of the wanted role sequence to each
state behind the row. Backward costs are products of these matrices, and such products soon
have rank one: whatever vector a chunk starts from at its end, the vectors at its beginning differ only by
a constant. So all rows are numbered and cut into chunks of equal size, every chunk runs from a guess,
and the chunks whose guess is not parallel to what the next chunk found are run again, until none is left.
Differences within a vector are all that the trace needs. It runs forward in each chunk from every
state it may be entered in, and chains of chunks are put together by composing these maps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from argulith.llm.common import query, table
from argulith.session import stage

CHUNK = 4_096  # rows of a chunk
BLANK = " \t\n\x0b\x0c\r"

# The wanted role initials, (s?(ua)+)?: nothing read, s read, u read, a read. Nothing and a may end.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the one role that may be inserted or given
ROLES = {"u": "user", "a": "assistant"}
CLASSES = "sua-"
REROLE = INSERT = 2
DELETE = 3
Vector = tuple[int, int, int, int]
LAST: Vector = (0, 4, 2, 0)  # behind the last row: what must be inserted


class Costs:
    """Backward vectors and forward steps for row codes, each worked out once per task.

    A code is the class of the role (place in ``CLASSES``), plus 4 for a truncated row, plus 8 for one
    that has to go. Vectors are kept with minimum 0: there are few of them.
    """

    def __init__(self) -> None:
        self.vectors: dict[tuple[Vector, int], Vector] = {}
        self.steps: dict[tuple[int, int, Vector], tuple[str, int, int]] = {}

    @staticmethod
    def edits(state: int, code: int) -> list[tuple[str, int, int]]:
        """``(initial, state behind the row, cost)`` of what may be done with the row itself."""
        out = [("D", state, DELETE)]
        if code < 8:
            extra = code >> 2 & 1
            kept = NEXT.get((state, CLASSES[code & 3]))
            if kept is not None:
                out.append(("K", kept, extra))
            out.append(("R", NEXT[state, WANTED[state]], REROLE + extra))
        return out

    def _costs(self, after: Vector, code: int) -> list[int]:
        best = [min(cost + after[to] for _, to, cost in self.edits(state, code)) for state in range(4)]
        for _ in range(3):  # three insertions at most reach any state
            best = [min(best[s], INSERT + best[NEXT[s, WANTED[s]]]) for s in range(4)]
        return best

    def before(self, after: Vector, code: int) -> Vector:
        """The vector before a row from the one behind it."""
        found = self.vectors.get((after, code))
        if found is None:
            best = self._costs(after, code)
            found = self.vectors[after, code] = tuple(b - min(best) for b in best)
        return found

    def step(self, state: int, code: int, after: Vector) -> tuple[str, int, int]:
        """The least edits up to and with a row: initials, state behind it, cost."""
        key = (state, code, after)
        if key not in self.steps:
            best, made, spent = self._costs(after, code), "", 0
            while not made or made[-1] == "I":
                ways = [("I", NEXT[state, WANTED[state]], INSERT, best[NEXT[state, WANTED[state]]])]
                ways += [(edit, to, cost, after[to]) for edit, to, cost in self.edits(state, code)]
                edit, state, cost, _ = min(w for w in ways if w[2] + w[3] == best[state])
                made, spent = made + edit, spent + cost
            self.steps[key] = made, state, spent
        return self.steps[key]

    def trace(self, state: int, codes: list[int], after: list[Vector]) -> tuple[str, int, int]:
        """The edits of consecutive rows from ``state`` on."""
        parts, spent = [], 0
        for code, vector in zip(codes, after):
            made, state, cost = self.step(state, code, vector)
            parts.append(made)
            spent += cost
        return "".join(parts), state, spent

    def behind(self, codes: list[int], last: Vector) -> list[Vector]:
        """The vector behind every row."""
        out = [last]
        for code in reversed(codes[1:]):
            out.append(self.before(out[-1], code))
        return out[::-1]


class Chunk:
    """One chunk's rows, cut into the conversations it holds, and whether the outer ones go on."""

    def __init__(self, block: int, rows: int, n: list[int], conv: list, code: list[int]) -> None:
        low = next((i for i, place in enumerate(n) if place // rows == block), len(n))
        high = next((i for i in range(len(n), low, -1) if n[i - 1] // rows == block), low)
        self.block, self.conv, self.code = block, conv, code
        cuts = [i for i in range(low, high) if i == low or conv[i] != conv[i - 1]] + [high]
        self.segments = list(zip(cuts, cuts[1:]))
        self.open_left = low < high and low > 0 and conv[low - 1] == conv[low]
        self.open_right = low < high < len(n) and conv[high] == conv[high - 1]

    def first_vector(self, costs: Costs, last: Vector, other: Vector | None = None) -> Vector | None:
        """The vector before the chunk's first row; None if the one from ``other`` is parallel to it."""
        low, high = self.segments[0]
        if len(self.segments) > 1 or not self.open_right:
            last = LAST
        for code in reversed(self.code[low:high]):
            if last == other:
                return None
            last = costs.before(last, code)
            other = None if other is None else costs.before(other, code)
        return None if last == other else last


def _chunks(batches: Iterator[pa.RecordBatch], rows: int, extra: tuple[str, ...] = ()) -> Iterator[tuple]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            chunk = Chunk(row["block"], rows, row["n"], row["conv"], row["code"])
            if chunk.segments:
                yield (chunk, *(row[e] for e in extra))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, gone)``: the rows of a test bed for repairs, damaged by a hash of their key.

    Of twenty hash values one drops the row (it stays as ``gone``, without texts), one empties its text, one takes
    its ``[.!?]``, one doubles it and one makes its role user. Null roles, texts and parts of the
    hashed key count as one space; conversations and turns stay null.
    """
    blank = F.lit(" ")
    as_text = [F.coalesce(F.col(c).cast("string"), blank) for c in (conv, turn, role, text)]
    fate = F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1])) % 20
    words = F.when(fate.isin(0, 1), "").when(fate == 2, F.translate(as_text[3], ".!?", "")).otherwise(as_text[3])
    made = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(fate == 4, "user").when(fate == 0, "").otherwise(as_text[2]).alias("role"),
        words.alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_again"),
    )
    return made.drop("_again")


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def _numbered(damaged: DataFrame) -> DataFrame:
    """``(n, conv, code, blank, duplicate, truncated)``: rows by conversation and turn, from 0 on."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANK))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = damaged.filter(~F.col("gone")).select(
        "conv",
        "turn",
        _digest().alias("digest"),
        F.monotonically_increasing_id().alias("rid"),
        kind.alias("kind"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    narrow = stage(narrow, "repair_rows")
    firsts = narrow.groupBy("conv", "digest").agg(F.min(F.struct("turn", "rid")).alias("first"))
    firsts = firsts.select(F.col("first.rid").alias("rid"), F.lit(True).alias("new"))
    keys = ["conv", "turn", "digest", "rid"]
    duplicate = ~F.col("blank") & F.col("new").isNull()
    truncated = ~F.col("blank") & F.col("new").isNotNull() & F.col("open")
    marked = narrow.join(firsts, "rid", "left").select(
        *keys, "kind", "blank", duplicate.alias("duplicate"), truncated.alias("truncated")
    )
    must = F.col("blank") | F.col("duplicate")
    code = (F.col("kind") + F.when(F.col("truncated"), 4).otherwise(0) + F.when(must, 8).otherwise(0)).cast("int")
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(ordered.select(F.monotonically_increasing_id().alias("at"), "conv", code.alias("code"), "blank", "duplicate", "truncated"), "repair_order")
    part = F.shiftright("at", 33)
    sizes = sorted((row[0], row[1]) for row in placed.groupBy(part).count().collect())  # a row per partition
    before = [(p, sum(s for _, s in sizes[:i])) for i, (p, _) in enumerate(sizes)]
    offsets = F.broadcast(damaged.sparkSession.createDataFrame(before, "part long, offset long"))
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    return placed.join(offsets, part == F.col("part")).select(
        (F.col("offset") + inside).alias("n"), "conv", "code", "blank", "duplicate", "truncated"
    )


def _blocks(numbered: DataFrame, rows: int) -> DataFrame:
    """``(block, n, conv, code)``: each chunk's rows, with the one before and the one behind it."""
    own, inside = F.floor(F.col("n") / rows), F.col("n") % rows
    to = [own, F.when(inside == rows - 1, own + 1), F.when((inside == 0) & (own > 0), own - 1)]
    spread = numbered.select(F.explode(F.array_compact(F.array(*to))).alias("block"), F.struct("n", "conv", "code").alias("row"))
    grouped = spread.groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return grouped.select("block", *(F.col(f"rows.{c}").alias(c) for c in ("n", "conv", "code")))


VECTORS = "block long, whole boolean, open_left boolean, open_right boolean, first array<int>, last array<int>"


def _vectors(blocks: DataFrame, rows: int) -> DataFrame:
    """Every chunk's first and last vector; on the way, chunks with a wrong guess are run again.

    A round repeats the chunks whose last vector is not parallel to the next one's first. Chunks forget their
    guess after a few rows, so one round is the rule, and never are there more than the longest
    conversation has chunks.
    """

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for chunk, in _chunks(batches, rows):
            first = chunk.first_vector(costs, LAST)
            flags = (len(chunk.segments) == 1, chunk.open_left, chunk.open_right)
            made = [[v] for v in (chunk.block, *flags, list(first), list(LAST))]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], names=names)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for chunk, first, last, wanted in _chunks(batches, rows, ("first", "last", "wanted")):
            found = chunk.first_vector(costs, tuple(wanted), tuple(last))
            flags = (len(chunk.segments) == 1, chunk.open_left, chunk.open_right)
            made = [[v] for v in (chunk.block, *flags, first if found is None else list(found), wanted)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], names=names)

    names = ["block", "whole", "open_left", "open_right", "first", "last"]
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    state = stage(blocks.mapInArrow(guess, VECTORS), "repair_vectors")
    while True:
        following = state.select((F.col("block") - 1).alias("block"), F.col("first").alias("wanted"))
        stale = state.filter("open_right").join(following, "block").filter(F.col("last") != F.col("wanted"))
        stale = stage(stale.select("block", "first", "last", "wanted"), "repair_stale")
        if stale.isEmpty():
            return state
        redone = blocks.join(stale, "block").mapInArrow(again, VECTORS)
        state = stage(state.join(stale, "block", "left_anti").unionByName(redone), "repair_vectors")


def _traces(blocks: DataFrame, vectors: DataFrame, rows: int, conv_type) -> DataFrame:
    """``(block, n, conv, audits, costs, exits, illegal, left, right)`` per conversation of a chunk.

    One audit, cost and exit for a conversation that begins here, else one for each state to enter in.
    """
    schema = StructType([StructField("block", LongType()), StructField("n", LongType()), StructField("conv", conv_type)])
    schema = schema.add("audits", ArrayType(StringType())).add("costs", ArrayType(LongType())).add("exits", ArrayType(IntegerType()))
    schema = schema.add("illegal", "long").add("left", "boolean").add("right", "boolean")
    legal = {(0, 1), (1, 2), (2, 1)}  # classes of neighbours su, ua, au

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for batch in batches:
            kind = batch.schema.field("conv").type.value_type
            kinds = [pa.int64(), pa.int64(), kind, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.bool_(), pa.bool_()]
            for chunk, last in _chunks(iter([batch]), rows, ("last",)):
                made = []
                for low, high in chunk.segments:
                    left = chunk.open_left and low == chunk.segments[0][0]
                    right = chunk.open_right and high == chunk.segments[-1][1]
                    codes = chunk.code[low:high]
                    after = costs.behind(codes, tuple(last) if right else LAST)
                    ways = [costs.trace(s, codes, after) for s in (range(4) if left else [START])]
                    if not right:
                        ways = [(audit + "I" * (LAST[s] // INSERT), s, spent + LAST[s]) for audit, s, spent in ways]
                    pairs = zip(chunk.code[low - left : high], chunk.code[low - left + 1 : high])
                    illegal = sum((a & 3, b & 3) not in legal for a, b in pairs)
                    audits, exits, spent = map(list, zip(*ways))
                    place = chunk.block * rows + low - chunk.segments[0][0]
                    made.append((chunk.block, place, chunk.conv[low], audits, spent, exits, illegal, left, right))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names=schema.names)

    return blocks.join(vectors.select("block", "last"), "block").mapInArrow(run, schema)


def _entries(traces: DataFrame) -> DataFrame:
    """``(block, entry)``: the state in which a chunk that continues a conversation is entered.

    The map of a chunk that is all one conversation is composed with the one before it, whose reach doubles
    each round; a map that does not depend on its entry ends the chain.
    """
    fixed = F.array_distinct("exits")
    links = traces.filter("right").select("block", F.when(F.size(fixed) == 1, fixed).otherwise(F.col("exits")).alias("exits"), (F.col("block") - 1).alias("back"))
    links = stage(links, "repair_links")
    while True:
        unsure = links.filter(F.size("exits") > 1)
        if unsure.isEmpty():
            return links.select((F.col("block") + 1).alias("block"), F.col("exits")[0].alias("entry"))
        earlier = links.select(F.col("block").alias("back"), F.col("exits").alias("entries"), F.col("back").alias("farther"))
        joined = unsure.join(earlier, "back").select(
            "block", F.transform("entries", lambda e: F.get(F.col("exits"), e)).alias("exits"), F.col("farther").alias("back")
        )
        one = F.array_distinct("exits")
        joined = joined.withColumn("exits", F.when(F.size(one) == 1, one).otherwise(F.col("exits")))
        links = stage(links.filter(F.size("exits") == 1).unionByName(joined), "repair_links")


PLAN = ["audit", "cost", "blank", "duplicate", "truncated", "illegal"]


def _plans(damaged: DataFrame, rows: int) -> DataFrame:
    """``(conv, n, audit, cost, blank, duplicate, truncated, illegal)``: the edits, a few thousand rows at a time."""
    numbered = _numbered(damaged)
    blocks = stage(_blocks(numbered, rows), "repair_blocks")
    traces = stage(_traces(blocks, _vectors(blocks, rows), rows, damaged.schema["conv"].dataType), "repair_traces")
    entered = traces.join(_entries(traces), "block", "left")
    at = F.when(F.col("left"), F.col("entry")).otherwise(0)
    edits = entered.select("conv", "n", F.get("audits", at).alias("audit"), F.get("costs", at).alias("cost"), "illegal")
    faults = numbered.groupBy("conv").agg(*(F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")))
    none = F.lit(0).cast("long")
    counted = faults.select("conv", F.lit(-1).cast("long").alias("n"), F.lit("").alias("audit"), none.alias("cost"), "blank", "duplicate", "truncated", none.alias("illegal"))
    return counted.unionByName(edits.select("conv", "n", "audit", "cost", *(none.alias(c) for c in ("blank", "duplicate", "truncated")), "illegal"))


def _stream(damaged: DataFrame, rows: int) -> DataFrame:
    """Each conversation's plans, then its rows in order, in one partition: to be read as a stream."""
    plans = _plans(damaged, rows)
    lines = damaged.select("conv", "turn", "role", "text", "gone", F.when(~F.col("gone"), _digest()).alias("digest"))
    both = plans.unionByName(lines, allowMissingColumns=True).withColumn("row", F.col("n").isNull())
    return both.repartition("conv").sortWithinPartitions("conv", "row", "n", F.col("gone").desc(), "turn", "digest")


class Notes:
    """What a digest of one conversation needs while its rows pass."""

    def __init__(self) -> None:
        self.hash, self.empty = sha256(), True
        self.first, self.last, self.turns = None, None, 0

    def turn(self, turn) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1

    def line(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False


class Replay:
    """One conversation's edits, applied to its rows as they come."""

    def __init__(self, conv) -> None:
        self.conv, self.parts, self.sums = conv, [], [0] * 5
        self.audit, self.at, self.state = None, 0, START
        self.notes = Notes()

    def plan(self, audit: str, sums: list[int]) -> None:
        self.parts.append(audit)
        self.sums = [a + b for a, b in zip(self.sums, sums)]

    def _edit(self) -> str:
        if self.audit is None:
            self.audit = "".join(self.parts)
        self.at += 1
        return self.audit[self.at - 1]

    def _given(self) -> str:
        initial = WANTED[self.state]
        self.state = NEXT[self.state, initial]
        return ROLES[initial]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)``: what is inserted before a row, then the row itself."""
        while (edit := self._edit()) == "I":
            yield "I", self._given(), ""
        if edit == "R":
            role = self._given()
        elif edit == "K":
            self.state = NEXT[self.state, role[:1]]
        yield edit, role, text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        """What is inserted behind the last row."""
        if self.audit is None:
            self.audit = "".join(self.parts)
        while self.at < len(self.audit):
            yield self._edit(), self._given(), ""


def _replayed(batches: Iterator[pa.RecordBatch], finish: Callable, take: Callable) -> Iterator:
    """Goes through a stream: ``take`` sees every edit, ``finish`` every conversation's end."""
    current: Replay | None = None
    names = ("conv", "row", "gone", "turn", "role", "text", *PLAN)
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        for conv, is_row, gone, turn, role, text, audit, *sums in zip(*columns):
            if current is None or conv != current.conv:
                if current is not None:
                    yield from finish(current)
                current = Replay(conv)
            if not is_row:
                current.plan(audit, sums)
            elif not gone:
                yield from take(current, turn, role, text)
    if current is not None:
        yield from finish(current)


def repair(damaged: DataFrame, rows: int = CHUNK) -> DataFrame:
    """The edits of all conversations, in order: ``(conv, step, edit, turn, role, text)``.

    ``damaged`` has the columns ``conv, turn, role, text`` (no nulls in role and text) and ``gone``; others are not
    read. ``edit`` is K, R, D or I; role and text are those after the edit; the repaired conversation is all
    but its deleted rows. Rows of one turn stand in the order of a digest of role and text, so repeated rows
    are neighbours and the result does not depend on how the table is stored; null turns come
    first, null conversations are one conversation, an empty table gives no rows.

    Chunks of ``rows`` rows bound what a task holds, however long a conversation is. Only this last step
    reads a conversation's rows one after the other, as a stream.
    """
    fields = {f.name: f for f in damaged.schema.fields}
    schema = StructType([fields["conv"]]).add("step", "long").add("edit", "string").add(fields["turn"]).add("role", "string").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kinds: list = []

        def take(current: Replay, turn, role: str, text: str) -> Iterator:
            for edit, new_role, new_text in current.row(role, text):
                yield current, edit, None if edit == "I" else turn, new_role, new_text

        def finish(current: Replay) -> Iterator:
            for edit, role, text in current.rest():
                yield current, edit, None, role, text

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.field("conv").type, batch.schema.field("turn").type]
                yield batch

        def packed() -> pa.RecordBatch:
            types = [kinds[0], pa.int64(), pa.string(), kinds[1], pa.string(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*held), types)]
            held.clear()
            return pa.RecordBatch.from_arrays(made, names=schema.names)

        step, before, size = 0, None, 0
        for current, edit, turn, role, text in _replayed(watched(), finish, take):
            step = step + 1 if current is before else 1
            before = current
            held.append((current.conv, step, edit, turn, role, text))
            size += len(text) + 64
            if size > 4 << 20:
                yield packed()
                size = 0
        if held:
            yield packed()

    return _stream(damaged, rows).mapInArrow(run, schema)


def repair_digests(damaged: DataFrame, rows: int = CHUNK) -> DataFrame:
    """One row per conversation: its faults, the least cost, the edits, and a digest of the repaired text.

    Columns ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, with rows and
    edge cases as in ``repair``. ``repaired_sha256`` is over ``role:text`` lines joined by newlines. A SHA-256
    has no parallel form: a conversation's texts pass one task, a row at a time; its audit is a character a row.
    """
    schema = StructType([damaged.schema["conv"]])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, LongType())
    schema = schema.add("audit", StringType()).add("repaired_sha256", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list = []

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.field("conv").type]
                yield batch

        def take(current: Replay, turn, role: str, text: str) -> Iterator:
            current.notes.turn(turn)
            for edit, new_role, new_text in current.row(role, text):
                if edit != "D":
                    current.notes.line(new_role, new_text)
            return iter(())

        def finish(current: Replay) -> Iterator:
            notes = current.notes
            for _, role, text in current.rest():
                notes.line(role, text)
            gaps = 0 if notes.first is None else notes.last - notes.first + 1 - notes.turns
            cost, blank, duplicate, truncated, illegal = current.sums
            yield current.conv, gaps, blank, duplicate, truncated, illegal, cost, current.audit, notes.hash.hexdigest()

        done: list[tuple] = []

        def packed() -> pa.RecordBatch:
            types = [kinds[0], *[pa.int64()] * 6, pa.string(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=schema.names)

        size = 0
        for row in _replayed(watched(), finish, take):
            done.append(row)
            size += len(row[7]) + 128
            if size > 4 << 20:
                yield packed()
                size = 0
        if done:
            yield packed()

    return _stream(damaged, rows).mapInArrow(run, schema)


@query("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation damaged by a hash and repaired at least cost."""
    done = repair_digests(damage(table(spark, sf_dir, "conversations")))
    return done.withColumnRenamed("conv", "conv_id")
