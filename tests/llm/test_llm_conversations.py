"""Conversation repair against a plain dynamic program over whole conversations."""

import random
import re
import zlib
from hashlib import sha256
from itertools import product

import pytest
from pyspark.sql import functions as F

from argulith.llm import conversation_repair as cr

STEP = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
GIVEN = {"0": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_text, turn_text, role, text = (" " if v is None else str(v) for v in (conv, turn, role, text))
        fate = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        out.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit): for every state the least pair, from the last row back."""
    found = faults(rows)

    def inserted(best):
        for _ in range(4):
            for state, role in GIVEN.items():
                if STEP[state, role] in best:
                    cost, audit = best[STEP[state, role]]
                    best[state] = min(best.get(state, (cost + 2, "I" + audit)), (cost + 2, "I" + audit))
        return best

    best = inserted({"0": (0, ""), "a": (0, "")})
    for fault, (_, role, _) in zip(reversed(found), reversed(rows)):
        ways = {}
        for state in "0sua":
            options = [("D", state, 3)]
            if fault not in ("b", "d"):
                options.append(("R", STEP[state, GIVEN[state]], 2 + (fault == "t")))
                if (state, role[:1]) in STEP:
                    options.append(("K", STEP[state, role[:1]], int(fault == "t")))
            ways[state] = min((cost + best[to][0], edit + best[to][1]) for edit, to, cost in options)
        best = inserted(ways)
    return best["0"]


def applied(rows, audit):
    out, state, at = [], "0", 0
    for edit in audit:
        if edit == "I":
            role, text = NAMES[GIVEN[state]], ""
        else:
            _, role, text = rows[at]
            at += 1
            role = NAMES[GIVEN[state]] if edit == "R" else role
        if edit != "D":
            state = STEP[state, role[:1]]
            out.append(f"{role}:{text}")
    return out


def repaired(rows):
    found, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = cheapest(rows)
    digest = sha256("\n".join(applied(rows, audit)).encode()).hexdigest()
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit, digest


def by_conversation(rows):
    def place(row):
        digest = sha256(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()
        return row[1] is not None, row[1] or 0, digest

    out = {conv: [] for conv, *_ in rows}
    for row in sorted(damaged(rows), key=place):
        out[row[0]].append(row[1:])
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, rows, chunk):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("own")).withColumn("block", F.lit("own"))
    got = cr.repair_digests(cr.damage(frame), chunk).collect()
    want = {conv: repaired(lines) for conv, lines in by_conversation(rows).items()}
    assert len(got) == len(want)
    assert {r[0]: tuple(r)[1:] for r in got} == want


def odd_rows(count, seed):
    draw = random.Random(seed)
    turns = [None, *range(30)]
    roles = [None, "", "user", "user", "assistant", "assistant", "system", "tool"]
    texts = [None, "", " \n", "a.", "b!  ", "no end", "x?\x0b", "long words " * 3_000, "é。"]
    return [(draw.choice([None, 1, 2, 2, 2]), draw.choice(turns), draw.choice(roles), draw.choice(texts)) for _ in range(count)]


def test_the_plain_program_finds_the_least_edits():
    """The plain program itself against every string of edits up to the least cost."""
    draw = random.Random(5)
    for _ in range(40):
        rows = [(i, draw.choice(["user", "assistant", "system", "x"]), draw.choice(["a.", "b", ""])) for i in range(draw.randint(0, 3))]
        found, ways = faults(rows), []
        for size in range(7):
            for edits in product("DIKR", repeat=size):
                if sum(e != "I" for e in edits) != len(rows):
                    continue
                state, at, cost = "0", 0, 0
                for edit in edits:
                    fault = "" if edit == "I" else found[at]
                    role = GIVEN[state] if edit in "IR" else rows[at][1][:1]
                    at += edit != "I"
                    cost += {"D": 3, "I": 2, "K": 0, "R": 2}[edit] + (edit in "KR" and fault == "t")
                    if edit == "D":
                        continue
                    if fault in ("b", "d") or (state, role) not in STEP:
                        break
                    state = STEP[state, role]
                else:
                    if state in "0a":
                        ways.append((cost, "".join(edits)))
        assert min(ways) == cheapest(rows)


@pytest.mark.parametrize("chunk", [cr.CHUNK, 7])
def test_odd_rows(spark, chunk):
    check(spark, odd_rows(150, chunk), chunk)


def test_one_long_conversation_in_many_chunks(spark):
    draw = random.Random(2)
    roles = ["user", "assistant", "user", "assistant", "system"]
    rows = [(9, i, roles[i % 2] if draw.random() < 0.8 else draw.choice(roles), f"text {draw.randint(0, 300)}.") for i in range(400)]
    check(spark, rows + [(8, i, "user", "same.") for i in range(60)], 16)


def test_given_tables(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = {c: repaired(v) for c, v in by_conversation([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]).items()}
    rows = cr.op11_conversation_repair(spark, sf_dir).collect()
    assert len(rows) == len(want) and {r.conv_id: tuple(r)[1:] for r in rows} == want


def test_repaired_rows(spark):
    rows = odd_rows(60, 3)
    made = cr.repair(cr.damage(spark.createDataFrame(rows, SCHEMA)), 5).collect()
    for conv, lines in by_conversation(rows).items():
        mine = sorted((r for r in made if r.conv == conv), key=lambda r: r.step)
        audit = cheapest(lines)[1]
        assert "".join(r.edit for r in mine) == audit and [r.step for r in mine] == list(range(1, len(audit) + 1))
        assert [f"{r.role}:{r.text}" for r in mine if r.edit != "D"] == applied(lines, audit)


def test_no_rows_and_dropped_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_digests(cr.damage(empty)).count() == 0 and cr.repair(cr.damage(empty)).count() == 0
    gone = next(t for t in range(1_000) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    row = cr.repair_digests(cr.damage(spark.createDataFrame([(4, gone, "user", "a.")], SCHEMA))).collect()
    assert [tuple(r) for r in row] == [(4, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
