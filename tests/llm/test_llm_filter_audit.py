"""The filter audit against plain counting in every order."""

import re
from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st

from argulith.llm import filter_audit as fa

DOCS = "doc_id long, text string, source string, part string, mask string"
LABELS = "doc_id long, quality int, toxic int"


def counted(docs, labels):
    """(part, order, step) -> counts, one document and one order after the other."""
    rated = {}
    for key, quality, toxic in labels:
        good, bad = rated.get(key, (False, False))
        rated[key] = good or quality == 1, bad or toxic == 1
    seen = []
    for key, text, source, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(k is not None and key is not None and k < key and (t or "") == text for k, t, *_ in docs)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": smaller,
        }
        seen.append((source or "", fails, rated.get(key, (False, False)) if key is not None else (False, False)))
    out = {}
    for part in {s[0] for s in seen}:
        mine = [s for s in seen if s[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [s for s in left if s[1][name]]
                left = [s for s in left if not s[1][name]]
                failing = sum(s[1][name] for s in mine)
                alone = sum(s[1][name] and sum(s[1].values()) == 1 for s in mine)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), alone, sum(s[2][0] for s in gone), sum(s[2][1] for s in gone),
                ]
    share = {}
    for (part, order, step), row in out.items():
        share[part, order[step - 1]] = share.get((part, order[step - 1]), 0) + row[1]
    return {k: (*row, share[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def run(spark, docs, labels):
    made = fa.audit(fa.failure_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)))
    rows = made.collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    assert all(r.filter == r.filter_order[r.step - 1] for r in rows)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa.COLUMNS) for r in rows}


def test_every_order_against_plain_counting(spark):
    fine = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", " \n", fine, fine + " #", "same " * 80, "UPPER " * 60, fine.upper(), "a|b", fine + "\x0b" + fine]
    docs = [(i % 17 if i % 5 else None, texts[i % 10], [None, "", "web", "books"][i % 4], "own", "own") for i in range(90)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(12)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1)]
    assert run(spark, docs, labels) == counted(docs, labels)


def test_repeated_keys_and_one_text(spark):
    docs = [(1, "x", "s", "", "")] * 3 + [(2, "x", "s", "", "")] * 2 + [(None, "x", "s", "", "")]
    assert run(spark, docs, [(1, 1, 0)]) == counted(docs, [(1, 1, 0)])


def test_empty_tables(spark):
    assert run(spark, [], []) == {}
    assert len(run(spark, [(1, "x", None, "", "")], [])) == 600


def test_swaps_visit_every_order():
    for count in range(1, 6):
        order, seen = list(range(count)), [tuple(range(count))]
        for level in fa.swap_walk(count):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(count)))


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.tuples(*[st.integers(1, 9)] * 2), max_size=16), st.lists(st.integers(0, 2), max_size=8))
def test_swapped_diagrams_keep_their_weights(masks, swaps):
    diagram = fa.Diagram("ABCD", masks, 2)
    for level in swaps:
        diagram.swap(level)

    def weight(at, left):
        name, *rest = diagram.nodes[at]
        return rest[0] if not name else weight(rest[int(name in left)], left)

    for mask in range(16):
        assert weight(diagram.root, {f for i, f in enumerate("ABCD") if mask >> i & 1}) == masks.get(mask, (0, 0))
