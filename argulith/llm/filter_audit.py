"""What each filter of a chain removes, in every order, from weighted decision diagrams.

The rows shrink to counts per part and mask of failed filters, 2^n masks at most. A part's counts become a
decision diagram: level by level one filter is decided, the low child holds the rows that pass it and
the high child those that fail it, equal subdiagrams are one node. Neighbouring levels are swapped in
place of building a new diagram; a walk of such swaps visits every order once. In each order the path of
passes from the root is the chain itself: the weight of a high child is what the step removes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.llm.common import BLANKS, UPPER, query, table

Weight = tuple[int, ...]


def failures(text: Column) -> dict[str, Column]:
    """Filters A to D on one text: few words, few distinct words, many capitals, odd signs."""
    blanks = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.array_remove(F.split(blanks, " "), "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": counts["n"] < 50,
        "B": 100 * counts["d"].cast("long") < 65 * counts["n"].cast("long"),
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": F.regexp_count(text, F.lit(r"[#$%&*|]")) > 0,
    }


def failure_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``(part, mask, rows, good, toxic)``: documents per part and set of failed filters.

    Bit i of the mask is the i-th of ABCDE. A null text or part counts as empty. E fails where a
    smaller key has the same text anywhere in the table; rows that share their key are not smaller
    than each other, and rows without a key neither fail E nor make others fail it. ``good`` and ``toxic``
    count rows whose key has a label row with quality or toxic 1, however many such rows there are.

    Texts leave their scan as digests. Rows that agree in digest, key, part and mask are counted before
    they are shuffled, so neither copies nor repeated keys gather in one task.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(F.col("text")).values())]
    slim = docs.select(F.col(key).alias("key"), whole.alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    narrow = slim.select("key", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    counted = narrow.groupBy("digest", "key", "part", "mask").agg(F.count(F.lit(1)).alias("rows"))
    firsts = counted.filter(F.col("key").isNotNull()).groupBy("digest").agg(F.min("key").alias("key"))
    firsts = firsts.select(F.col("digest").alias("digest_1"), F.col("key").alias("key_1"))
    first = (F.col("digest") == F.col("digest_1")) & (F.col("key") == F.col("key_1"))
    later = F.col("key").isNotNull() & F.col("key_1").isNull()
    masked = counted.join(firsts, first, "left").withColumn("mask", F.col("mask") + F.when(later, 16).otherwise(0))
    per_key = masked.groupBy("key", "part", "mask").agg(F.sum("rows").alias("rows"))
    rated = labels.filter((F.col("quality") == 1) | (F.col("toxic") == 1)).groupBy(F.col(key).alias("key_2"))
    rated = rated.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = per_key.join(rated, F.col("key") == F.col("key_2"), "left")
    weight = {n: F.sum(F.col("rows") * F.coalesce(F.col(n), F.lit(0))).alias(n) for n in ("good", "toxic")}
    return joined.groupBy("part", "mask").agg(F.sum("rows").alias("rows"), *weight.values())


class Diagram:
    """A reduced decision diagram whose leaves are weights; nodes are (filter, low, high)."""

    def __init__(self, filters: str, masks: dict[int, Weight], width: int) -> None:
        self.order = list(filters)
        self.nodes: list[tuple | None] = []
        self.known: dict[tuple, int] = {}
        self.sums: dict[int, Weight] = {}
        self.root = self._build(len(filters), 0, masks, (0,) * width)

    def _build(self, left: int, mask: int, masks: dict[int, Weight], none: Weight) -> int:
        if left == 0:
            return self.leaf(masks.get(mask, none))
        at = len(self.order) - left
        low = self._build(left - 1, mask, masks, none)
        return self.node(self.order[at], low, self._build(left - 1, mask | 1 << at, masks, none))

    def _unique(self, node: tuple, weight: Weight) -> int:
        if node not in self.known:
            self.known[node] = len(self.nodes)
            self.sums[self.known[node]] = weight
            self.nodes.append(node)
        return self.known[node]

    def leaf(self, weight: Weight) -> int:
        return self._unique(("", weight), weight)

    def node(self, name: str, low: int, high: int) -> int:
        """The node for one decision; its weight is that of both children, also where they are equal."""
        weight = tuple(a + b for a, b in zip(self.sums[low], self.sums[high]))
        return self._unique((name, low, high), weight)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next; levels below stay as they are."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = [lower, upper]
        done: dict[int, int] = {}

        def moved(at: int, depth: int) -> int:
            if at not in done:
                _, low, high = self.nodes[at]
                if depth < level:
                    done[at] = self.node(self.nodes[at][0], moved(low, depth + 1), moved(high, depth + 1))
                else:
                    (_, ll, lh), (_, hl, hh) = self.nodes[low], self.nodes[high]
                    done[at] = self.node(lower, self.node(upper, ll, hl), self.node(upper, lh, hh))
            return done[at]

        self.root = moved(self.root, 0)

    def passes(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the path of passes: filter, weight that stays, weight that goes."""
        at = self.root
        while self.nodes[at][0]:
            name, low, high = self.nodes[at]
            yield name, self.sums[low], self.sums[high]
            at = low


def swap_walk(count: int) -> list[int]:
    """Levels to swap, one after the other, so that every order of ``count`` filters comes up once."""
    if count < 2:
        return []
    inner, out = swap_walk(count - 1), []
    for n in range(factorial(count - 1)):
        out += range(count - 2, -1, -1) if n % 2 == 0 else range(count - 1)
        if n < len(inner):
            out.append(inner[n] + (n % 2 == 0))
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_part(masks: dict[int, Weight], filters: str) -> list[tuple]:
    """``(order, step, filter, *COLUMNS)`` for every order of the filters over one part's masks."""
    diagram = Diagram(filters, masks, 3)
    fails = {f: sum(w[0] for m, w in masks.items() if m >> i & 1) for i, f in enumerate(filters)}
    alone = {f: masks.get(1 << i, (0, 0, 0))[0] for i, f in enumerate(filters)}
    steps, share = [], dict.fromkeys(filters, 0)
    for level in [None, *swap_walk(len(filters))]:
        if level is not None:
            diagram.swap(level)
        order = "".join(diagram.order)
        for step, (name, stay, gone) in enumerate(diagram.passes(), 1):
            share[name] += gone[0]
            steps.append((order, step, name, stay[0], gone[0], fails[name] - gone[0], alone[name], gone[1], gone[2]))
    return [(*row, share[row[2]]) for row in steps]


def audit(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Every order of ``filters``, step by step, for each part of ``failure_counts``.

    Columns ``part, filter_order, step, filter`` and counts of rows: ``kept`` after the step,
    ``removed`` by it, ``redundant`` (fail its filter but were removed before), ``unique_fails`` (fail
    its filter only), ``good_lost`` and ``toxic_lost`` among the removed, ``shapley`` (removed by its filter
    over all orders). A part is at most 2^n rows of counts whatever its documents are; no parts give
    no rows, and other columns of ``counts`` are not read.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        weights = zip(part["rows"].tolist(), part["good"].tolist(), part["toxic"].tolist())
        rows = audit_part(dict(zip(part["mask"].tolist(), weights)), filters)
        made = pd.DataFrame(rows, columns=["filter_order", "step", "filter", *COLUMNS])
        made.insert(0, "part", part["part"].iloc[0])
        return made

    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in COLUMNS)
    return counts.select("part", "mask", "rows", "good", "toxic").groupBy("part").applyInPandas(run, schema)


FAILURES_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS words FROM documents
), m AS (
  SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
    doc_id > min(doc_id) OVER (PARTITION BY text)] AS f FROM t
), r AS (
  SELECT m.*, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic FROM m LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
), c AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM r GROUP BY part, f
)"""

OP12_SQL = (
    FAILURES_SQL
    + """, v AS (
  SELECT i, chr(64 + i) AS name FROM (SELECT unnest(range(1, 6))::INT AS i)
), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS p, a.name || b.name || c.name || d.name || e.name AS filter_order
  FROM v a, v b, v c, v d, v e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS (
  SELECT filter_order, step, p[step] AS i, p[1:step - 1] AS before FROM o, (SELECT unnest(range(1, 6))::INT AS step)
), k AS (
  SELECT c.part, s.filter_order, s.step, s.i,
    sum(CASE WHEN gone = 0 AND NOT f[s.i] THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN gone = 0 AND f[s.i] THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone > 0 AND f[s.i] THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f[s.i] AND len(list_filter(f, lambda b: b)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = 0 AND f[s.i] THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN gone = 0 AND f[s.i] THEN x ELSE 0 END) AS toxic_lost
  FROM s, LATERAL (SELECT part, f, n, g, x, len(list_filter(s.before, lambda j: f[j])) AS gone FROM c) c GROUP BY ALL
)
SELECT part, filter_order, step, chr(64 + i) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley FROM k"""
)


@query("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Five filters over whole documents in all 120 orders, per source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(failure_counts(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")))
