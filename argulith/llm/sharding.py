"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Row ``p`` of the matrix says how many rows of input partition ``p`` go to each cell; its margins are
the partitions' row counts and the cells' exact sizes, and it is drawn as a uniform permutation of
all rows would draw it. Partitions permute their rows locally, hand out runs of them as their row of
the matrix says, and every cell permutes what it received. A shard is one cell, or several
consecutive ones if it is large, so no task ever sorts a whole large shard; as the cells' sizes are
known in advance, slots need no count after the exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argulith.llm.common import query, spare, table
from argulith.session import stage

SHARDS = 16
CELL_ROWS = 16_000_000  # a cell is sorted by one task, spilling if it must
GROUP_PARTITIONS = 1_024  # matrix rows that one task draws in sequence
MATRIX_BROADCAST_BYTES = 32 << 20
TRIES = 64  # one try is accepted with a chance over one half
RUN_BITS = 33  # monotonically_increasing_id: partition above, position below


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ln_factorial(n: Column) -> Column:
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")))
    series = (
        (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12 * n) - 1 / (360 * n * n * n)
    )
    return F.when(n <= 20, small).otherwise(series)


def _uniform(*keys: Column | int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(*[k if isinstance(k, Column) else F.lit(k) for k in keys]), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def hypergeometric(total: Column, good: Column, draws: Column, *keys: Column | int) -> Column:
    """Number of good ones among ``draws`` of ``total`` without replacement, as a long.

    Ratio of uniforms under a table-mountain hat, accepted by the exact probability; the uniforms
    are hashes of ``keys``. Its cost does not depend on the counts.
    """
    one = F.struct(
        total.cast("double").alias("t"), good.cast("double").alias("k"), draws.cast("double").alias("n")
    )

    def ln_odds(p: Column, x: Column) -> Column:
        return -(
            _ln_factorial(x)
            + _ln_factorial(p["k"] - x)
            + _ln_factorial(p["n"] - x)
            + _ln_factorial(p["t"] - p["k"] - p["n"] + x)
        )

    def shape(p: Column) -> Column:
        mean = p["n"] * p["k"] / p["t"]
        spread = mean * (1 - p["k"] / p["t"]) * (p["t"] - p["n"]) / F.greatest(p["t"] - 1, F.lit(1.0))
        mode = F.floor((p["n"] + 1) * (p["k"] + 1) / (p["t"] + 2)).cast("double")
        return F.struct(
            p["t"].alias("t"), p["k"].alias("k"), p["n"].alias("n"), mode.alias("mode"),
            (mean + 0.5).alias("centre"),
            (1.7155277699214135 * F.sqrt(spread + 0.5) + 0.8989161620588988).alias("width"),
            ln_odds(p, mode).alias("top"),
        )

    def tried(p: Column) -> Column:
        def attempt(found: Column, i: Column) -> Column:
            def judged(q: Column) -> Column:
                inside = (q["x"] >= F.greatest(F.lit(0.0), p["n"] + p["k"] - p["t"])) & (
                    q["x"] <= F.least(p["k"], p["n"])
                )
                return F.when(inside, F.when(2 * F.log(q["u"]) <= ln_odds(p, q["x"]) - p["top"], q["x"]))

            def placed(u: Column) -> Column:
                at = F.floor(p["centre"] + p["width"] * (_uniform(*keys, i, 1) - 0.5) / u)
                return _let(F.struct(u.alias("u"), at.cast("double").alias("x")), judged)

            return F.when(found.isNotNull(), found).otherwise(_let(_uniform(*keys, i, 0), placed))

        hit = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"), attempt)
        return F.coalesce(hit, p["mode"]).cast("long")

    drawn = _let(one, lambda p: _let(shape(p), tried))
    return F.when((draws == 0) | (good == 0), F.lit(0).cast("long")).when(good == total, draws).when(
        draws == total, good
    ).otherwise(drawn)


def _matrix_row(left: Column, rows: Column, key: Column, seed: int, level: int) -> Column:
    """How many of ``rows`` draws come from each entry of ``left``, the counts still to be dealt."""
    start = F.struct(
        F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("t"),
        rows.cast("long").alias("n"),
        F.array().cast("array<bigint>").alias("xs"),
    )

    def step(state: Column, good: Column) -> Column:
        x = hypergeometric(state["t"], good, state["n"], seed, level, key, F.size(state["xs"]))
        return _let(
            x,
            lambda v: F.struct(
                (state["t"] - good).alias("t"), (state["n"] - v).alias("n"), F.array_append(state["xs"], v).alias("xs")
            ),
        )

    return F.aggregate(left, start, step, lambda s: s["xs"])


def _deal(left: Column, members: Column, seed: int, level: int) -> Column:
    """Matrix rows for ``members``, an array of (key, rows), which share ``left`` exactly."""
    start = F.struct(left.alias("left"), F.array().cast("array<struct<key:bigint,xs:array<bigint>>>").alias("dealt"))

    def step(state: Column, member: Column) -> Column:
        return _let(
            _matrix_row(state["left"], member["n"], member["key"], seed, level),
            lambda xs: F.struct(
                F.zip_with(state["left"], xs, lambda a, b: a - b).alias("left"),
                F.array_append(state["dealt"], F.struct(member["key"].alias("key"), xs.alias("xs"))).alias("dealt"),
            ),
        )

    return F.aggregate(members, start, step, lambda s: s["dealt"])


def communication_matrix(counts: DataFrame, cells: list[int], seed: int) -> DataFrame:
    """``(pid, ends)``: where the run of each cell ends in partition ``pid`` of ``counts(pid, n)``.

    Two levels: groups of partitions share out the cells first, then the partitions of a group do,
    all groups at once. One task handles ``GROUP_PARTITIONS`` partitions, or one entry per group.
    """
    grouped = (
        counts.groupBy(F.expr(f"pid div {GROUP_PARTITIONS}").alias("g"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("pid").alias("key"), "n"))).alias("members"), F.sum("n").alias("n"))
    )
    top = grouped.agg(F.sort_array(F.collect_list(F.struct(F.col("g").alias("key"), "n"))).alias("groups"))
    sizes = F.array(*[F.lit(c).cast("long") for c in cells])
    shares = top.select(F.inline(_deal(sizes, F.col("groups"), seed, 0))).select(F.col("key").alias("g"), "xs")
    rows = grouped.join(shares, "g").select(F.inline(_deal(F.col("xs"), F.col("members"), seed, 1)))

    def add(ends: Column, x: Column) -> Column:
        return F.array_append(ends, x + F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)))

    ends = F.aggregate("xs", F.array().cast("array<bigint>"), add)
    return rows.select(F.col("key").alias("pid"), ends.alias("ends"))


def _run_of(ends: Column, position: Column, cells: int) -> Column:
    """Number of runs that end at or before ``position``, by bisection."""
    start = F.struct(F.lit(0).alias("lo"), F.lit(cells).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        return _let(
            F.expr("0") + F.floor((s["lo"] + s["hi"]) / 2).cast("int"),
            lambda mid: F.when(s["lo"] >= s["hi"], s)
            .when(F.get(ends, mid) <= position, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi"))),
        )

    steps = F.sequence(F.lit(1), F.lit(cells.bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def even_parts(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = 42, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in its shard).

    Shard sizes differ by one at most and every permutation of the rows is as likely as any other.
    Rows are told apart by where they stand, never by their values: nulls, empty texts, equal and
    repeated rows are rows like any other. An empty table gives no rows. If ``df`` has columns
    ``shard`` or ``slot``, the new ones have underscores before their names. The rows with their
    places are staged once, so that a lost executor, or a second run of a task, sees the same places.
    The draw depends on the seed and on the input's partitions.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    taken = list(df.columns)
    shard, slot = spare("shard", taken), spare("slot", taken)
    order, pid, pos, ends, cell = (spare(n, taken) for n in ("_order", "_pid", "_pos", "_ends", "_cell"))
    place = F.monotonically_increasing_id()
    placed = stage(
        df.withColumn(order, F.rand(seed))
        .sortWithinPartitions(order)
        .withColumn(order, place)
        .withColumn(pid, F.shiftright(order, RUN_BITS))
        .withColumn(pos, F.col(order).bitwiseAND((1 << RUN_BITS) - 1))
        .drop(order),
        "placed",
    )
    counts = placed.groupBy(F.col(pid).alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    partitions, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    per_shard = max(1, -(-total // (shards * cell_rows)))
    cells = [size for whole in even_parts(total, shards) for size in even_parts(whole, per_shard)]
    matrix = communication_matrix(counts, cells, seed).select(F.col("pid").alias(pid), F.col("ends").alias(ends))
    if partitions * len(cells) * 8 <= MATRIX_BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    # First slot of every cell in its shard, from the exact sizes.
    firsts = [sum(cells[i - i % per_shard : i]) for i in range(len(cells))]
    again = Window.partitionBy(cell).orderBy(F.xxhash64(F.lit(seed + 1), pid, pos), pid, pos)
    return (
        placed.join(matrix, pid)
        .withColumn(cell, _run_of(F.col(ends), F.col(pos), len(cells)))
        .drop(ends)
        .withColumn(slot, F.row_number().over(again) - 1)
        .withColumn(slot, F.col(slot) + F.get(F.array(*[F.lit(f).cast("long") for f in firsts]), F.col(cell)))
        .withColumn(shard, F.floor(F.col(cell) / per_shard).cast("int"))
        .select(*[F.col(f"`{c}`") for c in taken], shard, slot)
    )


@query("op1_sharding")
def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose row counts differ by one at most; a null text has no crc32."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    return shard_rows(documents).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
