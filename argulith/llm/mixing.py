"""Mixing sources to target weights: hash-random order, prefix sums, a cut at each source's budget.

Within a source, rows stand in the order of a hash of their id. That order is split into ranges of
equal width, about as many as a range holds rows. Sums per range and their prefix sums say in which
range the budget ends; only that range's rows are summed by id and size, and these sums ordered. So the
largest piece that one task orders is about the square root of the largest source, besides the different
sizes of one id. Rows that share id and size with the one at the budget's end are counted by task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from argulith.llm.common import query, spare, table, word_count
from argulith.session import stage

EPOCHS = 3  # a source, and so a document, is used as often at most
SEED = 42


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source in code point order, null last, without a one-task window.

    Range partitions of the sorted sources are staged; a source's position is its position inside
    the partition plus the rows of the partitions before.
    """
    mid = F.monotonically_increasing_id()
    placed = stage(
        sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
        .withColumn("_mid", mid)
        .withColumn("_pid", F.shiftright("_mid", 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND((1 << 33) - 1)),
        "sources",
    )
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_before"))  # a row per partition
    return placed.join(offsets, "_pid").withColumn("_rank", F.col("_before") + F.col("_pos")).drop(
        "_mid", "_pid", "_pos", "_before"
    )


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, epochs: int = EPOCHS
) -> DataFrame:
    """``(source, source_size, rows, target)`` from ``(source, source_size, rows)``.

    Sources in code point order, null last, weigh as ``weights`` repeats and share ``share`` of all
    sizes. No target is above ``epochs`` times its source's size: such sources get just that, and
    what they leave is shared by the others by weight, until none is above. Every round is one small
    aggregate; the sums are exact.
    """
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_rank") % len(weights)).cast("int"))
    weighed = stage(_ranked(sources).withColumn("_weight", weight), "weights")
    total = int(weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    budget = total if share == 1.0 else int(total * share)
    room = F.col("source_size") * epochs
    level = 0.0  # words per unit of weight
    while True:
        full = room <= F.col("_weight") * F.lit(level)
        used, free = weighed.agg(
            F.coalesce(F.sum(F.when(full, room)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0))
        ).first()
        raised = (budget - used) / free if free else level
        if raised <= level:
            break
        level = raised
    target = F.least(room.cast("double"), F.col("_weight") * F.lit(level))
    return weighed.select("source", "source_size", "rows", target.alias("target"))


def _row_numbers(rows: DataFrame, group: str, mid: str) -> DataFrame:
    """Per ``group`` the ``mid`` of the row at position ``_at`` (from 0) in the order of ``mid``, if there is one.

    ``mid`` is a staged ``monotonically_increasing_id``: rows are counted per task that gave it, and
    only the rows of the one task in which the position lies are numbered.
    """
    counted = rows.withColumn("_pid", F.shiftright(mid, 33)).groupBy(group, "_pid", "_at").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    found = (
        counted.withColumn("_skip", F.col("_at") - F.coalesce(before, F.lit(0)))
        .filter((F.col("_skip") >= 0) & (F.col("_skip") < F.col("_n")))
        .select(F.col(group).alias("_group"), F.col("_pid").alias("_task"), "_skip")
    )
    there = F.col(group).eqNullSafe(F.col("_group")) & (F.shiftright(mid, 33) == F.col("_task"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(mid)) - 1
    return rows.join(found, there).withColumn("_place", place).filter(F.col("_place") == F.col("_skip")).select(group, mid)


def mix_rows(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``df`` with ``source_size``, ``target``, ``copies`` and ``cut``: how often the mix uses the row.

    A source with target t and size s gives floor(t / s) whole epochs; of the last, broken one it
    gives the rows in hash order of ``key`` up to the rest of the budget. ``copies`` counts whole
    uses; one row per source at most stands across the budget's end, and ``cut`` is how many of its
    words (less than its size) are still inside, 0 for all others. So a source gives exactly
    floor(t) words, and no row is used more than ``epochs`` times. Reruns agree. ``size`` is a long; null and negative sizes count 0. Rows of a
    source without any words get 0 copies. A null source is a source of its own; null and repeated
    keys and repeated rows are rows like any other (equal rows change places freely). An empty
    table gives no rows. Clashing column names: the new ones have underscores before them.
    """
    taken = list(df.columns)
    src, words, total, target, copies, cut = (
        spare(n, taken) for n in ("_source", "_size", "source_size", "target", "copies", "cut")
    )
    order, part, runs, last, rest, begin, other, own, end, left, mid, stop = (
        spare(n, taken)
        for n in ("_order", "_part", "_runs", "_last", "_rest", "_before", "_other", "_own", "_end", "_left", "_mid", "_stop")
    )
    keyed = (
        df.withColumn(src, F.col(source).cast("string"))
        .withColumn(words, F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)))
        .withColumn(order, F.xxhash64(F.lit(seed), F.col(key)))
        .withColumn(own, F.struct(F.col(order).alias("order"), F.col(key).alias("key"), F.col(words).alias("words")))
    )
    narrow = stage(keyed.select(src, words, order, own), "words")
    goals = source_targets(
        narrow.groupBy(F.col(src).alias("source")).agg(F.sum(words).alias("source_size"), F.count(F.lit(1)).alias("rows")),
        weights,
        share,
        epochs,
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = stage(
        goals.select(
            F.col("source").alias(src),
            F.col("source_size").alias(total),
            F.col("target").alias(target),
            F.ceil(F.sqrt("rows")).cast("long").alias(runs),
            whole.alias(copies),
            (F.floor("target") - whole * F.col("source_size")).alias(rest),
        ),
        "goals",
    )
    # The upper 53 bits of the hash, as a fraction, say in which of the equal ranges a row stands.
    fraction = (F.shiftrightunsigned(order, 11)).cast("double") / float(1 << 53)

    def with_plan(rows: DataFrame, small: DataFrame) -> DataFrame:
        """Joined by source, nulls too. Without a key over it, a skewed source is split by the engine."""
        return rows.join(small.withColumnRenamed(src, other), F.col(src).eqNullSafe(F.col(other))).drop(other)

    placed = with_plan(narrow, plan).withColumn(part, F.floor(fraction * F.col(runs)).cast("long"))
    sums = placed.groupBy(src, part, rest).agg(F.sum(words).alias("_sum"))
    before = F.coalesce(
        F.sum("_sum").over(Window.partitionBy(src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # The range in which the rest ends: the last one that begins before it.
    cuts = (
        sums.withColumn(begin, before)
        .filter(F.col(begin) < F.col(rest))
        .groupBy(src)
        .agg(F.max_by(F.struct(part, begin), part).alias("_cut"))
        .select(F.col(src).alias(other), F.col("_cut")[part].alias(last), F.col("_cut")[begin].alias(begin))
    )
    # A source without a cut has nothing left after whole epochs: all its ranges stand behind the cut.
    full = plan.join(cuts, F.col(src).eqNullSafe(F.col(other)), "left").select(
        *plan.columns, F.coalesce(last, F.lit(-1)).alias(last), F.coalesce(begin, F.lit(0)).alias(begin)
    )
    ranges = stage(full, "cuts")
    # The key and size at which it ends: the last ones that begin before it.
    alike = (
        with_plan(narrow, ranges)
        .filter(F.floor(fraction * F.col(runs)).cast("long") == F.col(last))
        .groupBy(src, rest, begin, own)
        .agg(F.sum(words).alias("_sum"))
    )
    earlier = F.sum("_sum").over(Window.partitionBy(src).orderBy(own).rowsBetween(Window.unboundedPreceding, -1))
    ends = (
        alike.withColumn(left, F.col(rest) - F.col(begin) - F.coalesce(earlier, F.lit(0)))
        .filter(F.col(left) > 0)
        .groupBy(src)
        .agg(F.max_by(F.struct(own, left), own).alias("_last"))
        .select(F.col(src).alias(other), F.col("_last")[own].alias(end), F.col("_last")[left].alias(left))
    )
    full = ranges.join(ends, F.col(src).eqNullSafe(F.col(other)), "left").drop(other)
    decided = with_plan(keyed, stage(full, "ends")).withColumn(part, F.floor(fraction * F.col(runs)).cast("long"))
    same = F.col(part) == F.col(last)
    at_end = F.coalesce(same & (F.col(own) == F.col(end)), F.lit(False))
    inside = (F.col(part) < F.col(last)) | (same & (F.col(own) < F.col(end)) & (F.col(words) > 0))
    sure = (
        decided.filter(~at_end)
        .withColumn(copies, F.col(copies) + F.coalesce(inside, F.lit(False)).cast("int"))
        .withColumn(cut, F.lit(0).cast("long"))
    )
    # Rows alike in key and size stand in the order of their staged numbers; often it is one row per source.
    across = stage(decided.filter(at_end).withColumn(mid, F.monotonically_increasing_id()), "across")
    stops = _row_numbers(across.select(src, mid, ((F.col(left) - F.col(left) % F.col(words)) / F.col(words)).cast("long").alias("_at")), src, mid)
    stops = stops.select(F.col(src).alias(other), F.col(mid).alias(stop))
    # Without a row at the budget's end all of them are inside.
    numbered = across.join(stops, F.col(src).eqNullSafe(F.col(other)), "left").drop(other)
    whole_use = F.coalesce(F.col(mid) < F.col(stop), F.lit(True))
    across = numbered.withColumn(copies, F.col(copies) + whole_use.cast("int")).withColumn(
        cut, F.when(F.col(mid) == F.col(stop), F.col(left) % F.col(words)).otherwise(0).cast("long")
    )
    kept = [*[F.col(f"`{c}`") for c in taken], F.col(total), F.col(target), F.col(copies), F.col(cut)]
    return sure.select(*kept).unionByName(across.select(*kept))


@query("op6_mixing")
def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    sized = stage(
        table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    return mix_rows(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies") + F.col("cut")).alias("taken")
    )
