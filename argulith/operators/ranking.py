"""Exact global and per-class positions without a one-task window.

A position is the offset of a bucket plus the position inside it. Buckets are prefixes of the
ordering hash (even by construction) or quantile ranges of the key, so neither a whole table nor a
class that holds a third of it is ever sorted by one task.
"""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argulith.operators.bounded import broadcast_bounded
from argulith.session import stage

HASH_DIGITS = 3  # 16 ** 3 buckets
MAX_OFFSET_ROWS = 200_000  # four narrow columns, a few megabytes


def order_hash(id_col: str, seed: int) -> Column:
    """The seeded random order: md5 of ``seed:id``, the same on every engine and every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by ``keys`` in which null equals null; the columns of ``left``, then the rest of ``right``."""
    renamed = right.select(*[F.col(c).alias(f"_same_{c}") if c in keys else F.col(c) for c in right.columns])
    equal = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(broadcast_bounded(renamed, MAX_OFFSET_ROWS), equal, how).drop(*[f"_same_{k}" for k in keys])


def _with_bucket(df: DataFrame, id_col: str, seed: int, digits: int) -> DataFrame:
    return df.withColumn("_hash", order_hash(id_col, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, digits)
    )


def _positions(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Zero-based ``out`` within ``group``, given a ``_bucket`` column that follows the order.

    Also adds the size of the group as ``_total``. The windows over ``group`` run on one row per
    bucket; only the window over ``group`` and bucket runs on the rows.
    """
    sizes = df.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    in_group = Window.partitionBy(*group)
    offsets = sizes.select(
        *group,
        "_bucket",
        (F.sum("_size").over(in_group.orderBy("_bucket")) - F.col("_size")).alias("_offset"),
        F.sum("_size").over(in_group).alias("_total"),
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        _same(df, offsets, [*group, "_bucket"])
        .withColumn(out, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_offset")
    )


def shuffled_index(
    df: DataFrame, id_col: str, seed: int = 42, out: str = "row_idx", digits: int = HASH_DIGITS
) -> DataFrame:
    """Seeded permutation of the whole table: every row gets its new index."""
    keyed = _with_bucket(df, id_col, seed, digits)
    return _positions(keyed, [], ["_hash", id_col], out).drop("_hash", "_total")


def row_index(df: DataFrame, key: str, out: str = "row_idx", buckets: int | None = None) -> DataFrame:
    """Consecutive index in the order of a unique numeric ``key``."""
    if buckets is None:
        buckets = min(4096, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keyed = df.withColumn("_key", F.col(key).cast("double"))
    ranges = QuantileDiscretizer(
        numBuckets=buckets, inputCol="_key", outputCol="_bucket", relativeError=0.1 / buckets
    ).fit(keyed.select("_key"))
    return _positions(ranges.transform(keyed).drop("_key"), [], [key], out).drop("_total")


def number_rows(df: DataFrame, out: str = "doc_id") -> DataFrame:
    """Keys for a source that has none: unique, in the order in which its parts are read, with gaps.

    Staged, so that every later read sees the same keys; ``row_index`` makes them consecutive.
    """
    return stage(df.withColumn(out, F.monotonically_increasing_id()), "numbered")


def rank_in_class(
    df: DataFrame,
    label_col: str,
    id_col: str,
    seed: int = 42,
    out: str = "rank_in_class",
    size: str = "class_size",
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """One-based position of a row in its class in seeded order, and the size of the class."""
    keyed = _with_bucket(df, id_col, seed, digits)
    ranked = _positions(keyed, [label_col], ["_hash", id_col], out).drop("_hash")
    return ranked.withColumn(out, F.col(out) + 1).withColumnRenamed("_total", size)


SLOTS = 4_096  # parts of a key's range that are counted at a time
FEW_ROWS = 10_000  # keys of one part that are sorted by the driver


def _cut(keys: DataFrame, n: int) -> tuple[int, int] | None:
    """The n-th smallest long in the column ``at``, and how many of its rows belong to the first n; None if all do.

    Rows are counted in equal parts of the range of keys, then in the part that holds the cut, and so on
    until few keys are left: partial sums of one column, whatever n is.
    """
    left, inside = n, keys
    while True:
        rows, low, high = inside.agg(F.count("at"), F.min("at"), F.max("at")).first()
        if rows <= left:
            return None if inside is keys else (high, inside.filter(F.col("at") == high).count())
        if low == high or left == 0:
            return low, left
        if rows <= FEW_ROWS:
            held = sorted(r[0] for r in inside.collect())
            return held[left - 1], left - sum(k < held[left - 1] for k in held)
        width = (high - low) // SLOTS + 1
        # Whole numbers of 20 digits: the range itself may not fit a long.
        slot = F.expr(f"cast((cast(at as decimal(20, 0)) - {low}BD) div {width}BD as int)")
        counts = sorted(tuple(r) for r in inside.groupBy(slot).count().collect())
        for place, count in counts:
            if left <= count:
                break
            left -= count
        inside = inside.filter(F.col("at").between(low + place * width, min(high, low + (place + 1) * width - 1)))


def _first_rows(df: DataFrame, at: Column, n: int) -> DataFrame:
    """The first n rows by a long: a filter at the cut, so all other rows stay where they are; rows without a key come last.

    Only rows that share the key at the cut are counted off, when not all of them fit.
    """
    if n <= 0:
        return df.limit(0)
    keys = df.select(at.alias("at")).filter(F.col("at").isNotNull())
    found = _cut(keys, n)
    if found is None:
        without = df.filter(at.isNull())
        return df.filter(at.isNotNull()).unionByName(without.limit(n - keys.count())) if not without.isEmpty() else df
    last, share = found
    if keys.filter(F.col("at") == last).count() == share:
        return df.filter(at <= last)
    return df.filter(at < last).unionByName(df.filter(at == last).limit(share))


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` random rows in seeded order, the same for the same seed; only hashes are counted.

    The cut is by 60 bits of the seeded hash; of keys whose bits agree, and of repeated keys, any fill the last places.
    """
    order = order_hash(id_col, seed)
    bits = F.conv(F.substring(order, 1, 15), 16, 10).cast("long")
    return _first_rows(df, bits, n).orderBy(order, id_col)


def head_n(df: DataFrame, n: int, id_col: str) -> DataFrame:
    """The first ``n`` rows by key, in order; the cut is found by counting keys, or by sorting them where they are no integers."""
    if df.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        return _first_rows(df, F.col(id_col).cast("long"), n).orderBy(F.col(id_col).asc_nulls_last())
    first = df.select(id_col).orderBy(F.col(id_col).asc_nulls_last()).limit(n)
    keys = first.groupBy(id_col).agg(F.count(F.lit(1)).alias("_share"))
    met = df.join(keys, df[id_col].eqNullSafe(keys[id_col]), "inner").drop(keys[id_col])
    place = Window.partitionBy(id_col).orderBy(F.lit(0))
    return met.withColumn("_place", F.row_number().over(place)).filter("_place <= _share").drop("_place", "_share").orderBy(id_col)


def hash_split(df: DataFrame, id_col: str, seed: int = 42, test: float = 0.1, val: float = 0.1) -> DataFrame:
    """Row-local split by the ordering hash: no counts, no shuffle, shares only approximate."""
    first = f"{int(test * 65536):04x}"
    second = f"{int((test + val) * 65536):04x}"
    head = F.substring(order_hash(id_col, seed), 1, 4)
    return df.withColumn(
        "split", F.when(head < first, "test").when(head < second, "val").otherwise("train")
    )


def _quota(rows: Column, share: tuple[int, int]) -> Column:
    part, whole = share
    return F.floor(rows * part / whole + 0.5)


def stratified_split(
    df: DataFrame,
    label_col: str,
    id_col: str,
    seed: int = 42,
    test_share: tuple[int, int] = (10, 100),
    val_share: tuple[int, int] = (111, 1000),
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Test rows first, then validation rows of the rest, with a rounded quota in every class.

    Two narrow passes find, per class, the last row of each part; the rows themselves are then
    labelled by comparing with these cut points, so the texts are never shuffled:

    1. counts per class and hash bucket give the bucket each cut point lies in,
    2. only the rows of those buckets are ranked, which gives the cut points.
    """
    keyed = _with_bucket(df, id_col, seed, digits)
    in_class = Window.partitionBy(label_col)
    sizes = (
        keyed.groupBy(label_col, "_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_upto", F.sum("_size").over(in_class.orderBy("_bucket")))
        .withColumn("_total", F.sum("_size").over(in_class))
        .withColumn("_test", _quota(F.col("_total"), test_share))
        .withColumn("_val", F.col("_test") + _quota(F.col("_total") - F.col("_test"), val_share))
    )
    before = F.col("_upto") - F.col("_size")
    cut_buckets = sizes.select(
        label_col,
        "_bucket",
        F.explode(
            F.array(
                F.struct(F.lit("test").alias("part"), (F.col("_test") - before).alias("rank")),
                F.struct(F.lit("val").alias("part"), (F.col("_val") - before).alias("rank")),
            )
        ).alias("_cut"),
        "_size",
    ).filter((F.col("_cut.rank") >= 1) & (F.col("_cut.rank") <= F.col("_size")))
    cut_buckets = cut_buckets.select(
        label_col, "_bucket", F.col("_cut.part").alias("_part"), F.col("_cut.rank").alias("_rank")
    )
    inside = Window.partitionBy(label_col, "_bucket", "_part").orderBy("_hash", id_col)
    cut_rows = (
        _same(keyed.select(label_col, "_bucket", "_hash", id_col), cut_buckets, [label_col, "_bucket"])
        .withColumn("_position", F.row_number().over(inside))
        .filter(F.col("_position") == F.col("_rank"))
        .withColumn("_at", F.struct("_hash", id_col))
    )
    cuts = cut_rows.groupBy(label_col).agg(
        F.max(F.when(F.col("_part") == "test", F.col("_at"))).alias("_last_test"),
        F.max(F.when(F.col("_part") == "val", F.col("_at"))).alias("_last_val"),
    )
    at = F.struct("_hash", id_col)
    return (
        _same(keyed.drop("_bucket"), cuts, [label_col], "left")
        .withColumn(
            "split",
            F.when(at <= F.col("_last_test"), "test").when(at <= F.col("_last_val"), "val").otherwise("train"),
        )
        .drop("_hash", "_last_test", "_last_val")
    )
