"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments, one table per segment. Two fingerprints that differ in few bits
agree, up to a small Hamming ball, in at least one segment: the balls around a fingerprint's
segments are enumerated, looked up in the tables, and whole distances decide. Only distinct
fingerprints are looked up, so copies cost nothing, however many there are.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from argulith.llm.common import query, spare, table, with_text_columns
from argulith.llm.components import components
from argulith.session import stage

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 2  # 32 bits each: a table entry is shared by few fingerprints, even among billions
HASH_SEED = 42
VOTES = 65_536  # hashes whose bits are counted at once


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words of the text, its A to Z in lower case."""
    from xxhash import xxh64_intdigest

    # bytes.lower() knows A to Z only, and bytes.split() the six ASCII blanks only.
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle, len(words))
    first, last = (ends - lengths)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    hashes = [xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(first, last)]
    return np.array(hashes, dtype=np.uint64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits of the shingles' hashes, as a signed long; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    votes = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), VOTES):
        part = hashes[first : first + VOTES].astype("<u8").view(np.uint8)
        votes += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_simhash(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``fingerprint``, a long, of every whole text."""
    field = StructField(spare("fingerprint", df.columns), LongType(), False)
    return with_text_columns(
        df, text, StructType([field]), lambda texts: [pa.array([simhash(t, shingle) for t in texts], pa.int64())]
    )


def segment_radii(max_bits: int, segments: int) -> list[int]:
    """Ball radius per segment: some segment of two fingerprints within ``max_bits`` is inside its own.

    With q, r = divmod(max_bits, segments): if r + 1 segments were off by more than q bits each and
    the others by q or more, the sum would be above ``max_bits``.
    """
    whole, left = divmod(max_bits, segments)
    return [whole if i <= left else whole - 1 for i in range(segments)]


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with ``radius`` ones or fewer."""
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(width), n)]


def near_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """``(a, b)``: pairs of distinct ``fingerprint`` values that differ in ``max_bits`` bits or fewer.

    A pair may come twice. The distance is part of the join, so entries that only share a segment
    are never rows; a segment value that many share is split by the engine's skew handling.
    """
    if not 2 <= segments <= 16 or 64 % segments:
        raise ValueError("2, 4, 8 or 16 segments")
    width = 64 // segments

    def part(i: int) -> Column:
        return F.shiftrightunsigned("fingerprint", i * width).bitwiseAND((1 << width) - 1)

    def key(i: int, mask: int) -> Column:  # segments of 32 bits leave room for their number
        return F.shiftleft(part(i).bitwiseXOR(F.lit(mask)), 4).bitwiseOR(F.lit(i))

    radii = segment_radii(max_bits, segments)
    used = [i for i, radius in enumerate(radii) if radius >= 0]
    entries = prints.select(F.col("fingerprint").alias("b"), F.explode(F.array(*[key(i, 0) for i in used])).alias("key"))
    probes = F.array(*[key(i, mask) for i in used for mask in ball(width, radii[i])])
    asked = prints.select(F.col("fingerprint").alias("a"), F.explode(probes).alias("key_2"))
    near = (
        (F.col("key_2") == F.col("key"))
        & (F.col("a") != F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    return asked.join(entries, near).select("a", "b")


def link_simhash(
    rows: DataFrame, key: str = "doc_id", max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """``(fingerprint, root, component_id)`` for every distinct ``fingerprint`` of ``rows``.

    ``root`` is one of the component's fingerprints, ``component_id`` is the smallest ``key`` among all rows that links reach; null keys count only
    if there are no others. Links are pairs of rows whose fingerprints differ in ``max_bits`` bits
    or fewer, equal ones included.
    """
    prints = stage(rows.groupBy("fingerprint").agg(F.min(key).alias("first")), "fingerprints")
    roots = components(near_fingerprints(prints, max_bits, segments))
    rooted = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """``(key, fingerprint, component_id)``, one row per row of ``df``.

    Null and empty texts, and texts of blanks only, have fingerprint 0 and link like any other;
    texts with fewer words than a shingle are one shingle. Repeated rows are rows of the same
    component. An empty table gives no rows.
    """
    own = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    hashed = stage(with_simhash(own, shingle=shingle).drop("text"), "simhash")
    linked = link_simhash(hashed, "key", max_bits, segments)
    return hashed.join(linked, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def keep_one(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of every component the row with the smallest key.

    If several rows have that key, one of them stays. Columns are those of ``df``.
    """
    taken = list(df.columns)
    row, print_ = spare("_row", taken), spare("fingerprint", taken)
    hashed = stage(
        with_simhash(df, text, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash"
    )
    narrow = hashed.select(F.col(print_).alias("fingerprint"), F.col(key).alias("key"), F.col(row).alias("row"))
    linked = link_simhash(narrow, "key", max_bits, segments)
    order = F.struct(F.col("key").isNull().alias("n"), F.col("key").alias("k"), F.col("row").alias("r"))
    firsts = narrow.groupBy("fingerprint").agg(F.min(order).alias("first"))
    winners = (
        firsts.join(linked, "fingerprint")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.r").alias(row))
    )
    return hashed.join(winners, row, "left_semi").select(*[F.col(f"`{c}`") for c in taken])


@query("op4_simhash")
def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    linked = near_duplicates(table(spark, sf_dir, "documents"))
    return linked.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
