"""Line dedup by overlapping three-line windows.

Every three consecutive lines are a window. Windows that occur more than once in the whole table are
found by their hashes; of each, the first occurrence stays and later ones go: all lines that some
later occurrence covers are removed, overlapping occurrences merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.llm.common import query, spare, table
from argulith.session import stage

LINES = 3
BLANK_LINE = r"^[\x20\x09-\x0D]*$"


def window_hashes(text: Column, lines: int = LINES) -> Column:
    """(hi, lo) of every window in order, 96 bits; null where all its lines are blank.

    64 bits would give false repeats among the trillions of windows of a large corpus.
    """
    split = F.split(text, "\n", -1)
    marked = F.transform(
        split,
        lambda line: F.struct(
            F.xxhash64(line).alias("hi"), F.hash(line).alias("lo"), line.rlike(BLANK_LINE).alias("blank")
        ),
    )

    def window(parts: Column, at: Column) -> Column:
        inside = [F.get(parts, at + i) for i in range(lines)]
        blank = inside[0]["blank"]
        for part in inside[1:]:
            blank = blank & part["blank"]
        both = F.struct(
            F.xxhash64(*[p["hi"] for p in inside]).alias("hi"), F.hash(*[p["lo"] for p in inside]).alias("lo")
        )
        return F.when(~blank, both)

    def windows(parts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(parts) - lines)
        return F.when(F.size(parts) >= lines, F.transform(starts, lambda at: window(parts, at)))

    return F.element_at(F.transform(F.array(marked), windows), 1)


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", lines: int = LINES) -> DataFrame:
    """``df`` with the lines of later occurrences of repeated windows taken out of ``text``.

    Lines are what stands between line feeds, compared as they are; windows of blank lines only are
    never repeats. Occurrences are ordered by ``key`` (null last), then the text's hash, then the
    position, so a text may lose lines that it has itself earlier. Adds ``removed``: the positions
    of the lines taken out, ascending. Texts of fewer than three lines have no window and stay as they
    are; a text all of whose lines go becomes empty; null stays null. Rows repeated whole (same key
    and text) are one occurrence: they lose the same lines. Rows without a key are each their own, told
    apart by a row number, for which they are staged. An empty table gives no rows.

    Windows travel as hashes and are counted with partial sums, so a passage in a third of all
    documents is no hot spot; only the join by repeated hash is skewed, which the engine splits. Whole
    texts move once, to meet the positions they lose.
    """
    taken = list(df.columns)
    removed, doc, row, lost_key, lost_doc, lost_row = (
        spare(n, taken) for n in ("removed", "_doc", "_row", "_lost_key", "_lost_doc", "_lost_row")
    )
    unknown = F.col(key).isNull()
    numbered = stage(df.filter(unknown).withColumn(row, F.monotonically_increasing_id()), "no_key")
    df = df.filter(~unknown).withColumn(row, F.lit(0).cast("long")).unionByName(numbered)
    own = F.struct(unknown.alias("n"), F.col(key).alias("k"), F.xxhash64(text).alias("t"), F.col(row).alias("r"))
    placed = df.select(own.alias("doc"), F.posexplode(window_hashes(F.col(text), lines)).alias("at", "window"))
    placed = placed.filter(F.col("window").isNotNull()).select("doc", "at", "window.hi", "window.lo")
    firsts = (
        placed.groupBy("hi", "lo")
        .agg(F.min(F.struct("doc", "at")).alias("first"), F.max(F.struct("doc", "at")).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(F.col("hi").alias("hi_2"), F.col("lo").alias("lo_2"), "first")
    )
    repeats = placed.join(firsts, (F.col("hi") == F.col("hi_2")) & (F.col("lo") == F.col("lo_2")))
    later = repeats.filter(F.struct("doc", "at") != F.col("first"))
    covered = F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + lines - 1)))
    losses = later.groupBy("doc").agg(F.sort_array(F.array_distinct(covered)).alias(removed)).select(
        F.col("doc.k").alias(lost_key), F.col("doc.t").alias(lost_doc), F.col("doc.r").alias(lost_row), removed
    )
    split = F.split(F.col(text), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(removed))
    kept = F.array_join(F.transform(left, lambda at: F.get(split, at)), "\n")
    joined = df.withColumn(doc, F.xxhash64(text)).join(
        losses,
        F.col(key).eqNullSafe(F.col(lost_key)) & (F.col(doc) == F.col(lost_doc)) & (F.col(row) == F.col(lost_row)),
        "left",
    )
    columns = [
        F.when(F.col(removed).isNull(), F.col(text)).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`")
        for c in taken
    ]
    none = F.array().cast("array<int>")
    return joined.select(*columns, F.coalesce(F.col(removed), none).alias(removed))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), w AS (
  SELECT doc_id, unnest(range(0, len(parts) - 2)) AS pos, parts FROM l WHERE len(parts) >= 3
), h AS (
  SELECT doc_id, pos, parts[pos + 1] AS a, parts[pos + 2] AS b, parts[pos + 3] AS c FROM w
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS n FROM h
  WHERE NOT regexp_full_match(a || b || c, '[\x20\x09-\x0D]*')
), gone AS (
  SELECT DISTINCT doc_id, pos + i AS pos FROM r, (VALUES (0), (1), (2)) AS v(i) WHERE n > 1
), lines AS (
  SELECT doc_id, unnest(range(0, len(parts))) AS pos, unnest(parts) AS line FROM l
), kept AS (
  SELECT lines.doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY lines.doc_id
)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(l.parts) - coalesce(k.n, 0) END AS n_removed
FROM documents d JOIN l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier three-line window."""
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"))
