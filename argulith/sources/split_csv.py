"""CSV files whose cells may span lines, read by as many tasks as their bytes fill.

A line alone does not tell whether it starts a record or goes on inside a quoted cell; that depends on
all quotes before it. So every byte range first tells where it ends for both ways it may begin, a
window over one narrow row per range composes these maps, and a second pass cuts records. A record that
crosses ranges leaves one piece in each, and only such pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from argulith.session import stage

_SUMMARY = "path string, start long, after_outside boolean, after_inside boolean"
_PIECES = "path string, start long, place long, opens boolean, record binary"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order inside each byte range; a lone carriage return is no line end."""
    lines = spark.read.text(path, lineSep="\n").select("value", "_metadata.file_path", "_metadata.file_block_start")
    return lines.select(F.col("value").cast("binary").alias("value"), F.col("file_path").alias("path"), F.col("file_block_start").alias("start"))


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open after ``line``, which begins inside one or at the start of a record.

    A cell is quoted if its first character is a quote; quotes elsewhere in an unquoted cell are text, two quotes in
    a quoted one are one, and what follows a closing quote runs to the next comma.
    """
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside = False
        elif line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        at = line.find(b",", at) + 1
        if not at:
            return False


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The batch cut where its path or byte range changes."""
    paths, starts = batch.column("path").dictionary_encode(), batch.column("start").to_numpy(zero_copy_only=False)
    codes = paths.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(starts)]):
        if high > low:
            yield paths.dictionary[int(codes[low])].as_py(), int(starts[low]), batch.column("value").slice(low, high - low)


def _without_mark(line: bytes, start: int, first: bool) -> bytes:
    return line.removeprefix(b"\xef\xbb\xbf") if first and start == 0 else line


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range: is a quoted cell open after it, had it begun outside, had it begun inside."""
    names = ["path", "start", "after_outside", "after_inside"]
    current: list = []
    for batch in batches:
        done = []
        for path, start, lines in _ranges(batch):
            if current[:2] != [path, start]:
                if current:
                    done.append(current)
                current, first = [path, start, False, True], True
            for line in lines.filter(pc.match_substring(lines, b'"')) if not (first and start == 0) else lines:
                text = _without_mark(line.as_py(), start, first)
                current[2:] = ends_inside(text, current[2]), ends_inside(text, current[3])
                first = False
            first = False
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in current], names=names)


def _begun_inside(summaries: DataFrame) -> DataFrame:
    """Summaries with ``inside``: whether the range begins in a quoted cell. Windows over one narrow row per range.

    A range either fixes the state after it, or keeps it, or turns it; so the state is that of the last range that
    fixed it, turned as often as ranges since then turned it.
    """
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("after_outside") == F.col("after_inside")
    turns = F.when(F.col("after_outside") & ~F.col("after_inside"), 1).otherwise(0)
    upto = Window.partitionBy("path").orderBy("start")
    counted = summaries.withColumn("turned", F.sum(turns).over(upto))
    # The state that the last fixing range left, less the turns up to it.
    left = F.when(fixed, (F.col("after_outside").cast("int") + F.col("turned")) % 2)
    base = F.coalesce(F.last(left, ignorenulls=True).over(before), F.lit(0))
    turned = F.coalesce(F.max("turned").over(before), F.lit(0))
    return counted.select("path", "start", ((base + turned) % 2 == 1).alias("inside"))


def _cut_records(known: dict[tuple[str, int], bool]):
    """Pieces of every range: place 0 ends a record begun earlier, ``opens`` says that the last one does not end here."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("opens", pa.bool_()), ("record", pa.binary())]
        )
        key: tuple[str, int] | None = None
        held: list[bytes] = []
        place, inside, first = 0, False, True

        def rows(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            out: list = []
            for path, start, lines in _ranges(batch):
                if key != (path, start):
                    if held:
                        out.append((*key, place, True, b"\n".join(held)))
                    key, held, first = (path, start), [], True
                    if key not in known:
                        raise RuntimeError(f"the byte ranges of {path} changed between two reads")
                    inside = known[key]
                    place = 0 if inside else 1
                quoted = pc.match_substring(lines, b'"').to_pylist()
                for line, has_quote in zip(lines.to_pylist(), quoted):
                    line = _without_mark(line, start, first)
                    first = False
                    if has_quote:
                        inside = ends_inside(line, inside)
                    held.append(line)
                    if not inside:
                        out.append((path, start, place, False, b"\n".join(held)))
                        held, place = [], place + 1
            if out:
                yield rows(out)
        if held:
            yield rows([(*key, place, True, b"\n".join(held))])

    return cut


def _joined(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records in pieces, put together: a piece belongs to the last range before it in which a record opened."""
    opened = pieces.filter("opens AND place > 0").select("path", "start").withColumn("opened", F.col("start"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owners = ranges.join(opened, ["path", "start"], "left").withColumn("owner", F.last("opened", ignorenulls=True).over(before))
    heads = pieces.filter("place = 0").join(owners.select("path", "start", "owner"), ["path", "start"])
    tails = pieces.filter("opens AND place > 0").withColumn("owner", F.col("start"))
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    return (
        heads.unionByName(tails)
        .groupBy("path", "owner")
        .agg(parts.alias("parts"), F.max(F.when(F.col("place") > 0, F.col("place"))).alias("place"))
        .select(
            "path",
            F.col("owner").alias("start"),
            "place",
            F.array_join(F.transform("parts", lambda p: p["record"].cast("string")), "\n").alias("record"),
        )
    )


def read_split_csv(spark: SparkSession, path: str, in_order: bool = False) -> DataFrame:
    """The rows of Spark's multi-line CSV reader (header, doubled quotes, strings), any file read by many tasks.

    Rows are staged. Files are UTF-8; lines end in a line feed or, if the first one does, in carriage return and line feed, which
    then also become a line feed inside cells. Empty lines between records are skipped, each file's first record is its header,
    columns are named by the first file. Rows come in any order; ``in_order`` sorts them by file and place. What the driver holds is
    a path, a number and a flag for every byte range (``spark.sql.files.maxPartitionBytes``). Two passes over the bytes;
    if executors come or go in between and the ranges change, the read fails instead of giving other rows.
    """
    schema = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False).schema
    lines = _lines(spark, path)
    summaries = stage(lines.mapInArrow(_summaries, _SUMMARY), "csv_ranges")
    ranges = _begun_inside(summaries)
    known = {(r["path"], r["start"]): r["inside"] for r in ranges.toLocalIterator()}
    pieces = stage(lines.mapInArrow(_cut_records(known), _PIECES), "csv_records")
    whole = pieces.filter("NOT opens AND place > 0").select("path", "start", "place", F.col("record").cast("string").alias("record"))
    records = whole.unionByName(_joined(pieces.filter("opens OR place = 0"), ranges))
    seen = records.filter("record NOT IN ('', '\\r')").withColumn("crlf", F.substring_index("record", "\n", 1).endswith("\r"))
    first = seen.groupBy("path").agg(F.min(F.struct("start", "place", "crlf")).alias("header"))
    body = records.join(first, "path").filter(F.struct("start", "place") != F.struct("header.start", "header.place"))
    ended = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    body = body.withColumn("record", F.when(F.col("header.crlf"), ended).otherwise(F.col("record"))).filter("record <> ''")
    if in_order:
        body = body.orderBy("path", "start", "place")
    return body.select(F.from_csv("record", schema.toDDL(), {"escape": '"', "multiLine": "true"}).alias("cells")).select("cells.*")
