"""Requests that arrive as a stream, with repeats and replays."""

import shutil

import pytest
from pyspark.sql import functions as F

from argulith.catalog import QUERIES
from argulith.streaming.score import answer_requests, answers, text_stream

SCHEMA = "request_id long, asked_at timestamp, text string"


def put(spark, folder, rows):
    df = spark.createDataFrame(rows, "request_id long, second long, text string")
    df.select("request_id", F.timestamp_seconds(F.col("second") + 1_700_000_000).alias("asked_at"), "text").coalesce(1).write.mode("append").parquet(folder)


def serve(spark, folder, out, checkpoint):
    arriving = text_stream(spark, folder, SCHEMA, files_per_batch=1)
    plan = lambda batch: batch.select("request_id", F.upper("text").alias("answer"))
    answer_requests(arriving, plan, out, checkpoint).awaitTermination()
    return sorted((r["request_id"], r["answer"]) for r in answers(spark, out).collect())


def test_each_request_is_answered_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("requests", "out", "checkpoint"))
    for batch in range(4):
        put(spark, folder, [(batch * 10 + n, batch * 60 + n, f"text {batch * 10 + n}") for n in range(5)] + [(0, batch * 60, "text 0")])
    want = sorted((b * 10 + n, f"TEXT {b * 10 + n}") for b in range(4) for n in range(5))
    assert serve(spark, folder, out, checkpoint) == want
    assert answers(spark, out).select("batch").distinct().count() >= 4
    # A request that comes again in a later run is not answered again; a new one is.
    put(spark, folder, [(31, 200, "text 31"), (99, 201, "text 99")])
    assert serve(spark, folder, out, checkpoint) == sorted([*want, (99, "TEXT 99")])


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("requests", "out", "checkpoint"))
    for batch in range(4):
        put(spark, folder, [(batch * 10 + n, batch, f"text {n}") for n in range(3)])
    first = serve(spark, folder, out, checkpoint)
    # As after a failure between writing a batch and committing it: the last commits are lost.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    kept = tmp_path / "lost"
    kept.mkdir()
    shutil.move(commits[-1], kept)
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{commits[-1].name}.crc"):
        shutil.move(crc, kept)
    assert serve(spark, folder, out, checkpoint) == first and len(first) == 12


@pytest.mark.parametrize("files", [0, 3])
def test_a_table_that_streams_is_a_file_or_a_folder_of_files(spark, tmp_path, files):
    rows = [(n, [1.0, 0.0] if n % 2 else [0.0, 1.0], n % 2) for n in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    if files:
        df.repartition(files).write.parquet(f"{tmp_path}/embeddings.parquet")
    else:
        df.coalesce(1).write.parquet(f"{tmp_path}/parts")
        shutil.copy(next((tmp_path / "parts").glob("*.parquet")), tmp_path / "embeddings.parquet")
    scored = QUERIES["stream_score"](spark, str(tmp_path)).collect()
    assert sorted((r["vec_id"], r["fallacy"]) for r in scored) == [(n, n % 2) for n in range(20)]
