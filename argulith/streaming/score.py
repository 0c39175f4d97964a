"""Scoring of arriving texts in micro-batches.

The scoring plan is the batch plan: a stateless projection. Each input row gives one output row,
once: the file sink and the checkpoint together survive lost executors and restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def text_stream(
    spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 8,
    name_pattern: str | None = None, file_format: str = "parquet",
) -> DataFrame:
    """Files of a folder as a stream; ``files_per_batch`` bounds one micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.load(folder)


def stream_score(
    requests: DataFrame, scoring: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
    wait: str | None = None,
) -> StreamingQuery:
    """Score a stream into Parquet files.

    With ``wait`` (for example ``'1 second'``) it runs until stopped; without, it takes what is
    there and ends.
    """
    writer = scoring(requests).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=wait) if wait else writer.trigger(availableNow=True)
    return writer.start(out)


def answer_requests(
    requests: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
    key: str = "request_id", asked: str = "asked_at", late: str = "1 hour", wait: str | None = None,
) -> StreamingQuery:
    """One answer per request: ``answer`` turns a micro-batch of requests into rows, which go to ``out`` by batch.

    A request that is repeated while its time is no more than ``late`` behind the newest is answered once; rows
    without a key count as one request. ``answer`` is any batch plan, joins and searches included. A
    micro-batch replaces its own folder, so one that runs again after a failure changes nothing. Read with
    ``answers``. Ends when it has taken what is there, unless ``wait`` names an interval.
    """
    once = requests.withWatermark(asked, late).dropDuplicatesWithinWatermark([key])

    def write(batch: DataFrame, number: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=wait) if wait else writer.trigger(availableNow=True)
    return writer.start()


def answers(spark: SparkSession, out: str) -> DataFrame:
    """All answers so far, with the ``batch`` that gave them."""
    return spark.read.parquet(out)
