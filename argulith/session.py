"""Sessions, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "argulith") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; there, and only there, a temporary folder is
    made once and kept as the session's checkpoint folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="argulith-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder, under the application's name, that nobody has used before."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged; frames that read it are of no use afterwards."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For plans that go over the same expensive input several times: later passes read only the
    columns they need, and a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, purpose)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over all cores if its files give fewer partitions than there are cores.

    For costly work on small files; a table of many row groups is returned as it is. Only for
    plans without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
