"""Session helpers: the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session; a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="siteconcord-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# Whether a query's shuffle files are deleted when it ends instead of when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes below which partitions of a shuffle are put together even where cores are idle.
LEAST_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over the cores: a table of few bytes comes in one split, however much work its rows are.

    Two partitions a core, since setting up a task with long expressions takes about half a second.
    """
    spark = df.sparkSession
    return df.repartition(min(shuffle_partitions(spark), 2 * spark.sparkContext.defaultParallelism))


def materialized(df: DataFrame, label: str = "step", heavy: bool = False) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage and survives the loss of executors.

    Nothing reads the shuffles behind a written table again, so their files go as soon as it stands. With `heavy`, rows that
    are few bytes but much work, a small shuffle is not gathered into one task.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    wanted = {SHUFFLE_CLEANUP: "true"} | ({LEAST_PARTITION: "64k"} if heavy else {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(folder)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again. Each must be one that `materialized` gave."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm = df.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
