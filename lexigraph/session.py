"""Session defaults and the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no folder, as in local tests.
LOCAL_SHARED = "/tmp/checkpoints"
_made: list[str] = []


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lexigraph") -> SparkSession:
    """A local session with the settings that the library is tuned for."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, else the one that setCheckpointDir() was called with. Only a local session gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(LOCAL_SHARED)
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; clear_scratch() removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Removes the folders that scratch() named in this process and gives their number. Call it when results are saved: tables that were made from them cannot be read any more."""
    n = 0
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage is cut and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """checkpoint() in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Asks the driver to forget what nothing refers to any more.

    Shuffle files of rounds that are over stay on the executors' disks until the driver's JVM collects its garbage,
    which on a large heap may be long after a job of many rounds.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
