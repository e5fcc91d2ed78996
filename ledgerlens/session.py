"""Session defaults and durable cut points."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_bytes(spark: SparkSession) -> int:
    """Spark's own bound for broadcast sides; -1 when broadcasting is off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="ledgerlens-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own, not yet made, below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that lost executors cost no recompute of it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(writer: DataFrameWriter) -> DataFrameWriter:
    """Tables of the job's own are kept in zstd, which takes about two thirds of the space of Spark's default."""
    return writer.option("compression", "zstd")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints of frames that are gone.

    It finds out about them when the driver collects its garbage, which a driver with little to do hardly does
    before the files of a whole job lie on the disks of the executors.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a table and read back: unlike a checkpoint its columns are read singly."""
    compact(df.write.mode("overwrite")).parquet(path)
    # With the schema at hand no job has to look for it in the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, in bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread_work(df: DataFrame, key: str, bytes_per_task: int = 8 << 20) -> DataFrame:
    """Deal a stored table to tasks of about ``bytes_per_task``, one a core at least, for work that costs more than moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-plan_bytes(df) // bytes_per_task)), key)


def spread_small(df: DataFrame, key: str, bytes_per_task: int = 32 << 20) -> DataFrame:
    """Use all cores for a table that is too small to be split into enough tasks.

    Tables with at least ``bytes_per_task`` for every core are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if plan_bytes(df) < cores * bytes_per_task else df


def fewer_tasks(df: DataFrame, rows: int, rows_per_task: int = 1 << 18) -> DataFrame:
    """``df`` of about ``rows`` short rows in tasks of about ``rows_per_task``, one a core at least, without a shuffle.

    A shuffle of few rows otherwise has as many tasks, files and events as one of many.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // rows_per_task)))


def few_files(df: DataFrame, source: DataFrame, bytes_per_task: int = 8 << 20) -> DataFrame:
    """``df``, which has no more bytes than the stored table ``source``, in tasks of about ``bytes_per_task`` of that, one a core at least.

    Like ``fewer_tasks`` without a shuffle, so that a small table isn't written as a file for every partition.
    Not for a stage with a shuffled hash join: a task keeps the hash maps of all of its partitions to its end.
    """
    return fewer_tasks(df, min(plan_bytes(source), bytes_per_task << 20), bytes_per_task)
