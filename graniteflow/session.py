"""Session settings, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "graniteflow", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on and a UTC clock; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary
    folder of this machine; a cluster session must name a shared one.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="graniteflow-")
        spark.conf.set(_CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and freezes row placement."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once as columns to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_disk(spark: SparkSession) -> None:
    """Let go of what no table refers to any more.

    Spark deletes the shuffles (and, if so configured, the checkpoints) of finished steps when the
    driver collects its garbage, which a driver with little to do leaves until long after a loop.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions_for(df: DataFrame) -> int:
    """Task count for an explicit shuffle: the session's own shuffle width."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of a scan with fewer splits than cores before heavy row work.

    A scan that already fills the cluster is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


BROADCAST_BYTES = 64 * 1024 * 1024


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast a join side whose counted size is within the limit; else leave the join to the planner."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
