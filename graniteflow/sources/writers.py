"""Sinks, stored intermediates and stored models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from graniteflow.session import scratch_path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, **options) -> str:
    """Write one folder; returns its path. CSV keeps a header and doubles quotes."""
    if fmt == "csv":
        options = {"header": True, "quote": '"', "escape": '"', **options}
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return path


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write an expensive intermediate to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_at(spark, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse the table at ``path`` when it was completed before, else build it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not files.exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
