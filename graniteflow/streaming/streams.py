"""The record statistics and scoring in streaming form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graniteflow.session import scratch_path


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the Parquet files of a folder whose names match ``pattern``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def hourly_counts(stream: DataFrame, time: str, tag: str, late: str | None = None) -> DataFrame:
    """Rows per tumbling hour and tag. With ``late``, rows behind that watermark are dropped and the
    state of older hours is freed; without it every row counts, and the state is a row per hour and tag."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late) if late else timed
    return timed.groupBy(F.window(time, "1 hour").alias("w"), tag).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").cast("timestamp_ntz").alias("hour_start"), tag, "n"
    )


def running_source_stats(stream: DataFrame, tag: str, values: list[str]) -> DataFrame:
    """Running rows and means per tag; the state is one row per tag."""
    return stream.groupBy(tag).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"mean_{v}") for v in values])


def score(stream: DataFrame, features: Callable[[DataFrame], DataFrame], model) -> DataFrame:
    """Stateless feature extraction and scoring with a stored model."""
    return model.transform(features(stream))


def append_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process all available input into a Parquet table and read it back.

    Finished rows only: a window is written once the watermark has passed its end.
    The sink's log makes a retried batch count once.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def latest_totals(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Process all available input and return the aggregates as they stand, one row per ``keys``.

    Every batch writes its changed rows to a folder of its own in a shared table, which a
    retry overwrites; the latest row of a key counts. Open windows are included.
    """
    spark = stream.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    spark.createDataFrame([], stream.schema).write.parquet(f"{out}/batch=-1")

    def store(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", state).trigger(
        availableNow=True
    ).start().awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    latest = F.max_by(F.struct(*values), "batch").alias("_v")
    return spark.read.parquet(out).groupBy(*keys).agg(latest).select(*keys, "_v.*").select(*stream.columns)
