"""Readers with explicit schemas: no job infers a type from the data."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, line_sep: str | None = None, header: bool = True,
) -> DataFrame:
    """CSV with quoted text; a missing field is null, a quoted empty one is "". ``schema`` replaces the names of the header line.

    With ``line_sep`` only that mark ends a row, so text may hold ``\\r``.
    Without it, quoted text may span lines, which keeps one file in one task;
    large files should be written with ``line_sep``.
    """
    reader = (
        spark.read.schema(schema).option("header", header).option("quote", '"').option("escape", '"')
        .option("enforceSchema", True).option("mode", "FAILFAST").option("nullValue", r"\N")
    )
    reader = reader.option("lineSep", line_sep) if line_sep else reader.option("multiLine", True)
    return reader.csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON record per line, nested fields by schema."""
    return spark.read.schema(schema).json(path)


def scan_folder(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json", name_pattern: str = r"^(.*)\.[^.]*$",
    tag: str = "tag", **options,
) -> DataFrame:
    """All files of a folder in one scan, tagged by a part of the file name."""
    rows = spark.read.schema(schema).options(**options).format(fmt).load(path)
    # The metadata name is percent-encoded; a plus sign in it is literal.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return rows.select("*", F.regexp_extract(name, name_pattern, 1).alias(tag))


def word_vector_lines(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(word, v, rejected) per line ``word v1 … vd``; a line with another number of values is in ``rejected`` alone."""
    cells = F.split("value", " ")
    fits = F.size(cells) == dim + 1
    return spark.read.text(path).select(
        F.when(fits, cells[0]).alias("word"), F.when(fits, F.slice(cells, 2, dim).cast("array<float>")).alias("v"),
        F.when(~fits, F.col("value")).alias("rejected"),
    )


def read_word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(word, v) of every line; fails on a line with another number of values."""
    lines = word_vector_lines(spark, path, dim)
    stop = F.raise_error(F.concat(F.lit(f"not a word and {dim} values: "), F.substring("rejected", 1, 80)))
    return lines.select(F.when(F.col("rejected").isNull(), F.col("word")).otherwise(stop).alias("word"), "v")


def read_features(spark: SparkSession, path: str, array_col: str = "embedding", vector_col: str = "features") -> DataFrame:
    """Parquet feature bundle with the array also as an ML vector."""
    rows = spark.read.parquet(path)
    return rows.withColumn(vector_col, array_to_vector(F.col(array_col).cast("array<double>")))
