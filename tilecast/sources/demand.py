"""Readers and writers for demand tables: CSV (plain, gzip, bzip2, zip) and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.schema import DEMAND
from tilecast.sources.zipped import zip_csv_source, zip_writer


def read_demand(
    spark: SparkSession, path: str, schema: T.StructType = DEMAND, format: str | None = None
) -> DataFrame:
    """Read a demand table: ``format`` csv, zip or parquet, or what the file extension says."""
    kind = format or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "zip":
        return read_zip_csv(spark, path, schema)
    if kind == "parquet":
        return read_table(spark, path)
    return read_csv(spark, path, schema)


def _typed(field: T.StructField) -> Column:
    """A text column as ``field``: whole numbers may be written 1.0, and NaN is a missing number."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text
    number = text.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number.cast(field.dataType).alias(field.name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = DEMAND) -> DataFrame:
    """CSV with a header. Columns are taken by header name, so extra ones are ignored.

    What is no number in a number's column is NULL.
    """
    raw = spark.read.option("header", True).csv(path)
    return raw.select([_typed(f) for f in schema])


def read_zip_csv(spark: SparkSession, path: str, schema: T.StructType = DEMAND) -> DataFrame:
    """Zipped CSV with headers, which Spark's own reader cannot open: one archive, or a folder of them.

    Every member of an archive is a partition of its own, inflated as a stream. A member does not
    split, so its rows are spread over the cluster straight after.
    """
    spark.dataSource.register(zip_csv_source())
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.format("zip_csv").schema(as_text).load(path)
    return rows.repartition(spark.sparkContext.defaultParallelism).select([_typed(f) for f in schema])


def write_zip_csv(df: DataFrame, path: str) -> None:
    """Write a folder of archives, one per task with one CSV member, each under its name only once it is whole."""
    names = df.columns
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    texts.mapInArrow(zip_writer(path, names), "written string").count()


def write_table(df: DataFrame, path: str) -> None:
    """Save a completed or scored table, one folder per day, so that day ranges prune files.

    The rebalance hint gathers rows by day into files of the session's advisory size: no folder of
    tiny files, and no single task writing a whole large day.
    """
    df.hint("rebalance", F.col("day")).write.mode("overwrite").partitionBy("day").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_predictions(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Write forecasts as a folder of CSV files with a header, or of Parquet files."""
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
