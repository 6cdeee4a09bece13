"""Readers and writers: reading tables (CSV with header or parquet), split and report sinks.

Paths are shared-storage folders; nothing is written to a machine-local folder by library code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

READING_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()), T.StructField("pressure", T.DoubleType()),
    T.StructField("failure", T.IntegerType())])


def read_readings(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    """Reading table with a fixed schema (no inference); ``timestamp`` parsed to TIMESTAMP_NTZ as ``ts``;
    NaN sensor values become NULL."""
    if fmt == "csv":
        df = spark.read.schema(schema or READING_SCHEMA).option("header", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if "timestamp" in df.columns:
        df = df.withColumn("ts", F.col("timestamp").cast("timestamp_ntz")).drop("timestamp")
    for c in ("temperature", "vibration", "pressure"):
        if c in df.columns:
            df = df.withColumn(c, F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(F.col(c)))
    return df


def write_readings_csv(df: DataFrame, path: str) -> None:
    out = df.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop("ts")
    out.write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """One folder per split value (``split=train``, ``split=val``)."""
    df.write.mode("overwrite").partitionBy(split_col).format(fmt).option("header", True).save(path)


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """Report tables as CSV with header, one folder each; a table that grows (one row per score) keeps its partitions."""
    for name, df in reports.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
