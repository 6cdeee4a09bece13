"""Class statistics and weights (grouped aggregates with map-side partial aggregation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def class_distribution(df: DataFrame, label: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """total, positives, negatives, positive_rate of ``label`` (failure_24h if present else failure)."""
    label = label or ("failure_24h" if "failure_24h" in df.columns else "failure")
    y = F.col(label).cast("long")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(y), F.lit(0)).alias("positives"),
        (F.count(F.lit(1)) - F.coalesce(F.sum(y), F.lit(0))).alias("negatives"),
        F.avg(y.cast("double")).alias("positive_rate"),
    )


def split_period(df: DataFrame, split_col: str = "split", ts: str = "ts") -> DataFrame:
    return df.groupBy(split_col).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"),
                                     F.count(F.lit(1)).alias("rows"))


def class_weights(df: DataFrame, label: str = "failure_24h") -> DataFrame:
    """Balanced weights n / (n_classes * count_c), one row per class present."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("count"))
    allw = Window.partitionBy()   # the grouped table has one row per class: at most a handful of rows
    return counts.select(
        "label", "count",
        (F.sum("count").over(allw).cast("double")
         / (F.count(F.lit(1)).over(allw).cast("double") * F.col("count").cast("double"))).alias("weight"))


def scale_pos_weight(df: DataFrame, label: str = "failure_24h") -> DataFrame:
    y = F.col(label).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).cast("long").alias("positives"),
                  (F.sum(F.lit(1.0) - y) / F.nullif(F.sum(y), F.lit(0.0))).alias("scale_pos_weight"))


def with_weights(df: DataFrame, label: str = "failure_24h", weight_col: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row (the weight table has one row per class)."""
    w = class_weights(df, label).select(F.col("label").alias("_lbl"), F.col("weight").alias(weight_col))
    return df.join(F.broadcast(w), F.col(label).cast("int") == F.col("_lbl"), "left").drop("_lbl")


def data_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long table (column, rows, nulls, distinct_values) — integrity check before training.  Distinct values are exact:
    one pass per column, grouped by value with map-side combine."""
    cols = list(cols or df.columns)
    out = None
    for c in cols:
        by_value = df.groupBy(F.col(f"`{c}`").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        part = by_value.agg(F.lit(c).alias("column"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"), F.count("_v").alias("distinct_values"))
        out = part if out is None else out.unionByName(part)
    return out.select("rows", "column", "nulls", "distinct_values")
