"""Population-std standard scaler (the reference's scaler, not Spark ML's sample-std one).

The statistics are a long table (feature, mean, scale): one aggregate pass over the training rows,
scale = population std, 1 where the std is 0.  Applying it joins a one-row wide table (size bounded by
the feature count), so the broadcast is size-proven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from raretide.functions.scalar import literal_table


def per_feature(df: DataFrame, features: Sequence[str], aggs: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """One row a feature: ``aggs`` of its ``value`` and the columns ``keep`` over the rows of ``df`` (null where there are none).

    One pass over long rows, with a buffer per feature.  One row that holds all features' aggregates has more fields than
    Spark generates code for, and took most of a model query's time."""
    found = long_rows(df, features, keep).groupBy("_i").agg(*aggs)
    names = literal_table(df.sparkSession, list(enumerate(features)), ["_i", "feature"])
    return names.join(F.broadcast(found), "_i", "left").drop("_i")  # one row a feature


def long_rows(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, the number ``_i`` and the ``value`` of every feature: one row a feature and row of ``df``, by generated code."""
    return df.select(*keep, F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in features])).alias("_i", "value"))


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    long = per_feature(df, features, [F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")])
    return long.select("feature", "mean", F.when((F.col("std") == 0) | F.col("std").isNull(), F.lit(1.0))
                       .otherwise(F.col("std")).alias("scale"))


def apply_scaler(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """(x - mean) / scale for every feature; other columns unchanged."""
    wide = stats.groupBy().pivot("feature", list(features)).agg(F.first(F.struct("mean", "scale")))
    wide = wide.select(*[F.col(f"`{c}`").alias(f"_st_{i}") for i, c in enumerate(features)])
    j = df.crossJoin(F.broadcast(wide))
    feats = set(features)
    idx = {c: i for i, c in enumerate(features)}
    return j.select(*[((F.col(c) - F.col(f"_st_{idx[c]}.mean")) / F.col(f"_st_{idx[c]}.scale")).alias(c)
                      if c in feats else F.col(c) for c in df.columns])


def save_scaler(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def load_scaler(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def select_features(df: DataFrame, exclude: Sequence[str] = ("ts", "timestamp", "failure", "failure_24h"),
                    keep: Sequence[str] = ()) -> DataFrame:
    """All columns except the excluded ones, sorted (the model's column contract)."""
    feats = sorted(c for c in df.columns if c not in set(exclude) and c not in set(keep))
    return df.select(*keep, *feats)


def align_schema(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Order as ``features``, add missing ones as 0.0, drop the rest (reindex with fill 0)."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c).cast("double").alias(c) if c in have else F.lit(0.0).alias(c)
                              for c in features])
