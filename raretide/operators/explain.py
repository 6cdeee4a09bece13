"""Sampling and additive explanations for linear scorers.

For a linear model the exact additive contribution of feature j is w_j * (x_j - mean_j) (base value =
the model output at the mean), so contributions are SQL: the (feature, weight, mean) table has one row
per feature (size-proven broadcast), rows go to long form with ``stack`` and are aggregated per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from raretide.functions.scalar import literal_table
from raretide.operators.scale import long_rows, per_feature

SAMPLE_SIZE = 1000
SAMPLE_SEED = 42
_MULT = 2654435761
_MOD = 4294967296


def sample_key(id_col: str = "row_id", seed: int = SAMPLE_SEED) -> Column:
    """Deterministic pseudo-random order key (multiplicative hash of the id), identical in any SQL engine.
    The id is first reduced mod 2^31 so that the product stays inside BIGINT."""
    return F.pmod(F.pmod(F.col(id_col), F.lit(1 << 31)) * F.lit(_MULT) + F.lit(seed), F.lit(_MOD))


def sample_rows(df: DataFrame, n: int = SAMPLE_SIZE, id_col: str = "row_id", seed: int = SAMPLE_SEED) -> DataFrame:
    """``n`` rows in hash order (all rows when there are fewer) — the sampling operator (limit is the feature)."""
    return df.orderBy(sample_key(id_col, seed), F.col(id_col)).limit(n)


def pick_failure_row(df: DataFrame, label: str = "failure_24h", id_col: str = "row_id",
                     seed: int = SAMPLE_SEED) -> DataFrame:
    return sample_rows(df.where(F.col(label) == 1), 1, id_col, seed)


def contributions(df: DataFrame, weights: DataFrame, features: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """Long table (id, feature, value, contribution) with contribution = weight * (value - mean)."""
    numbered = literal_table(df.sparkSession, list(enumerate(features)), ["_i", "feature"]).join(weights.select("feature", "weight", "mean"), "feature")
    j = long_rows(df, features, [id_col]).join(F.broadcast(numbered), "_i")  # one row a feature
    return j.select(id_col, "feature", "value", (F.col("weight") * (F.col("value") - F.col("mean"))).alias("contribution"))


def contribution_sums(df: DataFrame, weights: DataFrame, features: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """(id, features = how many have a contribution, total = their sum).

    Rows are dealt out by id while they are wide, so the long rows, one a feature, are not shuffled."""
    long = contributions(df.repartition(id_col), weights, features, id_col)
    return long.groupBy(id_col).agg(F.count_distinct("feature").alias("features"), F.sum("contribution").alias("total"))


def mean_abs_contribution(contrib: DataFrame) -> DataFrame:
    """(feature, importance = mean |contribution|), highest first."""
    return (contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
            .orderBy(F.col("importance").desc(), F.col("feature")))


def separation_weights(train: DataFrame, stats: DataFrame, features: Sequence[str], label: str = "failure_24h") -> DataFrame:
    """A closed-form linear scorer from the training data: w_j = (mean_pos_j - mean_neg_j) / scale_j.

    Deterministic and exact, so its explanations are SQL-checkable; trained Spark ML linear models use
    ``weights_from_model``."""
    y = F.col(label) == 1
    long = per_feature(train, features, [F.avg(F.when(y, F.col("value"))).alias("mean_pos"), F.avg(F.when(~y, F.col("value"))).alias("mean_neg")], [label])
    j = long.join(F.broadcast(stats), "feature")
    return j.select("feature", (F.coalesce(F.col("mean_pos") - F.col("mean_neg"), F.lit(0.0)) / F.col("scale")).alias("weight"),
                    "mean")


def weights_from_model(spark, model, features: Sequence[str], stats: DataFrame) -> DataFrame:
    """(feature, weight, mean) from a fitted Spark ML linear model (one row per feature)."""
    coef = [float(v) for v in model.coefficients.toArray()]
    w = literal_table(spark, list(zip(features, coef)), ["feature", "weight"])
    return w.join(F.broadcast(stats.select("feature", "mean")), "feature")
