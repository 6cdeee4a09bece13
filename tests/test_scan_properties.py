"""Property tests: the piecewise scans equal plain pandas on random keyed series, for any piece size."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st

from raretide.functions.timecols import ts_micros
from raretide.operators.scan import carry_last, carry_max, in_pieces, prefix_sums, with_row_index
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def _frame(seed, n, n_keys):
    rng = np.random.default_rng(seed)
    minutes = np.cumsum(rng.integers(1, 240, n))
    keys = rng.integers(0, n_keys, n)
    vals = np.where(rng.random(n) < 0.3, np.nan, np.round(rng.normal(0, 1, n), 3))
    flag = (rng.random(n) < 0.1).astype(int)
    return pd.DataFrame({"row_id": np.arange(n), "k": keys, "ts": [T0 + dt.timedelta(minutes=int(m)) for m in minutes],
                         "x": vals, "f": flag})


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), block=st.sampled_from([1, 3, 7, 1000]), bucket_h=st.sampled_from([1, 5, 24]))
def test_scans_equal_pandas(spark, seed, block, bucket_h):
    pdf = _frame(seed, 120, 3)
    df = spark.createDataFrame(pdf.astype({"x": "object"}).where(pdf.notna(), None),
                               "row_id long, k long, ts timestamp_ntz, x double, f int").withColumn("_us", ts_micros("ts"))
    d = with_row_index(df, ["k"], "_us", "row_id", bucket_us=bucket_h * 3_600_000_000, total_name="_n")
    d = carry_last(d.withColumn("y", F.col("x")), ["k"], "rn", ["y"], block_rows=block, total="_n")
    d = carry_max(d, ["k"], "_us", F.when(F.col("f") == 1, F.col("_us")), "lf", bucket_us=bucket_h * 3_600_000_000)
    d = prefix_sums(d.withColumn("one", F.lit(1)), ["k"], "rn", F.floor((F.col("rn") - 1) / block), ["one"])
    got = d.toPandas().sort_values("row_id").reset_index(drop=True)
    exp = pdf.sort_values(["k", "ts", "row_id"]).copy()
    exp["rn"] = exp.groupby("k").cumcount() + 1
    exp["y"] = exp.groupby("k")["x"].ffill()
    us = (exp["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    exp["lf"] = us.where(exp["f"] == 1).groupby(exp["k"]).cummax()
    exp["lf"] = exp.groupby("k")["lf"].ffill()
    exp = exp.sort_values("row_id").reset_index(drop=True)
    assert got["rn"].tolist() == exp["rn"].tolist()
    assert got["cum_one"].tolist() == exp["rn"].tolist()
    np.testing.assert_allclose(got["y"].to_numpy(dtype=float), exp["y"].to_numpy(dtype=float), equal_nan=True)
    np.testing.assert_allclose(got["lf"].to_numpy(dtype=float), exp["lf"].to_numpy(dtype=float), equal_nan=True)


def _crowd(spark, n=3000):
    """One key has most rows of one day, half of them at one instant; other keys are small, one is null."""
    rng = np.random.default_rng(5)
    at = np.where(rng.random(n) < 0.5, 7_000_000, rng.integers(0, 3_600_000_000, n))
    pdf = pd.DataFrame({"row_id": rng.permutation(n), "k": np.where(rng.random(n) < 0.8, 1, rng.integers(2, 5, n)), "_us": at,
                        "f": (rng.random(n) < 0.01).astype(int)})
    df = spark.createDataFrame(pdf, "row_id long, k long, _us long, f int").withColumn("k", F.nullif("k", F.lit(4)))
    return pdf, df


def test_a_crowded_bucket_is_cut_and_scans_stay_the_same(spark):
    pdf, df = _crowd(spark)
    d = with_row_index(df, ["k"], "_us", "row_id", total_name="_n", piece_rows=100)
    d = carry_max(d, ["k"], "_us", F.when(F.col("f") == 1, F.col("_us")), "lf", piece_rows=100)
    got = d.toPandas().sort_values("row_id").reset_index(drop=True)
    exp = pdf.sort_values(["k", "_us", "row_id"]).copy()
    exp["rn"] = exp.groupby("k").cumcount() + 1
    exp["lf"] = exp["_us"].where(exp["f"] == 1)
    exp["lf"] = exp.groupby(["k", "_us"])["lf"].transform("max").groupby(exp["k"]).cummax().groupby(exp["k"]).ffill()
    exp = exp.sort_values("row_id").reset_index(drop=True)
    assert got["rn"].tolist() == exp["rn"].tolist()
    assert got["_n"].tolist() == exp.groupby("k")["row_id"].transform("count").tolist()
    np.testing.assert_allclose(got["lf"].to_numpy(dtype=float), exp["lf"].to_numpy(dtype=float), equal_nan=True)


def test_pieces_of_a_crowded_bucket_are_bounded(spark):
    _, df = _crowd(spark)
    sizes = in_pieces(df, ["k"], "_us", tiebreak="row_id", rows=100).groupBy("k", "_bkt").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 150 and sizes[1] > 30
    whole = in_pieces(df, ["k"], "_us", rows=100).groupBy("k", "_bkt").agg(F.count("*").alias("n"), F.count_distinct("_us").alias("i"))
    assert whole.where("n > 150 AND i > 1").count() == 0  # without a tiebreak only one instant may fill a piece
    plain = in_pieces(df, ["k"], "_us", tiebreak="row_id")
    assert plain.schema["_bkt"].dataType.simpleString() == "bigint"  # nothing crowded: the plan is the plain one


def test_instants_without_a_time_are_a_piece(spark):
    df = spark.createDataFrame([(i, 1, None) for i in range(50)], "row_id long, k long, _us long")
    got = with_row_index(df, ["k"], "_us", "row_id", piece_rows=10).orderBy("row_id").toPandas()
    assert got["rn"].tolist() == list(range(1, 51))
