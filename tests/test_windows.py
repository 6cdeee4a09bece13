"""Window operators against pandas (the reference's library) on literal series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from raretide.functions.timecols import ts_micros
from raretide.operators.scan import carry_last, with_row_index
from raretide.operators.windows import ema_lag_features, label_lead, rolling_features, with_order

T0 = dt.datetime(2024, 1, 1)


def _series(spark, values, step_minutes=60, entity=1, gaps=()):
    rows, t = [], T0
    for i, v in enumerate(values):
        t = t + dt.timedelta(minutes=step_minutes * (3 if i in gaps else 1))
        rows.append((i, entity, t, None if v is None else float(v), 0))
    return spark.createDataFrame(rows, "row_id long, entity_id long, ts timestamp_ntz, x double, failure int")


def test_half_open_frame_hourly_edges(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    df = with_order(_series(spark, vals), ["entity_id"])
    out = rolling_features(df, ["entity_id"], ["x"], spans=["1h", "6h"], slope_span="6h").orderBy("rn").toPandas()
    s = pd.Series([float(v) for v in vals], index=pd.date_range(T0 + dt.timedelta(hours=1), periods=len(vals), freq="h"))
    exp6 = s.rolling("6h", min_periods=1).mean().to_numpy()
    np.testing.assert_allclose(out["x_rolling_mean_6h"].to_numpy(), exp6)
    # exactly one row in the 1h window of an hourly series: std is undefined, range is 0
    assert out["x_rolling_std_1h"].isna().all()
    assert (out["x_rolling_range_1h"] == 0).all()
    np.testing.assert_allclose(out["x_rolling_std_6h"].to_numpy()[1:],
                               s.rolling("6h", min_periods=2).std().to_numpy()[1:])
    # slope of 1, 2, 3, ... against position is 1 wherever 2+ rows exist
    assert np.allclose(out["x_rolling_slope_6h"].to_numpy()[1:], 1.0)


def test_irregular_series_matches_pandas(spark):
    rng = np.random.default_rng(7)
    vals = list(np.round(rng.normal(50, 10, 60), 2))
    df = with_order(_series(spark, vals, step_minutes=37, gaps={5, 6, 20}), ["entity_id"])
    out = rolling_features(df, ["entity_id"], ["x"], spans=["1h", "6h", "12h"], slope_span=None).orderBy("rn").toPandas()
    s = pd.Series(vals, index=pd.to_datetime(out["ts"]))
    for span in ("1h", "6h", "12h"):
        np.testing.assert_allclose(out[f"x_rolling_mean_{span}"], s.rolling(span, min_periods=1).mean(), rtol=1e-12)
        np.testing.assert_allclose(out[f"x_rolling_max_{span}"], s.rolling(span, min_periods=1).max())
        exp = s.rolling(span, min_periods=2).var().to_numpy()
        got = out[f"x_rolling_var_{span}"].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(exp), np.isnan(got))
        np.testing.assert_allclose(got[~np.isnan(got)], exp[~np.isnan(exp)], rtol=1e-9)


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_ema_equals_pandas_at_every_block_size(spark, block):
    n, rng = 700, np.random.default_rng(3)
    vals = list(rng.normal(0, 1, n))
    for i in [*range(0, 3), *range(100, 240), *range(600, 605)]:
        vals[i] = None
    vals[50] = 1e12            # one reading far larger than all that follow
    df = with_order(_series(spark, vals), ["entity_id"])
    out = ema_lag_features(df, ["entity_id"], ["x"], block_rows=block).orderBy("rn").toPandas()
    s = pd.Series([np.nan if v is None else v for v in vals], dtype="float64")
    for span in (12, 24):
        exp = s.ewm(span=span, adjust=False).mean().to_numpy()
        got = out[f"x_ema_{span}"].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(exp), np.isnan(got))
        np.testing.assert_allclose(got[~np.isnan(got)], exp[~np.isnan(exp)], rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(out["x_lag_2"].to_numpy(dtype=float)[3:], s.shift(2).to_numpy()[3:], equal_nan=True)


def test_sparse_readings_keep_a_far_value(spark):
    """A reading every 13th row: one large early value still counts thousands of rows later."""
    n = 4000
    vals = [None] * n
    for i in range(0, n, 13):
        vals[i] = 1.0
    vals[0] = 1e200
    df = with_order(_series(spark, vals), ["entity_id"])
    out = ema_lag_features(df, ["entity_id"], ["x"], spans=[24], lags=[1], block_rows=128).orderBy("rn").toPandas()
    exp = pd.Series([np.nan if v is None else v for v in vals]).ewm(span=24, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(out["x_ema_24"].to_numpy(dtype=float), exp, rtol=1e-9)


def test_rows_without_a_key_are_a_series(spark):
    df = _series(spark, list(range(40))).withColumn("entity_id", F.when(F.col("row_id") % 5 != 0, F.col("entity_id")))
    lab = label_lead(df.withColumn("failure", F.col("x").cast("int")), ["entity_id"], horizon=2, block_rows=4).collect()
    got = {r["row_id"]: r["failure_24h"] for r in lab}
    assert len(got) == 40 and got[0] == 10 and got[35] is None and got[1] == 3
    d = with_order(df, ["entity_id"])
    out = ema_lag_features(d, ["entity_id"], ["x"], spans=[12], lags=[1], block_rows=3)
    exp = {r["row_id"]: r["e"] for r in df.toPandas().assign(e=lambda p: p.groupby("entity_id", dropna=False)["x"].transform(
        lambda s: s.ewm(span=12, adjust=False).mean())).to_dict("records")}
    assert {r["row_id"]: r["x_ema_12"] for r in out.collect()} == pytest.approx(exp)


@pytest.mark.parametrize("same_time", [False, True])
def test_split_is_exact_wherever_rows_crowd(spark, same_time):
    from raretide.operators.split import chrono_split, time_series_folds
    t = (lambda i: T0) if same_time else (lambda i: T0 + dt.timedelta(microseconds=i // 3))
    df = spark.createDataFrame([(i, t(i)) for i in range(997)], "row_id long, ts timestamp_ntz")
    got = {r["row_id"]: r["split"] for r in chrono_split(df).collect()}
    assert got == {i: "train" if i < 697 else "val" for i in range(996)}
    folds = {r["row_id"]: r["fold"] for r in time_series_folds(df).collect()}
    assert folds == {i: 0 if i < 250 else (i - 250) // 249 + 1 for i in range(997)}


def test_row_index_and_lead_across_small_blocks(spark):
    vals = list(range(40))
    df = _series(spark, vals, step_minutes=300)     # several day buckets
    lab = label_lead(df.withColumn("failure", F.col("x").cast("int")), ["entity_id"], horizon=3, block_rows=4)
    got = {r["row_id"]: r["failure_24h"] for r in lab.collect()}
    for i in range(40):
        assert got[i] == (i + 3 if i + 3 < 40 else None)
    idx = with_row_index(df.withColumn("_us", ts_micros("ts")), [], "_us", "row_id", bucket_us=3_600_000_000)
    assert sorted((r["row_id"], r["rn"]) for r in idx.collect()) == [(i, i + 1) for i in range(40)]


def test_forward_fill_across_blocks(spark):
    vals = [None, None, 1, None, None, None, 2, None, None, None, None, 3, None]
    df = with_order(_series(spark, vals), ["entity_id"])
    out = carry_last(df, ["entity_id"], "rn", ["x"], block_rows=2).orderBy("rn").toPandas()
    exp = pd.Series([np.nan if v is None else v for v in vals]).ffill().to_numpy()
    np.testing.assert_allclose(out["x"].to_numpy(dtype=float), exp, equal_nan=True)


def test_unknown_span_rejected():
    from raretide.functions.timecols import parse_span_us
    with pytest.raises(ValueError):
        parse_span_us("6 fortnights")


@pytest.mark.parametrize("gaps", [False, True])
def test_short_series_are_made_whole_and_long_ones_in_pieces(spark, monkeypatch, gaps):
    from raretide.operators import features, scan, windows
    names = []
    real = scan.written
    for module in (scan, windows):
        monkeypatch.setattr(module, "written", lambda d, name: names.append(name) or real(d, name))
    rng = np.random.default_rng(3)
    rows = []
    for key, n in ((1, 90), (2, 7), (None, 30), (4, 1)):
        for i in range(n):
            x = [None if gaps and rng.random() < 0.2 else float(v) for v in rng.integers(1, 99, 3)]
            t = None if gaps and i % 17 in (3, 4) else T0 + dt.timedelta(minutes=int(rng.integers(0, 5000)))
            rows.append((len(rows), key, t, *x, int(rng.random() < 0.1)))
    df = spark.createDataFrame(rows, "row_id long, entity_id long, ts timestamp_ntz, temperature double, vibration double, pressure double, failure int")
    feats = features.feature_names()

    def table(block):
        names.clear()
        return features.build_features(df, ["entity_id"], block_rows=block).orderBy("row_id").toPandas()

    whole, told = table(1000), list(names)
    assert not told  # no summaries, no tables on the way
    mixed, told = table(40), list(names)
    assert "long" in told and "ema" in told
    pieces = table(2 if not gaps else 5)
    for other in (mixed, pieces):
        assert whole["row_id"].tolist() == other["row_id"].tolist()
        np.testing.assert_allclose(whole[feats].to_numpy(float), other[feats].to_numpy(float), rtol=1e-9, atol=1e-9)
    leads = [windows.label_lead(df, ["entity_id"], horizon=3, block_rows=b).orderBy("row_id").select("row_id", "failure_24h").collect() for b in (1000, 40, 4)]
    assert leads[0] == leads[1] == leads[2]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_short_series_are_sorted_while_they_are_narrow(spark):
    from raretide.operators import features
    rows = [(i, i % 3, T0 + dt.timedelta(minutes=37 * i), float(i % 7), float(i % 5), float(i % 11), int(i % 13 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, entity_id long, ts timestamp_ntz, temperature double, vibration double, pressure double, failure int")
    assert _plan(label_lead(df, ["entity_id"], horizon=3)).count("Sort [") == 1
    lines = _plan(features.build_features(df, ["entity_id"])).splitlines()  # the last operator first
    sorts = [line for line in lines if "Sort [" in line]
    assert len(sorts) == 3
    last_sort = lines.index(sorts[0])
    assert any("Window [lag(" in line for line in lines[:last_sort]) and not any("MapInArrow" in line for line in lines[:last_sort])


def test_features_of_one_split_are_those_of_both(spark, tmp_path):
    from raretide.plans.q_models import reading_features
    rows = [(i, i % 4 or None, T0 + dt.timedelta(minutes=31 * i), "error" if i % 9 == 0 else "view", float(i * 7 % 300), '{"k": %d}' % (i % 50)) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    both = reading_features(spark, str(tmp_path))
    for split in ("train", "val"):
        one = reading_features(spark, str(tmp_path), split)
        assert one.count() == both.where(F.col("split") == split).count() > 0
        assert one.exceptAll(both).count() == 0


def test_contribution_sums_shuffle_no_long_rows(spark):
    from raretide.operators.explain import contribution_sums, contributions
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, None), (None, 5.0, 1.0), (2, 0.5, 0.25)], "row_id long, a double, b double")
    weights = spark.createDataFrame([("a", 2.0, 1.0), ("b", -1.0, 0.5)], "feature string, weight double, mean double")
    found = contribution_sums(df, weights, ["a", "b"])
    long = contributions(df, weights, ["a", "b"]).groupBy("row_id").agg(F.count_distinct("feature").alias("features"), F.sum("contribution").alias("total"))
    assert sorted(map(str, found.collect())) == sorted(map(str, long.collect()))
    above = _plan(found).split("Generate")[0]  # what comes after the long rows
    assert "hashpartitioning" not in above and "hashpartitioning" in _plan(found)
