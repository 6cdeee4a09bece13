"""The one-pass features of whole series against the window operators, bit for bit."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from raretide.operators.features import SENSORS, build_features, feature_names
from raretide.plans.spec import NARROW, NUDGE, spark_project


def _rows(spark, sensor_type="double"):
    rng, rows = random.Random(5), []
    for i in range(400):
        entity = rng.choice([1, 2, 3, None, 4])
        # ties, gaps of more than a window, dense runs, rows without a time
        ts = None if rng.random() < 0.03 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.choice([0, 7, 30, 59, 60, 360, 720, 721, 3000]) + 5 * rng.randrange(300))
        value = [None if rng.random() < p else math.nan if rng.random() < 0.01 else rng.choice([20.0, 20.1, rng.gauss(50, 9)]) for p in (0.0, 0.2, 0.05)]
        rows.append((i, entity, ts, *(v if sensor_type == "double" or v is None else float(round(v)) if v == v else None for v in value), int(rng.random() < 0.05), rng.choice(["train", "val"])))
    rows.append((1000, 9, dt.datetime(2024, 1, 1), 1.0, 2.0, 3.0, 0, "val"))  # a series of one row
    rows.append((1001, 10, None, 1.0, 2.0, 3.0, 0, "val"))  # and one without a time
    t = spark.createDataFrame(rows, "row_id long, entity_id long, ts timestamp_ntz, temperature double, vibration double, pressure double, failure int, split string")
    return t if sensor_type == "double" else t.withColumns({s: F.col(s).cast(sensor_type) for s in SENSORS})


def _made(df, only=None, drop=False, one_pass=True):
    out = build_features(df, ["entity_id"], SENSORS, split_col="split", only=only, drop_incomplete=drop, one_pass=one_pass)
    return out.columns, sorted(map(repr, map(tuple, out.collect())))


@pytest.mark.parametrize("only", [None, ["pressure_ema_12", "temperature"], ["vibration_lag_2", "pressure_roc_1"], ["temperature_rolling_slope_6h"],
                                  ["pressure_delta_mean_1h_6h", "hours_since_last_failure"], ["vibration_rolling_range_12h", "temperature_rolling_std_1h"]])
def test_one_pass_equals_windows(spark, only):
    df = _rows(spark).cache()
    plain = _made(df, only, one_pass=False)
    assert _made(df, only, True, True) == _made(df, only, True, False)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in (before, "7"):  # series that go on over many batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            assert _made(df, only) == plain
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(plain[1]) > 380


def test_whole_series_need_no_sliding_windows(spark):
    made = build_features(_rows(spark), ["entity_id"], SENSORS, split_col="split", one_pass=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "var_samp" not in plan and "regr_slope" not in plan
    assert set(feature_names(SENSORS)) <= set(made.columns)


def test_sensors_of_other_types(spark):
    """Sensors that are not doubles are left to the windows."""
    df, cols = _rows(spark, "int"), ["temperature_rolling_mean_6h", "vibration_lag_1"]
    assert _made(df, cols) == _made(df.withColumns({s: F.col(s).cast("double") for s in SENSORS}), cols)
    assert build_features(df, ["entity_id"], SENSORS, only=["temperature_rolling_max_6h"], one_pass=True).count() > 0


def test_wide_rows_are_rounded_as_spark_does(spark):
    """Doubles of a wide row, halves in the last digit and odd values included, as F.round gives them."""
    rng = random.Random(3)
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, -1e-9, 1e20, -1e300, 5e11 + 0.1234565, 2.5e-7]
    values = odd + [rng.choice([1, -1]) * round(rng.uniform(0, 10 ** rng.randrange(6)), 7) for _ in range(1500)] + [round(rng.uniform(0, 9), 6) + 5e-7 for _ in range(1500)] \
        + [rng.gauss(0, 1) * 10 ** rng.randrange(-8, 14) for _ in range(1500)]
    names = [f"c{i}" for i in range(NARROW + 2)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double").select("id", *[F.col("x").alias(c) for c in names])
    got = spark_project(df, "id:l " + " ".join(f"{c}:{t}" for c, t in zip(names, ["d", "v", "d3"] + ["d"] * NARROW)))
    x = F.col("x")
    want = df.withColumnRenamed("c0", "x").select("id", F.round(x, 6) + F.lit(0.0), F.round(x * F.lit(NUDGE), 4) + F.lit(0.0), F.round(x, 3) + F.lit(0.0))
    assert sorted(map(repr, map(tuple, got.select("id", *names[:3]).collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
