"""Curves, thresholds and reports on literal scored tables (edge cases of the reference)."""

import pytest
from pyspark.sql import functions as F

from raretide.operators import curves as C
from raretide.operators import evaluate as E
from raretide.operators import thresholds as T


def _scored(spark, rows):
    return spark.createDataFrame([(i, None, y, s) for i, (y, s) in enumerate(rows)],
                                 "row_id long, ts timestamp_ntz, label int, score double")


def test_pr_auc_small_example(spark):
    # scores 0.9(+) 0.8(-) 0.7(+) 0.1(-): points (r, p) = (.5, 1), (.5, .5), (1, 2/3), (1, .5) + end (0, 1)
    s = _scored(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)])
    a = C.pr_areas(s).first()
    exp = 0.5 * (1 + 1) / 2 + 0 + 0.5 * (0.5 + 2 / 3) / 2 + 0
    assert a["pr_auc"] == pytest.approx(exp)
    assert a["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert a["n_points"] == 5


def test_all_scores_equal(spark):
    s = _scored(spark, [(1, 0.3), (0, 0.3), (0, 0.3)])
    pts = C.pr_curve(s).collect()
    assert len(pts) == 1 and pts[0]["precision"] == pytest.approx(1 / 3) and pts[0]["recall"] == 1.0
    # the optimisers drop the highest (only) threshold: the searches have nothing to choose from
    assert C.pr_curve(s, drop_max_threshold=True).count() == 0


def test_one_class_confusion_never_fails(spark):
    s = _scored(spark, [(0, 0.2), (0, 0.7)])
    cm = E.confusion(s, 0.5).first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (1, 1, 0, 0)
    m = E.threshold_metrics(s, 0.5).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0


def test_recall_target_and_budget(spark):
    rows = [(1, 0.95), (0, 0.9), (1, 0.8), (0, 0.6), (0, 0.5), (1, 0.4), (0, 0.3), (0, 0.2)]
    s = _scored(spark, rows)
    r = T.for_recall(s, 0.6).first()
    # thresholds (top dropped): 0.2..0.9; recall >= 0.6 means t <= 0.8; best precision 2/3 at t = 0.8
    assert r["threshold"] == 0.8 and r["precision"] == pytest.approx(2 / 3) and not r["fallback"]
    b = T.for_alert_budget(s, 1).first()   # max rate = 1 / (8 / 24) = 3: every threshold qualifies
    assert b["precision"] == pytest.approx(2 / 3) and b["threshold"] == 0.8


def test_bucket_topk_null_below_24_rows(spark):
    s = _scored(spark, [(1, 0.5)] * 10).withColumn("ts", F.current_timestamp().cast("timestamp_ntz"))
    assert E.bucket_topk_precision(s).first()["top_5_precision"] is None


def test_sweep_grid_matches_numpy():
    import numpy as np
    assert T.sweep_grid() == [float(v) for v in np.linspace(0.01, 0.99, 50)]


def test_threshold_sweep_equals_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    rows = [(int(rng.random() < 0.2), float(np.round(rng.random(), 2))) for _ in range(300)]
    s = _scored(spark, rows)
    grid = T.sweep_grid() + [0.5, 0.0, 1.0]
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in T.threshold_sweep(s, grid).collect()}
    for t in set(grid):
        tp = sum(1 for y, sc in rows if sc >= t and y == 1)
        fp = sum(1 for y, sc in rows if sc >= t and y == 0)
        fn = sum(1 for y, sc in rows if sc < t and y == 1)
        tn = sum(1 for y, sc in rows if sc < t and y == 0)
        assert got[t] == (tp, fp, fn, tn), t


def test_rounding_of_narrow_results_is_that_of_round(spark):
    """Bit for bit, on halves, large and special values; away from a half no decimal is made."""
    from pyspark.sql import functions as F
    from raretide.plans.spec import rounded, spark_project
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1e300, -1e18, 5e-7, -5e-7, 1e-320, 0.0000015, 2.5, 123456789.1234565, -7.00005, 0.30000000000000004]
    d = spark.createDataFrame([(v,) for v in odd], "x double").union(
        spark.range(20000).select(F.expr("CASE pmod(id, 3) WHEN 0 THEN (id + 0.5D) / 1e6D WHEN 1 THEN -(id * 10 + 5) / 1e5D ELSE exp(id / 400D - 25) END")))
    for k in (4, 6):
        same = F.hex(F.xxhash64(rounded(F.col("x"), k) + F.lit(0.0))) == F.hex(F.xxhash64(F.round("x", k) + F.lit(0.0)))
        assert d.where(~same).count() == 0
    plan = spark_project(d, "x:v")._jdf.queryExecution().analyzed().toString().lower()
    assert "case when" in plan
