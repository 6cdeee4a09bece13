"""Streamed features and scores equal the batch operators, with out-of-order and late files; sinks survive a replayed batch."""

import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
READING = "row_id long, entity_id long, ts timestamp_ntz, temperature double, vibration double, pressure double, failure int"
T0 = datetime(2024, 1, 1)


def made_readings(seed=1, entities=6, n=60):
    """Irregular series with null runs, equal times, failures and an entity without a single complete reading."""
    r = random.Random(seed)
    rows, k = [], 0
    for e in range(entities):
        t = T0 + timedelta(minutes=r.randrange(60))
        for i in range(n):
            t += timedelta(minutes=r.choice([0, 3, 20, 59, 60, 61, 200, 700]), microseconds=r.randrange(3) if i % 5 else 0)
            x = [None if r.random() < 0.25 or (e == 0 and j == 1) else round(r.uniform(10, 90), 2) for j in range(3)]
            rows.append((k, e, t, *x, int(r.random() < 0.1)))
            k += 1
    return rows


def equal_tables(streamed, batch, names, key="row_id"):
    s, b = (d.toPandas().sort_values(key).reset_index(drop=True) for d in (streamed, batch))
    assert s[key].tolist() == b[key].tolist() and len(s)
    for c in names:
        np.testing.assert_allclose(s[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-8, err_msg=c)


def slices_of(rows, late_share, seed):
    """Four deliveries by time; some rows come one delivery later, within the hour (out of order) or long after (late)."""
    r = random.Random(seed)
    rows = sorted(rows, key=lambda x: x[2])
    size = len(rows) // 4 + 1
    slices = [[] for _ in range(4)]
    for i, x in enumerate(rows):
        k = i // size
        slices[min(3, k + (r.random() < late_share))].append(x)
    for s in slices:
        r.shuffle(s)
    kept, seen = [], None
    for s in slices:
        kept += [x for x in s if seen is None or x[2] > seen]
        top = max(x[2] for x in s) - timedelta(hours=1)
        top = top.replace(microsecond=top.microsecond // 1000 * 1000)  # watermarks have milliseconds
        seen = top if seen is None else max(seen, top)
    return slices, kept


def test_streamed_features_equal_batch_on_all_but_late_rows(spark):
    from raretide.operators.features import build_features, feature_names
    from raretide.streaming import ops as S
    from raretide.streaming.features import stream_features
    slices, kept = slices_of(made_readings(), 0.15, 5)
    assert len(kept) < 360
    end = [(-1, None, T0 + timedelta(days=400), None, None, None, 0)]
    frames = [spark.createDataFrame(s, READING) for s in (*slices, end)]
    streamed = S.run_slices(frames, frames[0].schema, stream_features, "test")
    batch = build_features(spark.createDataFrame(kept, READING), ["entity_id"])
    equal_tables(streamed, batch, feature_names())


def test_release_in_any_pieces_gives_the_same(spark):
    """State carried over releases of any size: equal to one release of the whole series."""
    from raretide.streaming.features import Release
    rows = sorted((x for x in made_readings(3, 1, 400)), key=lambda x: (x[2], x[0]))
    work = Release(["temperature", "vibration", "pressure"])
    us = np.array([int((x[2] - T0) / timedelta(microseconds=1)) for x in rows])
    x = np.array([x[3:6] for x in rows], dtype=float)
    failure = np.array([x[6] for x in rows])
    whole = work.rows(work.empty(), us, failure, x)
    r = random.Random(2)
    for most in (1, 7, 90):
        st, at, out = work.empty(), 0, []
        while at < len(us):
            to = min(len(us), at + r.randint(1, most))
            while to < len(us) and us[to] == us[to - 1]:  # rows of one time are released together
                to += 1
            out.append(work.rows(st, us[at:to], failure[at:to], x[at:to]))
            at = to
        np.testing.assert_allclose(np.vstack(out), whole, rtol=1e-9, atol=1e-9, equal_nan=True)
        assert st["n"] == len(us) and len(st["past_us"]) < len(us)


@pytest.mark.parametrize("n, minutes", [(25, 300), (300, 9)])
def test_entities_released_together_equal_each_alone(n, minutes):
    """One release of many series, with short and long windows, gaps, equal times and an infinity that stays with its series."""
    from raretide.streaming.features import Release
    work, r, idle = Release(["temperature", "vibration", "pressure"]), np.random.default_rng(n), int(30 * 86400e6)
    m = 5
    together, alone, last = work.empty(m), [work.empty() for _ in range(m)], np.zeros(m, dtype=np.int64)
    for release in range(3):
        of = np.repeat([e for e in range(m) if e != release], n)
        step = r.choice([0, 1, minutes, 2 * minutes], len(of)) * 60_000_000
        step[0::n] += 40 * 86_400_000_000 if release == 2 else 1  # the last one after a silence
        us = np.concatenate([last[e] + np.cumsum(step[of == e]) for e in np.unique(of)])
        last[np.unique(of)] = us[n - 1::n]
        x = r.normal(1e4, 3.0, (len(of), 3))
        x[r.random(x.shape) < 0.2] = np.nan
        x[of == 4] *= 1e6
        if release != 1:
            x[n // 2, 0] = np.inf
        failure = (r.random(len(of)) < 0.1).astype(int)
        out = work.series(together, of, us, failure, x, idle)
        for e in np.unique(of):
            at = of == e
            own = work.series(alone[e], np.zeros(n, dtype=np.int64), us[at], failure[at], x[at], idle)
            np.testing.assert_array_equal(out[at], own)
            assert np.isfinite(own[:, 10:]).any() and (e == of[0] or not np.isinf(own).any())


def test_entities_share_a_state(spark, tmp_path):
    """The state has a row a bucket, whatever the number of entities; keys may be null or beyond 2^53, and readings without a time are left out."""
    from raretide.operators.features import build_features, feature_names
    from raretide.streaming.features import stream_features
    keys = [None, 2**53 + 1, 2**53 + 2, *range(297)]
    rows = [(4 * i + j, k, T0 + timedelta(hours=5 * j, minutes=i % 50), 20.0 + i % 7 + j, 1.0 + j * i % 3, 100.0 - j, int(i % 9 == j)) for i, k in enumerate(keys) for j in range(4)]
    untimed = [(9000 + i, k, None, 50.0, 5.0, 50.0, 1) for i, k in enumerate(keys[:5])]
    end = [(-1, None, T0 + timedelta(days=3), None, None, None, 0)]
    progress = []
    for part in (rows[::2] + rows[1::2] + untimed, end):
        spark.createDataFrame(part, READING).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(READING).parquet(f"{tmp_path}/in")
        q = (stream_features(stream, buckets=4).writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        progress.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert 0 < max(progress) <= 4
    streamed = spark.read.parquet(f"{tmp_path}/out").where("row_id >= 0")
    assert {r[0] for r in streamed.select("entity_id").distinct().collect()} == set(keys)
    known = [(i, -5 if k is None else k, *rest) for i, k, *rest in rows]  # the batch operator leaves out rows without a key
    equal_tables(streamed, build_features(spark.createDataFrame(known, READING), ["entity_id"]), feature_names())


def test_silent_entities_leave_the_state(spark):
    from raretide.streaming import ops as S
    from raretide.streaming.features import stream_features
    first = [(i, 7, T0 + timedelta(hours=i), 20.0 + i, 1.0, 100.0, 0) for i in range(5)]
    later = [(50, 8, T0 + timedelta(days=3), 1.0, 1.0, 100.0, 0)]
    back = [(60, 7, T0 + timedelta(days=4), 5.0, 1.0, 100.0, 0)]
    end = [(-1, None, T0 + timedelta(days=400), None, None, None, 0)]
    frames = [spark.createDataFrame(s, READING) for s in (first, later, back, end)]
    out = {r["row_id"]: r for r in S.run_slices(frames, frames[0].schema, lambda d: stream_features(d, idle="1 day"), "idle").collect()}
    assert out[4]["temperature_lag_1"] == 23.0 and out[60]["temperature_lag_1"] == 0.0 and out[60]["temperature_ema_12"] == 5.0


@pytest.fixture(scope="module")
def fitted(spark):
    """A table of features with a label that follows the temperature, and artifacts of three kinds."""
    from raretide.operators import artifact as A
    from raretide.operators.features import build_features, feature_names
    from raretide.session import written
    rows = made_readings(8, 8, 80)
    feats = build_features(spark.createDataFrame(rows, READING), ["entity_id"]).withColumn("failure_24h", (F.col("temperature_lag_1") > 60).cast("int"))
    feats = written(feats, "fitted")
    names = feature_names()
    return rows, feats, {"linear": A.fit_linear_artifact(feats, names), "logistic_regression": A.fit_artifact(feats, names, "logistic_regression", params={"maxIter": 20}),
                         "random_forest": A.fit_artifact(feats, names, "random_forest", params={"numTrees": 5, "maxDepth": 4})}


@pytest.mark.parametrize("kind", ["linear", "logistic_regression", "random_forest"])
def test_a_loaded_artifact_scores_alike_on_stream_and_batch(spark, fitted, kind, tmp_path):
    from raretide.operators import artifact as A
    from raretide.streaming import ops as S
    from raretide.streaming.features import stream_features
    rows, feats, artifacts = fitted
    A.save_artifact(artifacts[kind], f"{tmp_path}/artifact")
    loaded = A.load_artifact(f"{tmp_path}/artifact")
    want = {r["row_id"]: r["score"] for r in A.score(artifacts[kind], feats).select("row_id", "score").collect()}
    assert {r["row_id"]: r["score"] for r in A.score(loaded, feats).select("row_id", "score").collect()} == want
    assert len(set(want.values())) > 2
    if kind != "random_forest":  # one kind on a stream: all are column expressions
        return
    slices, _ = slices_of(rows, 0.0, 4)
    frames = [spark.createDataFrame(s, READING) for s in (*slices, [(-1, None, T0 + timedelta(days=400), None, None, None, 0)])]
    got = S.run_slices(frames, frames[0].schema, lambda d: S.stream_score(stream_features(d), loaded), f"score-{kind}").collect()
    assert {r["row_id"] for r in got} == set(want)
    for r in got:
        assert abs(r["failure_probability"] - want[r["row_id"]]) < 1e-4 and r["decision"] == ("ALERT" if want[r["row_id"]] >= 0.3 else "SAFE")
        assert r["time"] == r["ts"].isoformat(timespec="microseconds")


def test_the_linear_score_is_code_that_can_be_compiled(spark, fitted):
    """No generated method is beyond the 8,000 bytes that the JVM compiles, and the score is the sum's logistic."""
    from raretide.operators import artifact as A
    from raretide.operators.features import feature_names
    from raretide.streaming import ops as S
    _, feats, artifacts = fitted
    plan = S.stream_score(feats, artifacts["linear"])._jdf.queryExecution().executedPlan()
    stages = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    assert all(stages.apply(i)._3().maxMethodCodeSize() <= 8000 for i in range(stages.size()))
    scaler, scorer = artifacts["linear"].stages
    means, scales, weights = (np.array(m.getOrDefault(p)) for m, p in ((scaler, "means"), (scaler, "scales"), (scorer, "weights")))
    rows = A.score(artifacts["linear"], feats).select("score", "row_id").join(feats.select("row_id", *feature_names()), "row_id").toPandas()
    x = rows[feature_names()].to_numpy(dtype=float)
    np.testing.assert_allclose(rows["score"], 1 / (1 + np.exp(-(scorer.getOrDefault("intercept") + ((x - means) / scales) @ weights))), rtol=1e-12)


def test_an_artifact_loads_in_a_fresh_session(spark, fitted, tmp_path):
    """Another Python process reads the artifact and the features from disk and gives the same scores."""
    import subprocess
    import sys

    from raretide.operators import artifact as A
    _, feats, artifacts = fitted
    A.save_artifact(artifacts["random_forest"], f"{tmp_path}/artifact")
    feats.write.parquet(f"{tmp_path}/features")
    want = A.score(artifacts["random_forest"], feats).agg(F.sum("score"), F.count("*")).first()
    code = f"""
from pyspark.sql import functions as F
from raretide.operators import artifact as A
from raretide.session import get_spark
spark = get_spark("local[2]", 2)
row = A.score(A.load_artifact("{tmp_path}/artifact"), spark.read.parquet("{tmp_path}/features")).agg(F.sum("score"), F.count("*")).first()
print("SCORES", repr(row[0]), row[1])
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "PYSPARK_DRIVER"))} | {"PYTHONPATH": root, "RARETIDE_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    line = next(x for x in out.stdout.splitlines() if x.startswith("SCORES"))
    assert abs(float(line.split()[1]) - want[0]) < 1e-9 and int(line.split()[2]) == want[1]


def test_missing_and_extra_columns_follow_the_contract(spark, fitted):
    from raretide.operators import artifact as A
    _, feats, artifacts = fitted
    scaler = artifacts["linear"].stages[0]
    out = scaler.transform(feats.drop("pressure").withColumn("other", F.lit("x")))
    assert out.agg(F.max(F.abs("pressure"))).first()[0] == 0.0 and out.where("other = 'x'").count() == feats.count()
    means = scaler.transform(feats).agg(*[F.avg(c) for c in ("temperature", "vibration_pressure")], F.stddev_pop("temperature")).first()
    assert abs(means[0]) < 1e-9 and abs(means[1]) < 1e-9 and abs(means[2] - 1) < 1e-9


def test_single_readings_are_series_of_one_row(spark):
    from raretide.operators.features import build_features, feature_names, single_reading_features
    rows = [(i, i, *r[2:6], 0) for i, r in enumerate(made_readings(2, 2, 20))]
    df = spark.createDataFrame(rows, READING)
    equal_tables(single_reading_features(df), build_features(df, ["entity_id"]), feature_names())


def test_two_sinks_are_idempotent_and_complete(spark, fitted, tmp_path):
    from raretide.sources.fixtures import requests_of
    from raretide.streaming import ops as S
    rows, _, artifacts = fitted
    requests = requests_of(spark.createDataFrame(rows, READING).na.drop())
    half = requests.where("row_id % 2 = 0"), requests.where("row_id % 2 = 1")
    for part in half:  # two deliveries, two batches
        part.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(requests.schema).parquet(f"{tmp_path}/in")
        S.serve_requests(stream, artifacts["linear"], f"{tmp_path}/out").awaitTermination()

    def sinks():
        drop = "responded_at"
        return [sorted(map(tuple, S.read_sink(spark, f"{tmp_path}/out", name).drop(drop).collect())) for name in S.SINKS]

    before = sinks()
    assert {x[-1] for x in before[0]} == {0, 1}
    assert sorted([x[0] for s in before for x in s]) == sorted(r["row_id"] for r in requests.collect())
    assert {x[0] for x in before[1]} == {r["row_id"] for r in requests.collect() if r["row_id"] % 17 == 0 or r["row_id"] % 23 == 0}
    again = S.score_requests(half[1], artifacts["linear"])
    S.two_sinks(f"{tmp_path}/out")(again, 1)  # the batch runs once more
    assert sinks() == before
    S.two_sinks(f"{tmp_path}/out")(again.limit(0), 2)  # a batch without rows
    assert sinks() == before


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_late_rows_are_dropped_by_windows_and_dedupe(spark):
    """Events that come far behind the watermark neither change a closed window nor pass the de-duplication."""
    from raretide.streaming import ops as S
    events = spark.read.parquet(f"{SF}/events.parquet")
    day = F.dayofmonth("ts")
    first, second, late = events.where(day <= 20), events.where(day > 20), events.where(day == 2).limit(5)
    volume = S.run_slices([first, second, late, S.heartbeat(events, "3 days")], S.EVENTS_SCHEMA, S.stream_alert_volume, "late-volume")
    want = {r[0]: r[1] for r in events.groupBy(F.to_date("ts")).count().collect()}
    got = {r["window_start"].date(): r["readings"] for r in volume.collect()}
    assert got == want
    once = S.run_slices([first, second, late, S.heartbeat(events)], S.EVENTS_SCHEMA, S.stream_dedupe, "late-dedupe")
    assert once.where("row_id >= 0").count() == events.count()
