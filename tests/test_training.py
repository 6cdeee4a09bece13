"""Certificates, search, embargoed folds and the resumable pipeline."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    from raretide.session import written
    d = spark.range(600, numPartitions=2).select(F.col("id").alias("row_id"), (F.lit(T0) + F.make_dt_interval(hours=F.col("id"))).cast("timestamp_ntz").alias("ts"),
                                                 *[F.randn(i).alias(c) for i, c in enumerate(NAMES)])
    return written(d.withColumn("failure_24h", (F.col("a") + 0.5 * F.col("b") + F.randn(7) > 1).cast("int")), "training")


def test_certificate_holds_for_the_fit_and_fails_for_others(spark, rows):
    from raretide.operators import models as M
    model = M.train(rows, NAMES, "logistic_regression")

    class Other:
        """The fitted penalty with coefficients of one's own."""
        def __init__(self, coefficients, intercept):
            self.coefficients, self.intercept = self, intercept
            self.values = coefficients

        def toArray(self):
            return self.values

        def getRegParam(self):
            return model.getRegParam()

    def stationary(m):
        g = {r["feature"]: r for r in M.penalised_gradient(m, rows, NAMES).collect()}
        most = max(abs(r["at_zero"]) for r in g.values())
        assert set(g) == {*NAMES, "(intercept)"}
        return all(abs(r["gradient"]) <= M.STATIONARY * most for r in g.values())

    coef = [float(v) for v in model.coefficients.toArray()]
    assert stationary(model)
    assert not stationary(Other([0.0] * 3, 0.0)) and not stationary(Other([2 * c for c in coef], float(model.intercept)))
    assert not stationary(Other([c + 0.1 * (i == 1) for i, c in enumerate(coef)], float(model.intercept)))


def test_gradient_is_the_derivative_of_the_loss(spark, rows):
    from raretide.operators import models as M
    data = [(r["a"], r["b"], r["c"], r["failure_24h"]) for r in rows.collect()]
    ones = sum(r[3] for r in data)
    weight = {1: len(data) / (2 * ones), 0: len(data) / (2 * (len(data) - ones))}
    model = M.train(rows, NAMES, "logistic_regression", params={"maxIter": 2})
    w, b, reg = [float(v) for v in model.coefficients.toArray()], float(model.intercept), model.getRegParam()

    def loss(w, b):
        out = 0.0
        for *x, y in data:
            z = b + sum(p * q for p, q in zip(w, x))
            out += weight[y] * (math.log1p(math.exp(z)) - y * z)
        return out / sum(weight[r[3]] for r in data) + reg / 2 * sum(v * v for v in w)

    got = {r["feature"]: r["gradient"] for r in M.penalised_gradient(model, rows, NAMES).collect()}
    e = 1e-6
    for i, c in enumerate(NAMES):
        up, down = ([v + s * e * (j == i) for j, v in enumerate(w)] for s in (1, -1))
        assert abs(got[c] - (loss(up, b) - loss(down, b)) / (2 * e)) < 1e-6
    assert abs(got["(intercept)"] - (loss(w, b + e) - loss(w, b - e)) / (2 * e)) < 1e-6


def test_search_beats_random_draws_and_repeats():
    from raretide.operators import tuning as T
    space = T.SEARCH_SPACES["gbt"]

    def score(p):
        return -(math.log(p["stepSize"] / 0.05)) ** 2 - ((p["maxDepth"] - 5) / 5) ** 2 - 4 * (p["subsamplingRate"] - 0.9) ** 2

    def best(seed, startup):
        return max(s for _, s in T.search(space, lambda ps: [score(p) for p in ps], 60, seed, startup=startup))

    seeds = range(15)
    guided, drawn = [best(s, T.STARTUP) for s in seeds], [best(s, 10 ** 9) for s in seeds]
    assert statistics.mean(guided) > statistics.mean(drawn) and sum(g > d for g, d in zip(guided, drawn)) >= 10
    once = T.search(space, lambda ps: [score(p) for p in ps], 30, 3, at_once=4)
    assert once == T.search(space, lambda ps: [score(p) for p in ps], 30, 3, at_once=4) and len(once) == 30
    for p, _ in once:
        for name, (kind, low, high) in space.items():
            v = float(p[name])
            assert low - 1e-3 <= v <= high + 1e-3 and (kind != "int" or p[name] == int(v))


def test_density_is_one_over_the_unit_interval():
    from raretide.operators.tuning import Density
    for values in ([0.5], [0.0, 0.01, 0.99], [0.2] * 5):
        d = Density(values)
        assert abs(sum(math.exp(d.log((i + 0.5) / 2000)) for i in range(2000)) / 2000 - 1) < 1e-3
        r = random.Random(1)
        assert all(0 <= d.draw(r) < 1 for _ in range(200))


def test_embargo_takes_the_rows_before_each_test_block(spark, rows):
    from raretide.operators.split import time_series_folds
    from raretide.operators.tuning import cross_validate, training_rows
    folded = time_series_folds(rows, 3, embargo_rows=24).cache()
    plain = {r["row_id"]: r["fold"] for r in time_series_folds(rows, 3).collect()}
    assert {r["row_id"]: r["fold"] for r in folded.collect()} == plain
    for fold in (1, 2, 3):
        first = min(i for i, f in plain.items() if f == fold)
        assert {r["row_id"] for r in training_rows(folded, fold).collect()} == set(range(first - 24))

    def scorer(train, test):
        return test.select(F.col("failure_24h").alias("label"), F.col("a").alias("score"))

    one, three = (cross_validate(folded, scorer, 3, parallelism=k) for k in (1, 3))
    assert one == three and [x["train_rows"] for x in one] == [126, 276, 426] and [x["test_rows"] for x in one] == [150] * 3
    assert all(0.2 < x["average_precision"] < 1 for x in one)
    with pytest.raises(ValueError):
        time_series_folds(rows, 3, embargo_rows=150)


def test_tuned_parameters_repeat_and_are_used(spark, rows):
    from raretide.operators import models as M
    space = {"stepSize": ("log", 0.05, 0.3), "maxDepth": ("int", 1, 2), "maxIter": ("int", 1, 2)}
    first = M.tune(rows, NAMES, 2, space=space, at_once=2, n_splits=2, embargo_rows=24)
    again = M.tune(rows, NAMES, 2, space=space, at_once=2, n_splits=2, embargo_rows=24)
    assert first.orderBy("trial").collect() == again.orderBy("trial").collect()
    best = M.best_params(first)
    model = M.train(rows, NAMES, "gbt", params=best)
    assert model.getNumTrees == best["maxIter"] and model.getMaxDepth() == best["maxDepth"]


READING = "row_id long, entity_id long, ts timestamp_ntz, temperature double, vibration double, pressure double, failure int"
SMALL = {"logistic_regression": {"maxIter": 3}, "random_forest": {"numTrees": 2, "maxDepth": 2}, "gbt": {"maxIter": 2, "maxDepth": 2}}


def test_pipeline_stops_resumes_and_redoes_what_changed(spark, tmp_path, monkeypatch):
    from raretide.operators import artifact as A
    from raretide.plans import pipeline as P
    r = random.Random(5)
    data = [(k, k % 3, T0 + timedelta(minutes=20 * k), r.uniform(10, 90), r.uniform(0, 10), 100.0, int(r.random() < 0.15)) for k in range(420)]
    readings = spark.createDataFrame(data, READING)
    out = str(tmp_path / "run")
    fit = A.fit_artifact
    monkeypatch.setattr(A, "fit_artifact", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        P.run_pipeline(readings, out, params=SMALL)
    monkeypatch.setattr(A, "fit_artifact", fit)
    monkeypatch.setattr(P, "labelled_features", lambda *a, **k: (_ for _ in ()).throw(AssertionError("features are there already")))
    reports, run = P.run_pipeline(readings, out, params=SMALL)
    models = ["logistic_regression", "random_forest"]
    assert run.ran == [f"{p}_{m}" for m in models for p in ("model", "scored")] + ["baselines", "model_gbt", "scored_gbt", "reports"]
    assert {x["model"] for x in reports["model_comparison"].collect()} >= {"gbt"} and reports["threshold_table"].count() > 0
    before = {k: v.count() for k, v in reports.items()}
    again, second = P.run_pipeline(readings, out, params=SMALL)
    assert second.ran == [] and {k: v.count() for k, v in again.items()} == before
    _, third = P.run_pipeline(readings, out, params=SMALL | {"gbt": {"maxIter": 1, "maxDepth": 2}})
    assert third.ran == ["model_gbt", "scored_gbt", "reports"]
    rows = {x["step"]: x["rows"] for x in third.steps().collect()}
    assert rows["baselines"] == 2 and rows["scored_gbt"] == rows["scored_random_forest"] > 0
