"""Registered queries of the online path: streamed features and scores under out-of-order and late deliveries, the persisted artifact, and requests
answered into two sinks.  Oracles work on the batch tables, with the deliveries' late rows left out by the watermark's rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from raretide.operators import artifact as A
from raretide.operators.features import build_features, single_reading_features
from raretide.plans.oracle import READINGS, with_ctes
from raretide.plans.oracle_features import features_sql
from raretide.plans.q_models import _FEAT, _STATS_WIDE, _stats_sql, reading_features
from raretide.plans.q_series import FEATURES, SENSORS, labelled_split
from raretide.plans.registry import register
from raretide.session import PLAIN, scratch_path, written
from raretide.sources import fixtures as fx
from raretide.streaming import ops as S
from raretide.streaming.features import stream_features

# Deliveries: the month in quarters; every 11th event comes one delivery later, which is too late but for a quarter's last hour.
DELIVERIES, ODD = 4, 11
_ARRIVAL = f"least(least((day(ts) - 1) // 8, {DELIVERIES - 1}) + CASE WHEN event_id % {ODD} = 0 THEN 1 ELSE 0 END, {DELIVERIES - 1})"
_KEPT_SQL = f"""sent AS (SELECT event_id, ts, {_ARRIVAL} AS arrival FROM events),
marks AS (SELECT a AS arrival, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM sent WHERE arrival < a) AS mark FROM range({DELIVERIES}) t(a)),
kept AS (SELECT r.* FROM readings r JOIN sent ON event_id = row_id JOIN marks USING (arrival) WHERE mark IS NULL OR r.ts > mark)"""


def arrival():
    quarter = F.least(F.floor((F.dayofmonth("ts") - 1) / F.lit(8)), F.lit(DELIVERIES - 1))
    return F.least(quarter + F.when(F.pmod("event_id", F.lit(ODD)) == 0, 1).otherwise(0), F.lit(DELIVERIES - 1))


def deliveries(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return [events.where(arrival() == k) for k in range(DELIVERIES)] + [S.heartbeat(events)]


def replayed(spark, sf_dir, build, name):
    return S.run_slices(deliveries(spark, sf_dir), S.EVENTS_SCHEMA, lambda events: build(stream_features(fx.readings_from_events(events))), name)


_CARRY = ["row_id", "entity_id", "ts", "failure"]
_STREAMED = with_ctes(READINGS).replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + _KEPT_SQL + ",\n" + features_sql("kept", ["entity_id"], SENSORS, "row_id", _CARRY)


@register("stream_features", "row_id:l entity_id:l ts:t failure:i " + " ".join(f"{c}:v" if "_var_" in c else f"{c}:d" for c in FEATURES),
          _STREAMED + f"\nSELECT {', '.join(_CARRY + FEATURES)} FROM feat")
def q_stream_features(spark, sf_dir):
    """All features of the event stream, delivered in four files' drains with out-of-order and late rows."""
    return replayed(spark, sf_dir, lambda f: f, "features")


def _linear_sql(source: str, label: str) -> str:
    """CTEs ``st`` (means and scales), ``wt`` (weights) and ``sc`` (row_id, score of every row) over feature rows ``source``."""
    stats = ", ".join(f"avg({c}) AS m_{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{i}" for i, c in enumerate(FEATURES))
    weights = ", ".join(f"coalesce(avg({c}) FILTER (WHERE {label} = 1) - avg({c}) FILTER (WHERE {label} = 0), 0.0) / max(s_{i}) / {len(FEATURES)} AS w_{i}"
                        for i, c in enumerate(FEATURES))
    total = " + ".join(f"w_{i} * (({c} - m_{i}) / s_{i})" for i, c in enumerate(FEATURES))
    return (f"st AS (SELECT {stats} FROM {source}),\nwt AS (SELECT {weights} FROM {source} CROSS JOIN st),\n"
            f"sc AS (SELECT row_id, 1 / (1 + exp(-({total}))) AS score FROM {source} CROSS JOIN st CROSS JOIN wt)")


_DECIDED = "row_id, round(score, 4) AS failure_probability, CASE WHEN score >= 0.3::DOUBLE THEN 'ALERT' ELSE 'SAFE' END AS decision"


@register("stream_score", "row_id:l failure_probability:d decision:s", _STREAMED + ",\n" + _linear_sql("feat", "failure") + f"\nSELECT {_DECIDED} FROM sc")
def q_stream_score(spark, sf_dir):
    """Streamed features scored by a fitted artifact that was saved and loaded: the decision per reading."""
    events = fx.table(spark, sf_dir, "events").withColumn("arrival", arrival())
    tops = events.groupBy("arrival").agg(F.date_trunc("millisecond", F.max("ts")).alias("top"))
    marks = [tops.where(F.col("arrival") < k).agg((F.max("top") - F.expr("INTERVAL 1 HOUR")).alias("mark")).withColumn("arrival", F.lit(k)) for k in range(DELIVERIES)]
    mark = marks[0]
    for m in marks[1:]:
        mark = mark.unionByName(m)  # one row a delivery
    kept = events.join(F.broadcast(mark), "arrival").where(F.col("mark").isNull() | (F.col("ts") > F.col("mark")))
    train = written(build_features(fx.readings_from_events(kept), ["entity_id"], SENSORS, one_pass=True), "train", **PLAIN)
    path = scratch_path(spark, "artifact")
    A.save_artifact(A.fit_linear_artifact(train, FEATURES, "failure"), path)
    artifact = A.load_artifact(path)
    return replayed(spark, sf_dir, lambda f: S.stream_score(f, artifact), "score").select("row_id", "failure_probability", "decision")


def _cold_sql() -> str:
    """The features of readings without a history, by their names alone."""
    out = {c: "0.0::DOUBLE" for c in FEATURES} | {"hours_since_last_failure": "9999.0::DOUBLE", "temperature_vibration": "temperature * vibration",
                                                  "temperature_pressure": "temperature / (pressure + 1e-9::DOUBLE)", "vibration_pressure": "vibration * pressure"}
    for s in SENSORS:
        out |= {c: s for c in FEATURES if c == s or c in (f"{s}_ema_12", f"{s}_ema_24") or c.startswith((f"{s}_rolling_mean", f"{s}_rolling_max", f"{s}_rolling_min"))}
    return "cold AS (SELECT row_id, failure, " + ", ".join(f"{e} AS {c}" for c, e in out.items()) + " FROM readings)"


@register("predictions_sink", "row_id:l sink:s error:s failure_probability:d decision:s", with_ctes(READINGS) + ",\n" + _cold_sql() + ",\n" + _linear_sql("cold", "failure") + f""",
e AS (SELECT row_id, CASE WHEN row_id % 17 = 0 THEN 'Missing required field: pressure' WHEN row_id % 23 = 0 THEN 'Invalid input data: temperature' END AS error FROM readings)
SELECT row_id, CASE WHEN error IS NULL THEN 'predictions' ELSE 'rejects' END AS sink, error, CASE WHEN error IS NULL THEN failure_probability END AS failure_probability,
       CASE WHEN error IS NULL THEN decision END AS decision FROM e JOIN (SELECT {_DECIDED} FROM sc) USING (row_id)""")
def q_predictions_sink(spark, sf_dir):
    """A stream of requests answered into two sinks by a saved artifact; the last batch runs twice and leaves them as they were."""
    cold = single_reading_features(fx.readings(spark, sf_dir))
    path = scratch_path(spark, "requests")
    A.save_artifact(A.fit_linear_artifact(cold, FEATURES, "failure"), f"{path}/artifact")
    artifact = A.load_artifact(f"{path}/artifact")
    requests = fx.requests_of(fx.readings_from_events(S.read_events_stream(spark, sf_dir)))
    S.serve_requests(requests, artifact, path).awaitTermination()
    predictions, rejects = (S.read_sink(spark, path, name).withColumn("sink", F.lit(name)) for name in S.SINKS)
    last = predictions.agg(F.max("batch")).first()[0]
    if last is not None:  # as after a failure between the sinks and the checkpoint
        S.two_sinks(path)(S.score_requests(fx.requests(spark, sf_dir), artifact), last)
        predictions, rejects = (S.read_sink(spark, path, name).withColumn("sink", F.lit(name)) for name in S.SINKS)
    return predictions.unionByName(rejects, allowMissingColumns=True)


@register("transform_features", "row_id:l " + " ".join(f"{c}:v" for c in FEATURES), _FEAT + ",\n" + _stats_sql() + ",\n" + _STATS_WIDE + """
SELECT row_id, """ + ", ".join(f"({c} - m_{i}) / s_{i} AS {c}" for i, c in enumerate(FEATURES)) + " FROM feat CROSS JOIN sw WHERE split = 'val'")
def q_transform_features(spark, sf_dir):
    """New readings through a saved and loaded artifact: features, then the training scaler, in the model's order."""
    path = scratch_path(spark, "artifact")
    A.save_artifact(A.fit_linear_artifact(reading_features(spark, sf_dir).where("split = 'train'"), FEATURES), path)
    new = labelled_split(spark, sf_dir, "readings").where("split = 'val'").drop("split")
    return A.transform_features(A.load_artifact(path), new).select("row_id", *FEATURES)
