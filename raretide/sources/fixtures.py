"""Sensor fixtures derived by Spark from the driver's ``events`` table.

``readings``  keyed, irregular series (entity = user); ``hourly`` one regular series without key;
``hourly_gaps`` the same with null runs; ``scored`` / ``scored_second`` labels and scores of two
deterministic scorers; ``requests`` JSON request strings; ``failure_events`` the failure rows.
Row counts follow ``events``; the hourly series follow the time that the events span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.functions.timecols import trunc_hour

SENSORS = ["temperature", "vibration", "pressure"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def failure_predicate():
    """Failure rows on raw event columns, so that the filter reaches the parquet scan."""
    return (F.col("event_type") == "error") & (F.col("value") > 200)


def readings_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("entity_id"),
        F.col("ts"),
        F.col("value").alias("temperature"),
        (F.get_json_object("props", "$.k").cast("double") / F.lit(10)).alias("vibration"),
        (F.lit(90.0) + F.pmod(F.col("event_id") * 37, F.lit(200)).cast("double") / F.lit(10)).alias("pressure"),
        F.when(failure_predicate(), 1).otherwise(0).alias("failure"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One regular series without key: hourly averages of all readings."""
    r = readings(spark, sf_dir)
    return (r.groupBy(trunc_hour("ts").alias("ts"))
             .agg(F.avg("temperature").alias("temperature"), F.avg("vibration").alias("vibration"),
                  F.avg("pressure").alias("pressure"), F.max("failure").alias("failure")))


def hourly_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``hourly`` but every sensor averages one tenth of the entities, leaving null runs."""
    r = readings(spark, sf_dir)
    m = F.pmod(F.col("entity_id"), F.lit(10))
    return (r.groupBy(trunc_hour("ts").alias("ts"))
             .agg(F.avg(F.when(m == 0, F.col("temperature"))).alias("temperature"),
                  F.avg(F.when(m == 1, F.col("vibration"))).alias("vibration"),
                  F.avg(F.when(m == 2, F.col("pressure"))).alias("pressure"),
                  F.max("failure").alias("failure")))


def _score(w_temp: float, w_vib: float):
    raw = (F.lit(w_temp) * F.col("temperature") / (F.col("temperature") + F.lit(50.0))
           + F.lit(w_vib) * F.col("vibration"))
    return (F.floor(raw * F.lit(10000.0)).cast("double") / F.lit(10000.0)).alias("score")


def scored(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """(row_id, ts, label, score) with many tied scores; ``second`` is the comparison model."""
    r = readings(spark, sf_dir)
    w = (0.4, 0.06) if second else (0.7, 0.03)
    return r.select("row_id", "ts", F.col("failure").alias("label"), _score(*w))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(readings(spark, sf_dir))


def requests_of(r: DataFrame) -> DataFrame:
    """(row_id, request) JSON strings; pressure missing where row_id % 17 = 0, temperature "bad" where % 23 = 0."""
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    temp = F.when(F.pmod("row_id", F.lit(23)) == 0, F.lit('"bad"')).otherwise(F.col("temperature").cast("string"))
    pres = F.when(F.pmod("row_id", F.lit(17)) == 0, F.lit("")).otherwise(
        F.concat(F.lit(', "pressure": '), F.col("pressure").cast("string")))
    body = F.concat(F.lit('{"timestamp": "'), ts, F.lit('", "temperature": '), temp,
                    F.lit(', "vibration": '), F.col("vibration").cast("string"), pres, F.lit("}"))
    return r.select("row_id", body.alias("request"))


def failure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with failure = 1; the predicate is pushed into the scan."""
    return readings_from_events(table(spark, sf_dir, "events").where(failure_predicate()))


def failure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_rows(spark, sf_dir).select("entity_id", "ts")
