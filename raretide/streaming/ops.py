"""Streaming versions of the online path, run with file sources and sinks.

Sinks are parquet folders under the session's checkpoint folder (``spark.checkpoint.dir``), so a
replayed query restarts from its checkpoint after a failure and nothing is collected on the driver.
``run_available_now`` drains the source once (``availableNow``) and returns the sink as a batch table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from raretide.functions.scalar import decision_alert, iso_time, round_response
from raretide.functions.timecols import ts_micros
from raretide.operators.features import SENSORS, single_reading_features
from raretide.session import scratch_path
from raretide.sources.fixtures import readings_from_events, requests_of
from raretide.sources.requests import parse_requests

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

ALERT_THRESHOLD = 0.3
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_instant(ts: str = "ts"):
    """TIMESTAMP_NTZ -> TIMESTAMP holding the same wall-clock value as UTC (watermarks need TIMESTAMP);
    independent of the session time zone."""
    return F.timestamp_micros(ts_micros(ts))


def from_instant(c):
    """Inverse of ``as_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


def read_events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def run_available_now(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    spark = df.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def score_column():
    """The deterministic fixture scorer of the alert-volume queries."""
    raw = (F.lit(0.7) * F.col("temperature") / (F.col("temperature") + F.lit(50.0)) + F.lit(0.03) * F.col("vibration"))
    return F.floor(raw * F.lit(10000.0)).cast("double") / F.lit(10000.0)


def run_complete(df: DataFrame, name: str) -> DataFrame:
    """Drain an aggregation in complete mode: every batch replaces the result table, so the last run holds all
    windows, open ones too."""
    spark = df.sparkSession
    base = scratch_path(spark, f"stream-{name}")

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    q = (df.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/checkpoint")
         .foreachBatch(replace).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def stream_alert_volume(events: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                        threshold: float = ALERT_THRESHOLD, slide: str | None = None) -> DataFrame:
    """Alerts (score >= threshold) and readings per tumbling or sliding window.  In append mode a window is emitted
    once the watermark passes its end; ``run_complete`` gives the open ones too."""
    r = readings_from_events(events).withColumn("score", score_column())
    r = r.withColumn("ets", as_instant("ts")).withWatermark("ets", watermark)
    g = r.groupBy(F.window("ets", window, slide or window).alias("w")).agg(
        F.count(F.when(F.col("score") >= F.lit(threshold), F.lit(1))).alias("alerts"),
        F.count(F.lit(1)).alias("readings"))
    return g.select(from_instant(F.col("w.start")).alias("window_start"),
                    from_instant(F.col("w.end")).alias("window_end"), "alerts", "readings")


def stream_dedupe(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeated readings of the same entity and time, keeping state only within the watermark."""
    r = readings_from_events(events).withColumn("ets", as_instant("ts")).withWatermark("ets", watermark)
    return r.dropDuplicatesWithinWatermark(["entity_id", "ts"]).drop("ets")


def stream_validate(events: DataFrame) -> DataFrame:
    """Stateless parse of request bodies built from the stream; rejected rows keep their error."""
    return parse_requests(requests_of(readings_from_events(events))).drop("request")


def stream_score(features: DataFrame, artifact: PipelineModel, threshold: float = ALERT_THRESHOLD, key: str = "entity_id") -> DataFrame:
    """Streamed (or batch) features -> per reading the rounded failure probability, the ALERT/SAFE decision and the reading's time in ISO form."""
    scored = artifact.transform(features)
    return scored.select("row_id", key, "ts", iso_time("ts").alias("time"), round_response("score").alias("failure_probability"),
                         decision_alert("score", threshold).alias("decision"))


# ---------------------------------------------------------------- replays in several drains

def run_slices(slices: Sequence[DataFrame], schema: T.StructType, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Deliver tables one after another to a source folder and drain the query that ``build`` makes of it after each: every drain is a restart
    from the checkpoint.  Returns the file sink as a batch table."""
    spark = slices[0].sparkSession
    base = scratch_path(spark, f"stream-{name}")
    for part in slices:
        part.select(*schema.names).write.mode("append").parquet(f"{base}/in")
        out = build(spark.readStream.schema(schema).parquet(f"{base}/in"))
        (out.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def heartbeat(events: DataFrame, after: str = "2 hours") -> DataFrame:
    """One event without an entity and a value, ``after`` the last one: it moves the watermark past all that waits."""
    last = events.agg((F.max("ts") + F.expr(f"INTERVAL {after}")).alias("ts"))
    return last.select(*[F.col("ts") if f.name == "ts" else F.lit(-1 if f.name == "event_id" else None).cast(f.dataType).alias(f.name) for f in EVENTS_SCHEMA.fields])


# ---------------------------------------------------------------- requests -> two sinks

SINKS = ("predictions", "rejects")


def score_requests(requests: DataFrame, artifact: PipelineModel, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Requests (row_id, request) of a stream or a table, each answered by itself as the online path does: a valid one is a series of one reading.

    Every request keeps a row; a rejected one has its ``error`` and no prediction."""
    parsed = parse_requests(requests).drop("request")
    # rejected ones go through the same expressions with neutral values, so that one stateless plan serves both sinks
    neutral = parsed.withColumns({s: F.when(F.col("valid"), F.col(s)).otherwise(F.lit(0.0)) for s in SENSORS})
    scored = artifact.transform(single_reading_features(neutral))
    known = lambda c: F.when(F.col("valid"), c)
    return scored.select("row_id", "ts", "valid", "error", known(round_response("score")).alias("failure_probability"),
                         known(decision_alert("score", threshold)).alias("decision"), iso_time(F.localtimestamp()).alias("responded_at"))


def two_sinks(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: accepted rows to ``predictions``, the others with their error to ``rejects``.

    Each batch owns a folder in either sink and replaces it, so a batch that runs again, for whatever reason, leaves the sinks as they were."""
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # one evaluation for both sinks: the response times agree
        try:
            accepted = batch.where("valid").select("row_id", "ts", "failure_probability", "decision", "responded_at")
            rejected = batch.where("NOT valid").select("row_id", "error", "responded_at")
            for name, rows in zip(SINKS, (accepted, rejected)):
                rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        finally:
            batch.unpersist()
    return write


def serve_requests(requests: DataFrame, artifact: PipelineModel, path: str, threshold: float = ALERT_THRESHOLD) -> StreamingQuery:
    """Start the query that answers a stream of requests into the two sinks under ``path``, draining what is there."""
    return (score_requests(requests, artifact, threshold).writeStream.foreachBatch(two_sinks(path))
            .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())


def read_sink(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the two sinks as a table, with the number of the batch that wrote each row."""
    return spark.read.parquet(f"{path}/{name}")
