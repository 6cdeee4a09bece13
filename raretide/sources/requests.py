"""Request parsing and validation (batch and streaming share it).

A body is one JSON object or an array of objects (a batch request: one row each).  Fields are parsed as text and
cast with ``try_cast``; the first missing field, or else the first that is not a value of its type, rejects the
request, as in the reference's online path.  A field whose value is JSON ``null`` counts as missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Required fields in the reference's order; the second form is stamped with the arrival time.
REQUIRED = ["timestamp", "temperature", "vibration", "pressure"]
REQUIRED_WITHOUT_TIME = ["temperature", "vibration", "pressure"]


def _schema(required: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in required])


def request_objects(df: DataFrame, body: str = "request", required: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per request object: ``_j`` (its required fields as text) and ``_item`` (place in an array body, 0 for a
    single object).  A body that is neither gives one row with ``_j`` null; an empty array gives none."""
    schema = _schema(required)
    is_array = F.col(body).rlike(r"^\s*\[")
    many = F.from_json(F.col(body), T.ArrayType(schema))
    items = F.when(is_array, F.coalesce(many, F.array(F.lit(None).cast(schema)))).otherwise(F.array(F.from_json(F.col(body), schema)))
    return df.select("*", F.posexplode(items).alias("_item", "_j"))


def parse_requests(df: DataFrame, body: str = "request", required: Sequence[str] = REQUIRED,
                   received: Column | None = None) -> DataFrame:
    """Adds ``ts``, the sensor fields (typed, NULL when missing or bad), ``valid`` and ``error``.

    Without ``timestamp`` among ``required``, ``ts`` is ``received`` (default: the current time)."""
    d = request_objects(df, body, required)
    raw = {f: F.col("_j").getField(f) for f in required}
    typed = {f: (raw[f].try_cast("timestamp_ntz") if f == "timestamp" else raw[f].try_cast("double")) for f in required}
    missing = [F.when(raw[f].isNull(), F.lit(f"Missing required field: {f}")) for f in required]
    invalid = [F.when(raw[f].isNotNull() & typed[f].isNull(), F.lit(f"Invalid input data: {f}")) for f in required]
    ts = typed["timestamp"] if "timestamp" in typed else (F.localtimestamp() if received is None else received)
    out = d.select(*df.columns, ts.alias("ts"), *[typed[f].alias(f) for f in required if f != "timestamp"],
                   F.coalesce(*missing, *invalid).alias("error"))
    return out.withColumn("valid", F.col("error").isNull())


def valid_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid")


def rejected_requests(parsed: DataFrame) -> DataFrame:
    """Side output of rejected requests with their error."""
    return parsed.where(~F.col("valid"))
