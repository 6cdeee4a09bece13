"""Registered queries: sources, projections, windows, features, split (time-series side)."""

from __future__ import annotations

from pyspark.sql import functions as F

from raretide.operators.features import build_features
from raretide.operators.split import chrono_split
from raretide.operators.windows import (drop_unlabelled, ema_lag_features, label_lead, rolling_features,
                                        hours_since_last_failure, with_order)
from raretide.plans.oracle import READINGS, with_ctes
from raretide.plans.registry import register
from raretide.sources import fixtures as fx

RANGE_6H = "RANGE BETWEEN INTERVAL '5 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW"

R_SPEC = "row_id:l entity_id:l ts:t temperature:d vibration:d pressure:d failure:i"

# ---------------------------------------------------------------- flagship

_SPLIT_SQL = """
lab AS (SELECT *, lead(failure, 24) OVER (PARTITION BY entity_id ORDER BY ts, row_id) AS failure_24h FROM readings),
labelled AS (SELECT * FROM lab WHERE failure_24h IS NOT NULL),
pos AS (SELECT *, row_number() OVER (ORDER BY ts, row_id) AS p, count(*) OVER () AS n FROM labelled),
cut AS (SELECT *, floor(n * 0.7::DOUBLE) AS n_train, least(floor(n * 0.3::DOUBLE), n - floor(n * 0.7::DOUBLE)) AS n_val FROM pos),
sp AS (SELECT * EXCLUDE (p, n, n_train, n_val),
              CASE WHEN p <= n_train THEN 'train' WHEN p <= n_train + n_val THEN 'val' END AS split
       FROM cut WHERE p <= n_train + n_val)"""


def flagship(spark, sf_dir):
    """readings -> label 24 rows ahead -> chronological split -> 6h rolling mean, lag 1, hours since last
    failure per (entity, split) -> class distribution and feature means per split."""
    r = fx.readings(spark, sf_dir)
    lab = drop_unlabelled(label_lead(r, ["entity_id"]))
    sp = chrono_split(lab)
    keys = ["entity_id", "split"]
    d = with_order(sp, keys)
    d = ema_lag_features(d, keys, ["temperature"], spans=[], lags=[1])
    d = rolling_features(d, keys, ["temperature"], spans=["6h"], slope_span=None)
    d = hours_since_last_failure(d, keys)
    d = d.withColumn("temperature_lag_1", F.coalesce("temperature_lag_1", F.lit(0.0)))
    y = F.col("failure_24h")
    return d.groupBy("split").agg(
        F.count(F.lit(1)).alias("total"), F.sum(y).alias("positives"), F.sum(1 - y).alias("negatives"), F.avg(y.cast("double")).alias("positive_rate"),
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.avg("temperature_rolling_mean_6h").alias("avg_rolling_mean_6h"),
        F.avg("temperature_lag_1").alias("avg_lag_1"),
        F.avg("hours_since_last_failure").alias("avg_hours_since_last_failure"))


FLAGSHIP_SPEC = ("split:s total:l positives:l negatives:l positive_rate:d start_ts:t end_ts:t "
                 "avg_rolling_mean_6h:d avg_lag_1:d avg_hours_since_last_failure:d")
FLAGSHIP_SQL = with_ctes(READINGS) + "," + _SPLIT_SQL + """,
f AS (SELECT *,
        avg(temperature) OVER (PARTITION BY entity_id, split ORDER BY ts """ + RANGE_6H + """) AS rm6,
        coalesce(lag(temperature, 1) OVER (PARTITION BY entity_id, split ORDER BY ts, row_id), 0) AS lag1,
        max(CASE WHEN failure = 1 THEN ts END) OVER (PARTITION BY entity_id, split ORDER BY ts
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lf
      FROM sp)
SELECT split, count(*) AS total, sum(failure_24h) AS positives, count(*) - sum(failure_24h) AS negatives,
       avg(failure_24h::DOUBLE) AS positive_rate, min(ts) AS start_ts, max(ts) AS end_ts,
       avg(rm6) AS avg_rolling_mean_6h, avg(lag1) AS avg_lag_1,
       avg(coalesce((epoch_us(ts) - epoch_us(lf)) / 3600000000.0, 9999)) AS avg_hours_since_last_failure
FROM f GROUP BY split"""

register("flagship_split_features", FLAGSHIP_SPEC, FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------- sources

@register("read_readings", R_SPEC, with_ctes(READINGS) + "SELECT * FROM readings")
def q_read_readings(spark, sf_dir):
    """The keyed reading table derived from events."""
    return fx.readings(spark, sf_dir)


@register("label_lead_24", R_SPEC + " failure_24h:i", with_ctes(READINGS) + """
SELECT *, lead(failure, 24) OVER (PARTITION BY entity_id ORDER BY ts, row_id) AS failure_24h FROM readings""")
def q_label_lead_24(spark, sf_dir):
    """failure 24 rows later in the same entity series (NULL tail kept)."""
    return label_lead(fx.readings(spark, sf_dir), ["entity_id"])


# ---------------------------------------------------------------- labelled, split sources

from raretide.operators.features import feature_names  # noqa: E402
from raretide.plans.oracle import HOURLY, HOURLY_GAPS  # noqa: E402
from raretide.plans.oracle_features import features_sql  # noqa: E402

SENSORS = ["temperature", "vibration", "pressure"]
_FIXTURES = {
    # name: (spark source, series keys, tiebreak, SQL CTEs, SQL source name)
    "readings": (fx.readings, ["entity_id"], "row_id", [READINGS], "readings"),
    "hourly": (fx.hourly, [], None, [READINGS, HOURLY], "hourly"),
    "hourly_gaps": (fx.hourly_gaps, [], None, [READINGS, HOURLY_GAPS], "hourly_gaps"),
}


def labelled_split(spark, sf_dir, fixture):
    src, keys, tb, _, _ = _FIXTURES[fixture]
    lab = drop_unlabelled(label_lead(src(spark, sf_dir), keys, tiebreak=tb))
    return chrono_split(lab, tiebreak=tb)


def split_sql(fixture: str) -> str:
    _, keys, tb, ctes, name = _FIXTURES[fixture]
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    order = "ORDER BY ts" + (f", {tb}" if tb else "")
    return with_ctes(*ctes).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
lab AS (SELECT *, lead(failure, 24) OVER ({part} {order}) AS failure_24h FROM {name}),
labelled AS (SELECT * FROM lab WHERE failure_24h IS NOT NULL),
pos AS (SELECT *, row_number() OVER ({order}) AS p, count(*) OVER () AS n FROM labelled),
cut AS (SELECT *, floor(n * 0.7::DOUBLE) AS n_train,
               least(floor(n * 0.3::DOUBLE), n - floor(n * 0.7::DOUBLE)) AS n_val FROM pos),
sp AS (SELECT * EXCLUDE (p, n, n_train, n_val),
              CASE WHEN p <= n_train THEN 'train' WHEN p <= n_train + n_val THEN 'val' END AS split
       FROM cut WHERE p <= n_train + n_val)"""


def _carry(fixture):
    _, keys, tb, _, _ = _FIXTURES[fixture]
    return ([tb] if tb else []) + keys + ["split", "ts", "failure", "failure_24h"]


_CARRY_TYPES = {"row_id": "l", "entity_id": "l", "split": "s", "ts": "t", "failure": "i", "failure_24h": "i"}


def _features_query(fixture: str, cols: list[str]):
    _, keys, tb, _, _ = _FIXTURES[fixture]
    carry = _carry(fixture)
    spec = " ".join(f"{c}:{_CARRY_TYPES[c]}" for c in carry) + " " + " ".join(f"{c}:v" if "_var_" in c else f"{c}:d" for c in cols)
    sql = split_sql(fixture) + ",\n" + features_sql("sp", keys + ["split"], SENSORS, tb, carry) + \
        f"\nSELECT {', '.join(carry + cols)} FROM feat"

    def run(spark, sf_dir):
        d = labelled_split(spark, sf_dir, fixture)
        return build_features(d, keys, SENSORS, split_col="split", tiebreak=tb, only=cols, one_pass=True)
    return spec, sql, run


FEATURES = feature_names(SENSORS)
_FAMILIES = {
    "rolling_1h": [c for c in FEATURES if c.endswith("_1h") and "rolling_" in c],
    "rolling_6h": [c for c in FEATURES if c.endswith("_6h") and "rolling_" in c and "slope" not in c],
    "rolling_12h": [c for c in FEATURES if c.endswith("_12h")],
    "rolling_slope_6h": [c for c in FEATURES if "slope" in c],
    "ema": [c for c in FEATURES if "_ema_" in c],
    "lag_roc": [c for c in FEATURES if "_lag_" in c or "_roc_" in c],
    "interactions_deltas": [c for c in FEATURES if c in ("temperature_vibration", "temperature_pressure",
                                                         "vibration_pressure") or "delta" in c] + SENSORS,
    "hours_since_last_failure": ["hours_since_last_failure"],
}

for _fix in ("readings", "hourly"):
    _spec, _sql, _run = _features_query(_fix, FEATURES)
    register(f"build_features_{_fix}", _spec, _sql)(_run)
    for _fam, _cols in _FAMILIES.items():
        _s, _q, _r = _features_query(_fix, _cols)
        register(f"features_{_fam}_{_fix}", _s, _q)(_r)

_spec, _sql, _run = _features_query("hourly_gaps", FEATURES)
register("build_features_hourly_gaps", _spec, _sql)(_run)
