"""Registered queries: requests, decisions, class statistics, split details, scaler, reports,
sampling and linear explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from raretide.functions.scalar import decision_alert, decision_risk, round_response, threshold_predict
from raretide.operators import evaluate as E
from raretide.operators import thresholds as T
from raretide.operators.split import is_sorted_violations, time_series_folds
from raretide.operators.weights import class_distribution, class_weights, data_profile, scale_pos_weight, split_period
from raretide.functions.timecols import ts_micros
from raretide.operators.curves import totals
from raretide.operators.scan import carry_max
from raretide.plans.oracle import READINGS, SCORED, with_ctes
from raretide.plans.q_eval import _metric_sql
from raretide.plans.registry import ORACLES as _OR

ORACLE_FPR = _OR["recall_at_fixed_fpr"]
ORACLE_TOPK = _OR["precision_at_top_k"]
from raretide.plans.q_series import labelled_split, split_sql
from raretide.plans.registry import register
from raretide.sources import fixtures as fx
from raretide.sources.requests import parse_requests

# ---------------------------------------------------------------- requests and decisions

_REQ_SQL = with_ctes(READINGS) + """, req AS (
  SELECT row_id, CASE WHEN row_id % 17 = 0
           THEN json_object('timestamp', ts, 'temperature', CASE WHEN row_id % 23 = 0 THEN to_json('bad') ELSE to_json(temperature) END,
                            'vibration', vibration)
           ELSE json_object('timestamp', ts, 'temperature', CASE WHEN row_id % 23 = 0 THEN to_json('bad') ELSE to_json(temperature) END,
                            'vibration', vibration, 'pressure', pressure) END AS request
  FROM readings),
raw AS (SELECT row_id, json_extract_string(request, '$.timestamp') AS r_ts, json_extract_string(request, '$.temperature') AS r_t,
               json_extract_string(request, '$.vibration') AS r_v, json_extract_string(request, '$.pressure') AS r_p FROM req),
typed AS (SELECT *, TRY_CAST(r_ts AS TIMESTAMP) AS ts, TRY_CAST(r_t AS DOUBLE) AS temperature,
                 TRY_CAST(r_v AS DOUBLE) AS vibration, TRY_CAST(r_p AS DOUBLE) AS pressure FROM raw)
SELECT row_id, ts, temperature, vibration, pressure,
       coalesce(CASE WHEN r_ts IS NULL THEN 'Missing required field: timestamp' END,
                CASE WHEN r_t IS NULL THEN 'Missing required field: temperature' END,
                CASE WHEN r_v IS NULL THEN 'Missing required field: vibration' END,
                CASE WHEN r_p IS NULL THEN 'Missing required field: pressure' END,
                CASE WHEN ts IS NULL THEN 'Invalid input data: timestamp' END,
                CASE WHEN temperature IS NULL THEN 'Invalid input data: temperature' END,
                CASE WHEN vibration IS NULL THEN 'Invalid input data: vibration' END,
                CASE WHEN pressure IS NULL THEN 'Invalid input data: pressure' END) AS error
FROM typed"""
_REQ_SPEC = "row_id:l ts:t temperature:d vibration:d pressure:d error:s valid:b"


@register("parse_requests", _REQ_SPEC, f"SELECT *, error IS NULL AS valid FROM ({_REQ_SQL})")
def q_parse_requests(spark, sf_dir):
    """JSON request bodies -> typed readings, with the first missing/invalid field as error."""
    return parse_requests(fx.requests(spark, sf_dir))


@register("validate_required", "error:s requests:l",
          f"SELECT coalesce(error, 'ok') AS error, count(*) AS requests FROM ({_REQ_SQL}) GROUP BY 1")
def q_validate_required(spark, sf_dir):
    """Accepted / rejected request counts per error (reject side output)."""
    p = parse_requests(fx.requests(spark, sf_dir))
    return p.groupBy(F.coalesce("error", F.lit("ok")).alias("error")).agg(F.count(F.lit(1)).alias("requests"))


@register("try_parse_double", "row_id:l temperature:d", f"SELECT row_id, temperature FROM ({_REQ_SQL}) WHERE error = 'Invalid input data: temperature'")
def q_try_parse_double(spark, sf_dir):
    """Requests whose temperature is present but not a number."""
    p = parse_requests(fx.requests(spark, sf_dir))
    return p.where(F.col("error") == "Invalid input data: temperature").select("row_id", "temperature")


@register("decisions", "row_id:l failure_probability:d decision:s risk:s alert:i",
          with_ctes(READINGS, SCORED) + """SELECT row_id, round(score, 4) AS failure_probability,
       CASE WHEN score >= 0.3::DOUBLE THEN 'ALERT' ELSE 'SAFE' END AS decision,
       CASE WHEN score > 0.5::DOUBLE THEN 'high_risk' ELSE 'low_risk' END AS risk,
       CASE WHEN score >= 0.3::DOUBLE THEN 1 ELSE 0 END AS alert FROM scored""")
def q_decisions(spark, sf_dir):
    """Response fields per reading: rounded probability, ALERT/SAFE (>= 0.3), high/low risk (> 0.5)."""
    s = fx.scored(spark, sf_dir)
    return s.select("row_id", round_response("score").alias("failure_probability"),
                    decision_alert("score").alias("decision"), decision_risk("score").alias("risk"),
                    threshold_predict("score", 0.3).alias("alert"))


@register("failure_rows", "row_id:l entity_id:l ts:t temperature:d", with_ctes(READINGS) +
          "SELECT row_id, entity_id, ts, temperature FROM readings WHERE failure = 1")
def q_failure_rows(spark, sf_dir):
    return fx.failure_rows(spark, sf_dir).select("row_id", "entity_id", "ts", "temperature")


# ---------------------------------------------------------------- class statistics and split details

_SPLIT_R = split_sql("readings")


@register("class_distribution", "split:s total:l positives:l negatives:l positive_rate:d", _SPLIT_R + """
SELECT split, count(*) AS total, sum(failure_24h) AS positives, count(*) - sum(failure_24h) AS negatives,
       avg(failure_24h::DOUBLE) AS positive_rate FROM sp GROUP BY split""")
def q_class_distribution(spark, sf_dir):
    return class_distribution(labelled_split(spark, sf_dir, "readings"), by=["split"])


@register("split_period", "split:s start_ts:t end_ts:t rows:l", _SPLIT_R + """
SELECT split, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS rows FROM sp GROUP BY split""")
def q_split_period(spark, sf_dir):
    return split_period(labelled_split(spark, sf_dir, "readings"))


@register("chrono_split_hourly", "ts:t split:s failure_24h:i", split_sql("hourly") + " SELECT ts, split, failure_24h FROM sp")
def q_chrono_split_hourly(spark, sf_dir):
    """Chronological 70/30 split of the hourly series after the 24-row label shift (remainder dropped)."""
    return labelled_split(spark, sf_dir, "hourly").select("ts", "split", "failure_24h")


@register("class_weights", "label:i count:l weight:d", _SPLIT_R + """
SELECT failure_24h AS label, count(*) AS count,
       sum(count(*)) OVER () / (count(*) OVER () * count(*))::DOUBLE AS weight
FROM sp WHERE split = 'train' GROUP BY failure_24h""")
def q_class_weights(spark, sf_dir):
    """Balanced class weights on the training split."""
    return class_weights(labelled_split(spark, sf_dir, "readings").where("split = 'train'"))


@register("scale_pos_weight", "n:l positives:l scale_pos_weight:d", _SPLIT_R + """
SELECT count(*) AS n, sum(failure_24h) AS positives, sum(1 - failure_24h)::DOUBLE / sum(failure_24h) AS scale_pos_weight
FROM sp WHERE split = 'train'""")
def q_scale_pos_weight(spark, sf_dir):
    return scale_pos_weight(labelled_split(spark, sf_dir, "readings").where("split = 'train'"))


@register("data_profile", "rows:l column:s nulls:l distinct_values:l", with_ctes(READINGS) + "\nUNION ALL ".join(
    ["\nSELECT 0 AS rows, '' AS column, 0 AS nulls, 0 AS distinct_values WHERE false"] +
    [f"SELECT count(*), '{c}', count(*) - count({c}), count(DISTINCT {c}) FROM readings" for c in ("temperature", "vibration", "pressure", "failure")]))
def q_data_profile(spark, sf_dir):
    """Rows, nulls and exact distinct values per column (integrity check)."""
    return data_profile(fx.readings(spark, sf_dir), ["temperature", "vibration", "pressure", "failure"])


@register("time_series_folds", "fold:i rows:l positives:l start_ts:t end_ts:t", split_sql("readings") + """,
tr AS (SELECT *, row_number() OVER (ORDER BY ts, row_id) AS p, count(*) OVER () AS n FROM sp WHERE split = 'train'),
f AS (SELECT *, n // 4 AS size, n - 3 * (n // 4) AS first_test FROM tr)
SELECT CASE WHEN p <= first_test THEN 0 ELSE (p - first_test - 1) // size + 1 END AS fold,
       count(*) AS rows, sum(failure_24h) AS positives, min(ts) AS start_ts, max(ts) AS end_ts FROM f GROUP BY 1""")
def q_time_series_folds(spark, sf_dir):
    """Expanding 3-fold time-series CV blocks of the training split (fold 0 = train-only prefix)."""
    tr = labelled_split(spark, sf_dir, "readings").where("split = 'train'")
    f = time_series_folds(tr)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.sum("failure_24h").alias("positives"),
                                 F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


@register("is_sorted_check", "n_rows:l n_decreases:l", with_ctes(READINGS) + """
SELECT count(*) AS n_rows, coalesce(sum(CASE WHEN prev > ts THEN 1 ELSE 0 END), 0) AS n_decreases
FROM (SELECT ts, lag(ts) OVER (ORDER BY row_id) AS prev FROM readings)""")
def q_is_sorted(spark, sf_dir):
    """Monotonicity of time in stored (row id) order."""
    return is_sorted_violations(fx.readings(spark, sf_dir))


@register("asof_last_failure_join", "row_id:l entity_id:l ts:t last_failure_ts:t hours_since_last_failure:d",
          with_ctes(READINGS) + """, fe AS (SELECT entity_id, ts AS fts FROM readings WHERE failure = 1)
SELECT r.row_id, r.entity_id, r.ts, fe.fts AS last_failure_ts,
       coalesce((epoch_us(r.ts) - epoch_us(fe.fts)) / 3600000000.0, 9999.0) AS hours_since_last_failure
FROM readings r ASOF LEFT JOIN fe ON r.entity_id = fe.entity_id AND r.ts >= fe.fts""")
def q_asof_join(spark, sf_dir):
    """Backward as-of join of readings to a separate failure-event table: tag both sides, union, and carry
    the latest event time forward per entity (a running max, no range-join explosion)."""
    r = fx.readings(spark, sf_dir)
    ev = fx.failure_events(spark, sf_dir)
    both = (r.select("row_id", "entity_id", "ts", F.lit(0).alias("_ev"))
             .unionByName(ev.select(F.lit(None).cast("long").alias("row_id"), "entity_id", "ts", F.lit(1).alias("_ev"))))
    d = both.withColumn("_us", ts_micros("ts"))
    d = carry_max(d, ["entity_id"], "_us", F.when(F.col("_ev") == 1, F.col("_us")), "_lf").where("_ev = 0")
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return d.select("row_id", "entity_id", "ts",
                    F.when(F.col("_lf").isNotNull(), F.timestamp_add("MICROSECOND", F.col("_lf"), epoch)).alias("last_failure_ts"),
                    F.when(F.col("_lf").isNotNull(), (F.col("_us") - F.col("_lf")).cast("double") / F.lit(3.6e9))
                     .otherwise(F.lit(9999.0)).alias("hours_since_last_failure"))


# ---------------------------------------------------------------- confusion, reports, KPIs on scored

def _scored(spark, sf_dir):
    return fx.scored(spark, sf_dir)


_CM_SQL = with_ctes(READINGS, SCORED) + """, cm AS (SELECT
  count(*) FILTER (WHERE label = 0 AND score < 0.3::DOUBLE) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.3::DOUBLE) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < 0.3::DOUBLE) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.3::DOUBLE) AS tp FROM scored)
"""


@register("confusion_matrix", "tn:l fp:l fn:l tp:l", _CM_SQL + "SELECT * FROM cm")
def q_confusion(spark, sf_dir):
    return E.confusion(_scored(spark, sf_dir), 0.3)


@register("accuracy", "accuracy:d", with_ctes(READINGS, SCORED) +
          "SELECT avg(CASE WHEN (score >= 0.5::DOUBLE)::INT = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored")
def q_accuracy(spark, sf_dir):
    return E.accuracy(_scored(spark, sf_dir), 0.5)


@register("threshold_metrics", "threshold:d precision:d recall:d specificity:d f1:d tp:l fp:l fn:l tn:l alert_rate:d",
          _CM_SQL + """, m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS r FROM cm)
SELECT 0.3::DOUBLE AS threshold, p AS precision, r AS recall, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fp) END AS specificity,
       CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1, tp, fp, fn, tn, (tp + fp)::DOUBLE / (tp + fp + fn + tn) AS alert_rate FROM m""")
def q_threshold_metrics(spark, sf_dir):
    return E.threshold_metrics(_scored(spark, sf_dir), 0.3)


@register("classification_report", "class:s precision:d recall:d f1:d support:l", _CM_SQL + """,
per AS (SELECT '0' AS class, CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fn) END AS precision,
               CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fp) END AS recall, tn + fp AS support FROM cm
        UNION ALL
        SELECT '1', CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END, tp + fn FROM cm),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
SELECT class, precision, recall, f1, support FROM per2
UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1 * support) / sum(support), sum(support) FROM per2""")
def q_classification_report(spark, sf_dir):
    return E.classification_report(_scored(spark, sf_dir), 0.3)


_KPI_SQL = _metric_sql("precision", 0.6)


@register("business_kpis", "precision:d recall:d alerts_per_day:d false_positives_per_1000:d meets_precision:b "
          "manageable_volume:b low_false_positive_rate:b precision_note:s positive_rate:d",
          with_ctes(READINGS, SCORED) + f""", t AS (SELECT count(*) AS n_rows, sum(label) AS n_pos FROM scored),
m AS ({_KPI_SQL})
SELECT precision, recall, alert_rate * 24 AS alerts_per_day, fp::DOUBLE / n_rows * 1000 AS false_positives_per_1000,
       precision >= 0.6::DOUBLE AS meets_precision, alert_rate * 24 <= 10 AS manageable_volume,
       fp::DOUBLE / n_rows * 1000 <= 5 AS low_false_positive_rate,
       CASE WHEN precision >= 0.6::DOUBLE THEN 'meets precision requirement' ELSE 'below precision target' END AS precision_note,
       n_pos::DOUBLE / n_rows AS positive_rate FROM m CROSS JOIN t""")
def q_business_kpis(spark, sf_dir):
    """Operational KPIs at the 60 %-precision threshold."""
    s = _scored(spark, sf_dir)
    m = T.for_precision(s).crossJoin(F.broadcast(totals(s)))     # one-row sides
    return E.business_kpis(m)


@register("cost_benefit", "tp:l estimated_savings:d roi_multiple:d", "WITH m AS (" + _KPI_SQL + """)
SELECT tp, tp * 50000.0 AS estimated_savings, tp * 50000.0 / 100000.0 AS roi_multiple FROM m""")
def q_cost_benefit(spark, sf_dir):
    return E.cost_benefit(T.for_precision(_scored(spark, sf_dir)))


def _fmt(x: str, d: int) -> str:
    r = f"CAST(floor(({x}) * {10 ** d}.0 + 0.5) AS BIGINT)"
    return f"(CAST({r} // {10 ** d} AS VARCHAR) || '.' || lpad(CAST({r} % {10 ** d} AS VARCHAR), {d}, '0'))"


_REM_SQL = "WITH fpr AS (" + ORACLE_FPR + "), topk AS (" + ORACLE_TOPK + """)
SELECT 'recall_at_fpr' AS metric_type, 'Recall @ ' || """ + _fmt("target_fpr * 100", 1) + """ || '% FPR' AS metric_name,
       recall AS value, threshold, 'Precision: ' || """ + _fmt("precision", 3) + """ || ', Alerts/day: ' || """ + \
    _fmt("alert_rate * 24", 1) + """ AS additional_info FROM fpr
UNION ALL
SELECT 'precision_at_k', 'Precision @ Top-' || CAST(k AS VARCHAR), precision, threshold,
       'Recall: ' || """ + _fmt("recall", 3) + """ || ', Alerts/day: ' || """ + _fmt("alert_rate * 24", 1) + """ FROM topk"""


@register("rare_event_metrics", "metric_type:s metric_name:s value:d threshold:d additional_info:s", _REM_SQL)
def q_rare_event_metrics(spark, sf_dir):
    """Long report: recall @ 1/5/10 % FPR and precision @ top 10/25/50/100."""
    return E.rare_event_metrics(_scored(spark, sf_dir))
