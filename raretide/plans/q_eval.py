"""Registered queries: curves, threshold searches, top-k, sweeps, reports on the ``scored`` fixture.

Oracles use the literal formulation of the reference's library functions: descending cumulative sums
over distinct scores, ``lag`` for the previous curve point, second differences via ``lag``/``lead`` for
collinear ROC points, a cross join with the threshold grid, and ``row_number`` for top-k.
"""

from __future__ import annotations

from raretide.operators import curves as C
from raretide.operators import evaluate as E
from raretide.operators import thresholds as T
from raretide.plans.oracle import READINGS, SCORED, with_ctes
from raretide.plans.registry import register
from raretide.sources import fixtures as fx

# ---------------------------------------------------------------- SQL building blocks

CURVE = with_ctes(READINGS, SCORED, """sc AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg
            FROM scored GROUP BY score)""", """tot AS (SELECT count(*) AS n_rows, sum(label) AS n_pos, count(*) - sum(label) AS n_neg FROM scored)""",
                  """pts AS (SELECT score AS threshold, pos, neg, n_rows, n_pos, n_neg,
        sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
      FROM sc CROSS JOIN tot)""", """curve AS (SELECT *, n_pos - tp AS fn, n_neg - fp AS tn,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS precision,
        CASE WHEN n_pos = 0 THEN 1.0 ELSE tp::DOUBLE / n_pos END AS recall,
        max(threshold) OVER () AS max_t
      FROM pts)""", """lagged AS (SELECT *,
        coalesce(lag(precision) OVER (ORDER BY threshold DESC), 1.0) AS precision_prev,
        coalesce(lag(recall) OVER (ORDER BY threshold DESC), 0.0) AS recall_prev
      FROM curve)""", """tr AS (SELECT *,
        CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
        (tp + fp)::DOUBLE / n_rows AS alert_rate,
        CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fp) END AS specificity
      FROM curve WHERE threshold < max_t)""")


def scored(spark, sf_dir):
    return fx.scored(spark, sf_dir)


METRIC_SPEC = ("strategy:s target:d threshold:d precision:d recall:d f1:d tp:l fp:l fn:l tn:l alert_rate:d "
               "alerts_per_day_scaled:d specificity:d fallback:b")


def _metric_sql(rule: str, target: float, total: int | None = None) -> str:
    n = "n_rows" if total is None else str(total)
    cols = ("threshold, precision, recall, f1, tp, fp, fn, tn, alert_rate, alert_rate * (" + n + "::DOUBLE / 24) AS "
            "alerts_per_day_scaled, specificity")
    if rule == "precision":
        first = f"(SELECT {cols} FROM tr WHERE precision >= {target}::DOUBLE ORDER BY recall DESC, threshold LIMIT 1)"
        fb = f"(SELECT {cols} FROM tr ORDER BY precision DESC, threshold LIMIT 1)"
    elif rule == "recall":
        first = f"(SELECT {cols} FROM tr WHERE recall >= {target}::DOUBLE ORDER BY precision DESC, threshold LIMIT 1)"
        fb = f"(SELECT {cols} FROM tr ORDER BY recall DESC, threshold LIMIT 1)"
    else:
        first = (f"(SELECT {cols} FROM tr WHERE alert_rate <= {float(target)}::DOUBLE / ({n}::DOUBLE / 24) "
                 f"ORDER BY precision DESC, threshold DESC LIMIT 1)")
        fb = (f"(SELECT * FROM (SELECT 1 AS o, {cols} FROM tr WHERE recall >= 0.1::DOUBLE "
              f"UNION ALL SELECT 2 AS o, {cols} FROM tr) ORDER BY o, "
              f"CASE WHEN o = 1 THEN -precision ELSE -recall END, threshold LIMIT 1)")
    return CURVE + f""", a AS {first}, b AS {fb}
SELECT '{rule}' AS strategy, {float(target)}::DOUBLE AS target, x.*, (SELECT count(*) = 0 FROM a) AS fallback
FROM (SELECT * FROM a UNION ALL SELECT * EXCLUDE (o) FROM b WHERE NOT EXISTS (SELECT 1 FROM a)) AS x""" \
        if rule == "budget" else CURVE + f""", a AS {first}, b AS {fb}
SELECT '{rule}' AS strategy, {float(target)}::DOUBLE AS target, x.*, (SELECT count(*) = 0 FROM a) AS fallback
FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a)) AS x"""


# ---------------------------------------------------------------- curves

@register("pr_curve", "threshold:d precision:d recall:d tp:l fp:l",
          CURVE + "SELECT threshold, precision, recall, tp, fp FROM curve")
def q_pr_curve(spark, sf_dir):
    """Exact precision-recall curve: one point per distinct score."""
    return C.pr_curve(scored(spark, sf_dir))


@register("pr_auc", "pr_auc:d", CURVE + """
SELECT sum((recall - recall_prev) * (precision + precision_prev) / 2) AS pr_auc FROM lagged""")
def q_pr_auc(spark, sf_dir):
    return C.pr_areas(scored(spark, sf_dir)).select("pr_auc")


@register("average_precision", "average_precision:d", CURVE + """
SELECT sum((recall - recall_prev) * precision) AS average_precision FROM lagged""")
def q_average_precision(spark, sf_dir):
    return C.pr_areas(scored(spark, sf_dir)).select("average_precision")


@register("curve_means", "avg_precision:d avg_recall:d n_points:l", CURVE + """
SELECT (sum(precision) + 1) / (count(*) + 1) AS avg_precision, sum(recall) / (count(*) + 1) AS avg_recall,
       count(*) + 1 AS n_points FROM curve""")
def q_curve_means(spark, sf_dir):
    return C.pr_areas(scored(spark, sf_dir)).select("avg_precision", "avg_recall", "n_points")


ROC_SQL = CURVE + """, roc AS (SELECT threshold, tp, fp, n_rows, n_pos, n_neg,
        lag(fp) OVER w AS fp0, lead(fp) OVER w AS fp2, lag(tp) OVER w AS tp0, lead(tp) OVER w AS tp2,
        row_number() OVER w AS j, count(*) OVER () AS m
      FROM pts WINDOW w AS (ORDER BY threshold DESC)),
kept AS (SELECT threshold, tp, fp, n_rows, n_pos, n_neg FROM roc
         WHERE j = 1 OR j = m OR fp2 - 2 * fp + fp0 <> 0 OR tp2 - 2 * tp + tp0 <> 0
         UNION ALL SELECT 'inf'::DOUBLE, 0, 0, n_rows, n_pos, n_neg FROM tot),
verts AS (SELECT *, CASE WHEN n_neg = 0 THEN NULL ELSE fp::DOUBLE / n_neg END AS fpr,
                 CASE WHEN n_pos = 0 THEN NULL ELSE tp::DOUBLE / n_pos END AS tpr FROM kept)
"""


@register("roc_curve", "threshold:d fpr:d tpr:d tp:l fp:l", ROC_SQL + "SELECT threshold, fpr, tpr, tp, fp FROM verts")
def q_roc_curve(spark, sf_dir):
    """ROC vertices with collinear points dropped and the (0, 0, +inf) start point."""
    return C.roc_curve(scored(spark, sf_dir))


@register("roc_auc", "roc_auc:d", ROC_SQL + """
SELECT sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc FROM (
  SELECT fpr, tpr, coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0) AS fpr0,
         coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0) AS tpr0 FROM verts WHERE threshold <> 'inf'::DOUBLE)""")
def q_roc_auc(spark, sf_dir):
    return C.roc_auc(scored(spark, sf_dir))


# ---------------------------------------------------------------- threshold searches

register("threshold_for_precision_60", METRIC_SPEC, _metric_sql("precision", 0.6))(
    lambda spark, sf: T.for_precision(scored(spark, sf), 0.6))
for _r in T.RECALL_TARGETS:
    register(f"threshold_for_recall_{int(round(_r * 100))}", METRIC_SPEC, _metric_sql("recall", _r))(
        lambda spark, sf, _r=_r: T.for_recall(scored(spark, sf), _r))
for _b in T.ALERT_BUDGETS:
    register(f"threshold_for_alert_budget_{_b}", METRIC_SPEC, _metric_sql("budget", _b))(
        lambda spark, sf, _b=_b: T.for_alert_budget(scored(spark, sf), _b))


@register("threshold_table", "threshold:d precision:d recall:d f1:d alert_rate:d alerts_per_day:d alerts_per_day_scaled:d",
          CURVE + """SELECT threshold, precision, recall, f1, alert_rate, alert_rate * 24 AS alerts_per_day,
       alert_rate * (n_rows::DOUBLE / 24) AS alerts_per_day_scaled FROM tr""")
def q_threshold_table(spark, sf_dir):
    """Threshold vs metrics (highest score dropped)."""
    return T.threshold_table(scored(spark, sf_dir))


@register("threshold_table_eps", "threshold:d precision:d recall:d f1:d", CURVE + """
SELECT threshold, precision, recall, coalesce(2 * precision * recall / (precision + recall + 1e-9::DOUBLE), 0) AS f1 FROM tr""")
def q_threshold_table_eps(spark, sf_dir):
    return T.threshold_table_eps(scored(spark, sf_dir))


@register("best_f1_threshold", "best_threshold:d best_precision:d best_recall:d best_f1:d", CURVE + """
SELECT threshold AS best_threshold, precision AS best_precision, recall AS best_recall, f1 AS best_f1 FROM (
  SELECT threshold, precision, recall, coalesce(2 * precision * recall / (precision + recall + 1e-9::DOUBLE), 0) AS f1 FROM tr)
ORDER BY f1 DESC, threshold LIMIT 1""")
def q_best_f1(spark, sf_dir):
    return T.best_f1_threshold(scored(spark, sf_dir))


# ---------------------------------------------------------------- top-k, fixed FPR, sweeps

@register("precision_at_top_k", "k:i threshold:d precision:d recall:d tp:l fp:l alert_rate:d",
          with_ctes(READINGS, SCORED) + """, tot AS (SELECT count(*) AS n_rows, sum(label) AS n_pos FROM scored),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, row_id DESC) AS rk FROM scored),
ks AS (SELECT unnest([10, 25, 50, 100]) AS k)
SELECT k, min(score) AS threshold, sum(label)::DOUBLE / k AS precision,
       CASE WHEN max(n_pos) = 0 THEN 0.0 ELSE sum(label)::DOUBLE / max(n_pos) END AS recall,
       sum(label) AS tp, k - sum(label) AS fp, k::DOUBLE / max(n_rows) AS alert_rate
FROM ks JOIN r ON r.rk <= ks.k CROSS JOIN tot WHERE k < n_rows GROUP BY k""")
def q_top_k(spark, sf_dir):
    """Precision, recall and threshold of the top 10/25/50/100 scores."""
    return E.precision_at_top_k(scored(spark, sf_dir))


@register("recall_at_fixed_fpr", "target_fpr:d threshold:d recall:d precision:d fpr:d tp:l fp:l alert_rate:d",
          ROC_SQL + """, t AS (SELECT unnest([0.01::DOUBLE, 0.05::DOUBLE, 0.10::DOUBLE]) AS target_fpr),
best AS (SELECT target_fpr, arg_min(struct_pack(threshold := threshold, tp := tp, fp := fp, n_rows := n_rows, n_pos := n_pos, n_neg := n_neg),
                                  struct_pack(d := abs(fpr - target_fpr), t := -threshold)) AS v
         FROM verts CROSS JOIN t GROUP BY target_fpr)
SELECT target_fpr, v.threshold AS threshold,
       CASE WHEN v.n_pos = 0 THEN 0.0 ELSE v.tp::DOUBLE / v.n_pos END AS recall,
       CASE WHEN v.tp + v.fp = 0 THEN 0.0 ELSE v.tp::DOUBLE / (v.tp + v.fp) END AS precision,
       CASE WHEN v.n_neg = 0 THEN 0.0 ELSE v.fp::DOUBLE / v.n_neg END AS fpr,
       v.tp AS tp, v.fp AS fp, (v.tp + v.fp)::DOUBLE / v.n_rows AS alert_rate FROM best""")
def q_recall_at_fpr(spark, sf_dir):
    """Recall, precision and threshold at the ROC vertex nearest to 1 %, 5 %, 10 % FPR."""
    return E.recall_at_fixed_fpr(scored(spark, sf_dir))


_GRID = T.sweep_grid()
_GRID_SQL = "[" + ", ".join(f"{v!r}::DOUBLE" for v in _GRID) + "]"
_SWEEP_SQL = with_ctes(READINGS, SCORED) + f""", g AS (SELECT unnest({_GRID_SQL}) AS threshold),
sw AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
              count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
              count(*) FILTER (WHERE score < threshold AND label = 1) AS fn,
              count(*) FILTER (WHERE score < threshold AND label = 0) AS tn, count(*) AS n_rows
       FROM g CROSS JOIN scored GROUP BY threshold)
"""


@register("daily_alert_simulation", "threshold:d alerts_per_day:d precision:d alert_rate:d", _SWEEP_SQL + """
SELECT threshold, (tp + fp)::DOUBLE / n_rows * 24 AS alerts_per_day,
       CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision, (tp + fp)::DOUBLE / n_rows AS alert_rate
FROM sw""")
def q_daily_alerts(spark, sf_dir):
    """Alert volume and precision at 50 thresholds from 0.01 to 0.99."""
    return T.daily_alert_simulation(scored(spark, sf_dir))


_TOP5_SQL = """pos AS (SELECT *, row_number() OVER (ORDER BY ts, row_id) AS p, count(*) OVER () AS n_rows FROM scored),
bk AS (SELECT *, (p - 1) // (n_rows // 24) AS b FROM pos WHERE n_rows >= 24),
bt AS (SELECT * FROM bk WHERE b < least(24, n_rows // (n_rows // 24))),
top AS (SELECT b, label, row_number() OVER (PARTITION BY b ORDER BY score DESC, p DESC) AS r FROM bt),
top5 AS (SELECT avg(pb) AS top_5_precision FROM (SELECT b, avg(label::DOUBLE) AS pb FROM top WHERE r <= 5 GROUP BY b))"""


@register("bucket_topk_precision", "top_5_precision:d", with_ctes(READINGS, SCORED) + "," + _TOP5_SQL +
          " SELECT top_5_precision FROM top5")
def q_bucket_topk(spark, sf_dir):
    """Mean over 24 position buckets of the precision of each bucket's 5 highest scores."""
    return E.bucket_topk_precision(scored(spark, sf_dir))


RARE_THRESHOLDS = [0.05, 0.1, 0.2, 0.3, 0.4, 0.5]
_RARE_GRID = "[" + ", ".join(f"{v!r}::DOUBLE" for v in RARE_THRESHOLDS) + "]"


@register("rare_event_table", "threshold:d precision:d recall:d specificity:d alert_rate:d alerts_per_day:d "
          "top_5_precision:d tp:l fp:l fn:l",
          _SWEEP_SQL.replace(_GRID_SQL, _RARE_GRID) + "," + _TOP5_SQL + """
SELECT threshold, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0.0 END AS specificity,
       (tp + fp)::DOUBLE / n_rows AS alert_rate, (tp + fp)::DOUBLE / n_rows * (n_rows::DOUBLE / 24) AS alerts_per_day,
       coalesce(top_5_precision, 0.0) AS top_5_precision, tp, fp, fn
FROM sw CROSS JOIN top5""")
def q_rare_event_table(spark, sf_dir):
    """Rare-event metrics at fixed thresholds, with the bucketed top-5 precision."""
    return E.rare_event_table(scored(spark, sf_dir), RARE_THRESHOLDS)
