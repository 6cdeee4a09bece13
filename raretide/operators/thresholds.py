"""Threshold searches and threshold tables over the exact PR curve.

Each search is one aggregate over the curve table (one row per distinct score) with ``min_by`` /
``max_by`` on explicit tie-break keys, so the result is deterministic.  Metrics at the chosen threshold
come from the curve's cumulative counts (predicting ``score >= t``); no rescan of the scored table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from raretide.functions.scalar import literal_table, safe_div
from raretide.operators.curves import pr_curve

# Fixed values of the reference's searches.
MIN_PRECISION = 0.6
RECALL_TARGETS = [0.7, 0.8, 0.9]
ALERT_BUDGETS = [1, 5, 10]
BUDGET_FALLBACK_RECALL = 0.1
HOURS_PER_DAY = 24
SWEEP_START, SWEEP_STOP, SWEEP_NUM = 0.01, 0.99, 50
F1_EPS = 1e-9

METRIC_COLS = ["threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn", "alert_rate",
               "alerts_per_day_scaled", "specificity"]


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))


def with_metrics(curve: DataFrame, total_samples: int | None = None) -> DataFrame:
    """Add f1, alert_rate, alerts_per_day (rate*24), alerts_per_day_scaled (rate*total/24), specificity."""
    rate = (F.col("tp") + F.col("fp")).cast("double") / F.col("n_rows")
    return curve.withColumns({
        "f1": _f1(F.col("precision"), F.col("recall")),
        "alert_rate": rate,
        "alerts_per_day": rate * F.lit(float(HOURS_PER_DAY)),
        "alerts_per_day_scaled": rate * (_samples(total_samples) / F.lit(float(HOURS_PER_DAY))),
        "specificity": safe_div(F.col("tn"), F.col("tn") + F.col("fp")),
    })


def _samples(total_samples: int | None) -> Column:
    """Rows that alert volumes refer to: the whole data set's if given, else the scored rows."""
    return F.col("n_rows").cast("double") if total_samples is None else F.lit(float(total_samples))


def _pick(valid: Column | None, order: list[Column]) -> Column:
    """min_by over the curve of the metric struct, restricted to ``valid`` rows, on ``order`` keys."""
    s = F.struct(*[F.col(c) for c in METRIC_COLS])
    key = F.struct(*order)
    return F.min_by(s, key if valid is None else F.when(valid, key))


def _choice(rule: str, target: float, total_samples: int | None) -> tuple[Column, Column]:
    """The metric structs of a search's best threshold and of its fallback, as aggregates over the curve."""
    p, r, t = F.col("precision"), F.col("recall"), F.col("threshold")
    if rule == "precision":
        return _pick(p >= F.lit(target), [-r, t]), _pick(None, [-p, t])
    if rule == "recall":
        return _pick(r >= F.lit(target), [-p, t]), _pick(None, [-r, t])
    if rule == "budget":
        max_rate = F.lit(float(target)) / (_samples(total_samples) / F.lit(float(HOURS_PER_DAY)))
        return (_pick(F.col("alert_rate") <= max_rate, [-p, -t]),
                F.coalesce(_pick(r >= F.lit(BUDGET_FALLBACK_RECALL), [-p, t]), _pick(None, [-r, t])))
    raise ValueError(rule)


def _search(scored: DataFrame, rules: list[tuple[str, float]], total_samples: int | None = None, **kw) -> DataFrame:
    """One row per (rule, target): every search is a pair of aggregates over one pass of one curve."""
    curve = with_metrics(pr_curve(scored, drop_max_threshold=True, **kw), total_samples)
    return search_curve(curve, rules, total_samples)


def search_curve(curve: DataFrame, rules: list[tuple[str, float]], total_samples: int | None = None) -> DataFrame:
    picks = [_choice(rule, target, total_samples) for rule, target in rules]
    row = curve.agg(*[c.alias(f"{k}{i}") for i, pair in enumerate(picks) for k, c in zip("ab", pair)])
    found = [F.struct(F.lit(rule).alias("strategy"), F.lit(float(target)).alias("target"),
                      F.coalesce(f"a{i}", f"b{i}").alias("m"), F.col(f"a{i}").isNull().alias("fallback"))
             for i, (rule, target) in enumerate(rules)]
    return row.select(F.inline(F.array(*found))).select("strategy", "target", "m.*", "fallback")


def for_precision(scored: DataFrame, min_precision: float = MIN_PRECISION, **kw) -> DataFrame:
    """Among thresholds with precision >= p the highest recall (ties: lowest threshold); else the highest
    precision (ties: lowest threshold)."""
    return _search(scored, [("precision", min_precision)], **kw)


def for_recall(scored: DataFrame, target_recall: float, **kw) -> DataFrame:
    """Among thresholds with recall >= r the highest precision (ties: lowest threshold); else the highest
    recall."""
    return _search(scored, [("recall", target_recall)], **kw)


def for_alert_budget(scored: DataFrame, alerts_per_day: float, total_samples: int | None = None, **kw) -> DataFrame:
    """Alert rate <= budget / (total_samples / 24): the highest precision (ties: highest threshold); else the
    recall-0.1 search.  ``total_samples`` is the size of the data set that the scored rows stand for (default: their
    number)."""
    return _search(scored, [("budget", alerts_per_day)], total_samples, **kw)


def optimize_thresholds(scored: DataFrame, recall_targets=RECALL_TARGETS, budgets=ALERT_BUDGETS,
                        total_samples: int | None = None, **kw) -> DataFrame:
    """The recall-target and alert-budget searches, one row per strategy/target, from one aggregate."""
    return _search(scored, [*(("recall", r) for r in recall_targets), *(("budget", b) for b in budgets)], total_samples, **kw)


def threshold_table(scored: DataFrame, **kw) -> DataFrame:
    """Per threshold (highest dropped): precision, recall, f1, alert_rate, alerts_per_day (rate*24),
    alerts_per_day_scaled (rate*n/24)."""
    c = with_metrics(pr_curve(scored, drop_max_threshold=True, **kw))
    return c.select("threshold", "precision", "recall", "f1", "alert_rate", "alerts_per_day", "alerts_per_day_scaled")


def threshold_table_eps(scored: DataFrame, **kw) -> DataFrame:
    """Report variant: f1 = 2pr / (p + r + 1e-9)."""
    c = pr_curve(scored, drop_max_threshold=True, **kw)
    p, r = F.col("precision"), F.col("recall")
    return c.select("threshold", "precision", "recall",
                    F.coalesce(F.lit(2.0) * p * r / (p + r + F.lit(F1_EPS)), F.lit(0.0)).alias("f1"))


def best_f1_threshold(scored: DataFrame, **kw) -> DataFrame:
    """Row of the eps threshold table with the highest f1 (ties: lowest threshold)."""
    return best_f1(threshold_table_eps(scored, **kw))


def best_f1(t: DataFrame) -> DataFrame:
    best = F.min_by(F.struct("threshold", "precision", "recall", "f1"), F.struct(-F.col("f1"), F.col("threshold")))
    return t.agg(best.alias("b")).select(F.col("b.threshold").alias("best_threshold"),
                                         F.col("b.precision").alias("best_precision"),
                                         F.col("b.recall").alias("best_recall"), F.col("b.f1").alias("best_f1"))


def sweep_grid(start: float = SWEEP_START, stop: float = SWEEP_STOP, num: int = SWEEP_NUM) -> list[float]:
    """Threshold grid with the reference's float values (evenly spaced, end point exact)."""
    return [float(v) for v in np.linspace(start, stop, num)]


def threshold_sweep(scored: DataFrame, thresholds: list[float], score: str = "score",
                    label: str = "label") -> DataFrame:
    """Confusion counts at every threshold of a (bounded, parameter-sized) grid, without a cross join.

    Each row finds how many grid thresholds it reaches (``score >= t``); one grouped pass counts rows per
    reach; the per-threshold counts are suffix sums over that table (at most len(grid)+1 rows).
    """
    spark: SparkSession = scored.sparkSession
    grid = sorted(float(t) for t in thresholds)
    # number of grid thresholds <= score, as one code-generated CASE (highest threshold first)
    reach = F.lit(0)
    for i, t in enumerate(grid):
        reach = F.when(F.col(score) >= F.lit(t), F.lit(i + 1)).otherwise(reach)
    y = F.col(label).cast("long")
    counts = scored.groupBy(reach.alias("_reach")).agg(
        F.count(F.lit(1)).alias("_c"), F.coalesce(F.sum(y), F.lit(0)).alias("_p"))
    g = literal_table(spark, [(i, float(t)) for i, t in enumerate(grid)], ["_i", "threshold"])
    # row reaches threshold i iff _reach > i; both sides hold at most len(grid)+1 rows
    j = F.broadcast(g).crossJoin(F.broadcast(counts))
    hit = F.col("_reach") > F.col("_i")
    agg = j.groupBy("_i", "threshold").agg(
        F.sum(F.when(hit, F.col("_p")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("_c") - F.col("_p")).otherwise(0)).alias("fp"),
        F.sum(F.col("_p")).alias("n_pos"), F.sum(F.col("_c")).alias("n_rows"))
    return agg.select("threshold", "tp", "fp", (F.col("n_pos") - F.col("tp")).alias("fn"),
                      (F.col("n_rows") - F.col("n_pos") - F.col("fp")).alias("tn"), "n_rows", "n_pos")


def daily_alert_simulation(scored: DataFrame, hours_per_day: int = HOURS_PER_DAY, **kw) -> DataFrame:
    """50 thresholds from 0.01 to 0.99: alerts_per_day = alert rate * 24, precision (0 without alerts)."""
    s = threshold_sweep(scored, sweep_grid(), **kw)
    rate = (F.col("tp") + F.col("fp")).cast("double") / F.col("n_rows")
    return s.select("threshold", (rate * F.lit(float(hours_per_day))).alias("alerts_per_day"),
                    safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    rate.alias("alert_rate"))
