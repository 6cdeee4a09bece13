"""Rare-event evaluation: confusion counts, reports, top-k, recall at a fixed FPR, bucketed top-k,
business KPIs and the long metric report.  Every metric is an aggregate; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from raretide.functions.scalar import fmt_fixed, literal_table, safe_div, threshold_predict
from raretide.operators.curves import curve_points, roc_curve, totals
from raretide.operators.split import position_buckets
from raretide.session import written
from raretide.operators.thresholds import HOURS_PER_DAY, threshold_sweep

# Fixed values of the reference's report.
FPR_TARGETS = [0.01, 0.05, 0.10]
TOP_K = [10, 25, 50, 100]
TOP_PER_BUCKET = 5
N_BUCKETS = 24
KPI_MIN_PRECISION = 0.6
KPI_MAX_ALERTS_PER_DAY = 10
KPI_MAX_FP_PER_1000 = 5


def confusion(scored: DataFrame, threshold: float | Column = 0.5, score: str = "score",
              label: str = "label") -> DataFrame:
    """One row tn, fp, fn, tp at ``score >= threshold``; always four cells, also with one class only."""
    yhat = threshold_predict(score, threshold)
    y = F.col(label).cast("int")
    c = lambda cond: F.count(F.when(cond, F.lit(1))).cast("long")
    return scored.agg(c((y == 0) & (yhat == 0)).alias("tn"), c((y == 0) & (yhat == 1)).alias("fp"),
                      c((y == 1) & (yhat == 0)).alias("fn"), c((y == 1) & (yhat == 1)).alias("tp"))


def threshold_metrics(scored: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """threshold, precision, recall, specificity, f1, tp, fp, fn, tn, alert_rate (0 for empty denominators)."""
    cm = confusion(scored, threshold, **kw)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p = safe_div(tp, tp + fp)
    r = safe_div(tp, tp + fn)
    return cm.select(F.lit(float(threshold)).alias("threshold"), p.alias("precision"), r.alias("recall"),
                     safe_div(tn, tn + fp).alias("specificity"),
                     F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"),
                     "tp", "fp", "fn", "tn", safe_div(tp + fp, tp + fp + fn + tn).alias("alert_rate"))


def accuracy(scored: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label") -> DataFrame:
    return scored.agg(F.avg((threshold_predict(score, threshold) == F.col(label).cast("int")).cast("double"))
                      .alias("accuracy"))


def classification_report(scored: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """Per class 0/1 and 'weighted avg': precision, recall, f1, support (0 for empty denominators)."""
    cm = confusion(scored, threshold, **kw)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(cls: str, t: Column, f_p: Column, f_n: Column) -> Column:
        p, r = safe_div(t, t + f_p), safe_div(t, t + f_n)
        return F.struct(F.lit(cls).alias("class"), p.alias("precision"), r.alias("recall"),
                        F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"),
                        (t + f_n).alias("support"))
    rows = cm.select(F.array(row("0", tn, fn, fp), row("1", tp, fp, fn)).alias("a")).select(F.explode("a").alias("r"))
    per = rows.select("r.*")
    tot = F.sum("support").over(Window.partitionBy())   # two rows
    w = per.select("*", (F.col("support").cast("double") / tot).alias("_w"))
    avg = w.agg(F.lit("weighted avg").alias("class"), F.sum(F.col("precision") * F.col("_w")).alias("precision"),
                F.sum(F.col("recall") * F.col("_w")).alias("recall"), F.sum(F.col("f1") * F.col("_w")).alias("f1"),
                F.sum("support").alias("support"))
    return per.unionByName(avg)


def precision_at_top_k(scored: DataFrame, ks: Sequence[int] = TOP_K, score: str = "score", label: str = "label",
                       order_id: str = "row_id") -> DataFrame:
    """For each k < n: the k highest scores (ties: higher ``order_id`` first, as a stable ascending sort
    read from the end) -> precision, recall, min score (threshold), alert_rate = k / n.

    One TakeOrderedAndProject of max(k) rows; each partition keeps only its own top max(k)."""
    kmax = max(ks)
    top = scored.orderBy(F.col(score).desc(), F.col(order_id).desc()).limit(kmax)
    # a window over the max(k) rows of the limit: bounded by the largest k
    top = top.withColumn("_r", F.row_number().over(Window.orderBy(F.col(score).desc(), F.col(order_id).desc())))
    tot = totals(scored, label)
    ksdf = literal_table(scored.sparkSession, [(int(k),) for k in ks], ["k"])
    j = F.broadcast(ksdf).crossJoin(top.select("_r", score, label))   # len(ks) x max(k) rows
    agg = j.where(F.col("_r") <= F.col("k")).groupBy("k").agg(
        F.sum(F.col(label).cast("long")).alias("tp"), F.min(score).alias("threshold"))
    out = agg.crossJoin(F.broadcast(tot)).where(F.col("k") < F.col("n_rows"))
    return out.select("k", "threshold", safe_div(F.col("tp"), F.col("k")).alias("precision"),
                      safe_div(F.col("tp"), F.col("n_pos")).alias("recall"), F.col("tp"),
                      (F.col("k") - F.col("tp")).alias("fp"),
                      (F.col("k").cast("double") / F.col("n_rows")).alias("alert_rate"))


def recall_at_fixed_fpr(scored: DataFrame, targets: Sequence[float] = FPR_TARGETS, **kw) -> DataFrame:
    """For each target FPR: the ROC vertex nearest to it (ties: highest threshold; the (0,0) start point
    has threshold +inf and raises no alert), and recall, precision, fpr, alert_rate there."""
    picks = []
    for target in targets:  # one min_by per target, all in one aggregate over the vertices
        near = F.struct(F.abs(F.col("fpr") - F.lit(float(target))), -F.col("threshold"))
        picks.append(F.struct(F.lit(float(target)).alias("target_fpr"), F.min_by(F.struct("threshold", "tp", "fp", "n_rows", "n_pos", "n_neg"), near).alias("v")))
    best = roc_curve(scored, **kw).agg(F.array(*picks).alias("a")).select(F.inline("a"))
    v = lambda c: F.col(f"v.{c}")
    return best.select("target_fpr", v("threshold").alias("threshold"),
                       safe_div(v("tp"), v("n_pos")).alias("recall"),
                       safe_div(v("tp"), v("tp") + v("fp")).alias("precision"),
                       safe_div(v("fp"), v("n_neg")).alias("fpr"),
                       v("tp").alias("tp"), v("fp").alias("fp"),
                       (v("tp") + v("fp")).cast("double").__truediv__(v("n_rows")).alias("alert_rate"))


def bucket_topk_precision(scored: DataFrame, top: int = TOP_PER_BUCKET, n_buckets: int = N_BUCKETS,
                          score: str = "score", label: str = "label", ts: str = "ts",
                          order_id: str = "row_id", salts: int = 64) -> DataFrame:
    """Rows split by position into at most 24 buckets of n div 24 rows; mean over buckets of the precision
    of the 5 highest scores (ties: later row first).  NULL when n < 24.

    Top-5 per bucket in two phases (per (bucket, salt), then per bucket over <= 5*salts rows), so a bucket
    holding 1/24 of the table is not one task."""
    scored = written(scored.select(*dict.fromkeys([score, label, ts, order_id])), "topk")
    n = scored.count()
    size = n // n_buckets
    if not size:
        return scored.agg(F.lit(None).cast("double").alias("top_5_precision"))
    d = position_buckets(scored, [i * size for i in range(1, n_buckets + 1)], n, ts, order_id).where(F.col("_b") < n_buckets)
    d = d.withColumn("_salt", F.pmod(F.xxhash64(order_id), F.lit(salts)))
    order = [F.col(score).desc(), F.col(ts).desc(), F.col(order_id).desc()]
    d = d.withColumn("_r1", F.row_number().over(Window.partitionBy("_b", "_salt").orderBy(*order))).where(f"_r1 <= {top}")
    d = d.withColumn("_r2", F.row_number().over(Window.partitionBy("_b").orderBy(*order))).where(f"_r2 <= {top}")
    per = d.groupBy("_b").agg(F.avg(F.col(label).cast("double")).alias("_p"))
    res = per.agg(F.avg("_p").alias("top_5_precision"))
    return res


def rare_event_table(scored: DataFrame, thresholds: Sequence[float], **kw) -> DataFrame:
    """Per threshold: precision, recall, specificity, alert_rate, alerts_per_day (scaled n/24),
    top_5_precision (threshold independent), tp, fp, fn."""
    s = threshold_sweep(scored, list(thresholds), **{k: v for k, v in kw.items() if k in ("score", "label")})
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rate = (tp + fp).cast("double") / F.col("n_rows")
    top5 = bucket_topk_precision(scored, **kw)
    out = s.crossJoin(F.broadcast(top5))        # one-row right side
    return out.select("threshold", safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"),
                      safe_div(tn, tn + fp).alias("specificity"), rate.alias("alert_rate"),
                      (rate * (F.col("n_rows").cast("double") / F.lit(float(HOURS_PER_DAY)))).alias("alerts_per_day"),
                      F.coalesce(F.col("top_5_precision"), F.lit(0.0)).alias("top_5_precision"), "tp", "fp", "fn")


def rare_event_metrics(scored: DataFrame, **kw) -> DataFrame:
    """Long report: recall@FPR rows and precision@top-k rows with formatted names and info strings."""
    fpr = recall_at_fixed_fpr(scored, **{k: v for k, v in kw.items() if k in ("score", "label")})
    a = fpr.select(F.lit("recall_at_fpr").alias("metric_type"),
                   F.concat(F.lit("Recall @ "), fmt_fixed(F.col("target_fpr") * 100, 1), F.lit("% FPR")).alias("metric_name"),
                   F.col("recall").alias("value"), "threshold",
                   F.concat(F.lit("Precision: "), fmt_fixed(F.col("precision"), 3), F.lit(", Alerts/day: "),
                            fmt_fixed(F.col("alert_rate") * 24, 1)).alias("additional_info"))
    k = precision_at_top_k(scored, **kw)
    b = k.select(F.lit("precision_at_k").alias("metric_type"),
                 F.format_string("Precision @ Top-%d", F.col("k")).alias("metric_name"),
                 F.col("precision").alias("value"), "threshold",
                 F.concat(F.lit("Recall: "), fmt_fixed(F.col("recall"), 3), F.lit(", Alerts/day: "),
                          fmt_fixed(F.col("alert_rate") * 24, 1)).alias("additional_info"))
    return a.unionByName(b)


def business_kpis(metrics: DataFrame) -> DataFrame:
    """From a one-row search result (precision, recall, fp, alert_rate) and ``n``: alerts/day = rate*24,
    FP per 1000 = fp/n*1000, and the three recommendation flags."""
    apd = F.col("alert_rate") * F.lit(24.0)
    fpk = F.col("fp").cast("double") / F.col("n_rows") * F.lit(1000.0)
    return metrics.select(
        "precision", "recall", apd.alias("alerts_per_day"), fpk.alias("false_positives_per_1000"),
        (F.col("precision") >= F.lit(KPI_MIN_PRECISION)).alias("meets_precision"),
        (apd <= F.lit(float(KPI_MAX_ALERTS_PER_DAY))).alias("manageable_volume"),
        (fpk <= F.lit(float(KPI_MAX_FP_PER_1000))).alias("low_false_positive_rate"),
        F.when(F.col("precision") >= F.lit(KPI_MIN_PRECISION), F.lit("meets precision requirement"))
         .otherwise(F.lit("below precision target")).alias("precision_note"),
        (F.col("n_pos").cast("double") / F.col("n_rows")).alias("positive_rate"))


def cost_benefit(metrics: DataFrame, hourly_downtime_cost: float = 50_000.0,
                 implementation_cost: float = 100_000.0) -> DataFrame:
    """Documented business case: savings = prevented failures (tp) x hourly downtime cost; ROI multiple =
    savings / implementation cost."""
    saved = F.col("tp").cast("double") * F.lit(float(hourly_downtime_cost))
    return metrics.select("tp", saved.alias("estimated_savings"),
                          (saved / F.lit(float(implementation_cost))).alias("roi_multiple"))


def pr_auc_only(scored: DataFrame, **kw) -> DataFrame:
    pts = curve_points(scored, **kw)
    dr = F.col("recall") - F.col("recall_prev")
    return pts.agg(F.sum(dr * (F.col("precision") + F.col("precision_prev")) / F.lit(2.0)).alias("pr_auc"))


def model_metrics(scored: DataFrame, model: str, total_samples: int | None = None, **kw) -> DataFrame:
    """One comparison row: pr_auc, accuracy and failure-class precision/recall/f1 at 0.5, the best-F1
    threshold of the report table and the 60 %-precision threshold with its alerts/day and FP per 1000 of
    ``total_samples`` (default: the scored rows).  All are aggregates of one pass over one curve."""
    from raretide.operators.thresholds import F1_EPS, MIN_PRECISION, with_metrics
    c = with_metrics(curve_points(scored, **kw))
    p, r, inner = F.col("precision"), F.col("recall"), ~F.col("is_max")
    f1 = F.coalesce(F.lit(2.0) * p * r / (p + r + F.lit(F1_EPS)), F.lit(0.0))
    dr = r - F.col("recall_prev")
    first, fallback = (F.min_by(*x) for x in _inner_choices("precision", MIN_PRECISION, inner))
    high = F.col("threshold") >= F.lit(0.5)  # counts at 0.5 are those of the lowest threshold from there on
    a = c.agg(
        F.sum(dr * (p + F.col("precision_prev")) / F.lit(2.0)).alias("pr_auc"), F.max("n_rows").alias("n"), F.max("n_pos").alias("np"),
        F.coalesce(F.max(F.when(high, F.col("tp"))), F.lit(0)).alias("tp5"), F.coalesce(F.max(F.when(high, F.col("fp"))), F.lit(0)).alias("fp5"),
        F.min_by(F.struct("threshold", "precision", "recall", f1.alias("f1")), F.when(inner, F.struct(-f1, "threshold"))).alias("b"),
        F.coalesce(first, fallback).alias("t"))
    tp, fp, n = F.col("tp5"), F.col("fp5"), F.col("n")
    fprec, frec = safe_div(tp, tp + fp), safe_div(tp, F.col("np"))
    total = n if total_samples is None else F.lit(total_samples)
    return a.select(
        F.lit(model).alias("model"), "pr_auc", ((n - F.col("np") - fp + tp).cast("double") / n).alias("accuracy"),
        fprec.alias("failure_precision"), frec.alias("failure_recall"),
        F.when(fprec + frec > 0, F.lit(2.0) * fprec * frec / (fprec + frec)).otherwise(F.lit(0.0)).alias("failure_f1"),
        F.col("b.threshold").alias("best_threshold"), F.col("b.precision").alias("best_precision"), F.col("b.recall").alias("best_recall"), F.col("b.f1").alias("best_f1"),
        F.col("t.threshold").alias("precision_threshold"), F.col("t.precision").alias("precision_at_threshold"), F.col("t.recall").alias("recall_at_threshold"),
        (F.col("t.alert_rate") * 24).alias("alerts_per_day"), (F.col("t.fp").cast("double") / total * 1000).alias("false_positives_per_1000"))


def _inner_choices(rule: str, target: float, inner: Column):
    """Value and order of the precision search and its fallback among the thresholds below the highest score."""
    row = F.struct("threshold", "precision", "recall", "fp", "alert_rate")
    p, r, t = F.col("precision"), F.col("recall"), F.col("threshold")
    return (row, F.when(inner & (p >= F.lit(target)), F.struct(-r, t))), (row, F.when(inner, F.struct(-p, t)))


def evaluation_report(scored: DataFrame, total_samples: int | None = None, **kw) -> dict[str, DataFrame]:
    """The whole evaluation of one scored table: basic areas, threshold table, the precision-driven threshold, recall
    and budget searches, rare-event rows and the alert simulation."""
    from raretide.operators.curves import pr_areas, roc_auc
    from raretide.operators.thresholds import daily_alert_simulation, for_precision, optimize_thresholds, threshold_table
    return {
        "basic_metrics": pr_areas(scored, **kw).select("pr_auc", "avg_precision", "avg_recall").crossJoin(roc_auc(scored, **kw)),
        "classification_report": classification_report(scored, 0.5, **kw),
        "threshold_table": threshold_table(scored, **kw),
        "precision_threshold": for_precision(scored, **kw),
        "threshold_optimization": optimize_thresholds(scored, total_samples=total_samples, **kw),
        "rare_event_metrics": rare_event_metrics(scored, **kw),
        "daily_alert_simulation": daily_alert_simulation(scored, **kw),
    }
