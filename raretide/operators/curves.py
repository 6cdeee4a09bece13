"""Exact precision-recall and ROC curves without driver arrays.

One grouped pass turns the scored table into one row per distinct score (positives, negatives at that
score; map-side partial aggregation, so a score shared by a third of all rows is one row).  Cumulative
counts over distinct scores come from two-level prefix sums (per even score range + carried totals),
so no step sorts the whole table in one task.  All curve quantities of the reference derive from:

  tp(t) = #positives with score >= t,  fp(t) = #negatives with score >= t,
  the next higher threshold has tp - pos(t), fp - neg(t)  (no neighbour lookup needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from raretide.functions.scalar import safe_div
from raretide.operators.scan import prefix_sums, previous_rows, range_cuts, range_piece
from raretide.session import written

def score_counts(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score: pos, neg."""
    y = F.col(label).cast("long")
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.coalesce(F.sum(y), F.lit(0)).alias("pos"),
        (F.count(F.lit(1)) - F.coalesce(F.sum(y), F.lit(0))).alias("neg"))


def totals(scored: DataFrame, label: str = "label") -> DataFrame:
    """One row: n, P, N (and the maximum score, used to drop the top threshold)."""
    y = F.col(label).cast("long")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(y), F.lit(0)).alias("n_pos"),
                      (F.count(F.lit(1)) - F.coalesce(F.sum(y), F.lit(0))).alias("n_neg"))


def curve_points(scored: DataFrame, score: str = "score", label: str = "label", neighbours: bool = False) -> DataFrame:
    """One row per distinct score t with tp, fp, fn, tn, precision, recall, and the previous (next higher
    threshold) point ``precision_prev``, ``recall_prev`` ((1, 0) above the highest score), plus n, P, N,
    ``is_max`` (t is the highest score).  With ``neighbours`` also ``pos_lo, neg_lo``, the counts at the next lower
    score (null at the lowest).  The scored table is read once; its scores are cut into even ranges by quantiles, so
    scores crowded at 0 or unbounded margins balance as well.

    recall is 1 everywhere when there are no positives, as in the reference's curve function.
    """
    sc = written(score_counts(scored, score, label), "scores")
    piece = range_piece("score", range_cuts(sc, "score"))
    ps = prefix_sums(sc, [], "score", piece, ["pos", "neg"], prefix="below_", inclusive=False)
    if neighbours:
        ps = previous_rows(ps, "score", piece, {"pos": "pos_lo", "neg": "neg_lo"})
    # totals from the per-score counts (no second scan of the scored table)
    tot = sc.agg((F.sum("pos") + F.sum("neg")).alias("n_rows"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # one-row table: broadcast is size-proven
    d = ps.crossJoin(F.broadcast(tot))
    tp = F.col("n_pos") - F.col("below_pos")
    fp = F.col("n_neg") - F.col("below_neg")
    d = d.select("score", "pos", "neg", "n_rows", "n_pos", "n_neg", tp.alias("tp"), fp.alias("fp"), *(["pos_lo", "neg_lo"] if neighbours else []))
    d = d.withColumns({"fn": F.col("n_pos") - F.col("tp"), "tn": F.col("n_neg") - F.col("fp"),
                       "tp_prev": F.col("tp") - F.col("pos"), "fp_prev": F.col("fp") - F.col("neg")})
    rec = lambda t: F.when(F.col("n_pos") == 0, F.lit(1.0)).otherwise(t.cast("double") / F.col("n_pos"))
    d = d.withColumns({
        "precision": safe_div(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": rec(F.col("tp")),
        "precision_prev": F.when(F.col("tp_prev") + F.col("fp_prev") == 0, F.lit(1.0))
                           .otherwise(F.col("tp_prev").cast("double") / (F.col("tp_prev") + F.col("fp_prev"))),
        "recall_prev": F.when(F.col("tp_prev") + F.col("fp_prev") == 0, F.lit(0.0)).otherwise(rec(F.col("tp_prev"))),
        "is_max": (F.col("tp_prev") + F.col("fp_prev")) == 0,
    })
    return d.withColumnRenamed("score", "threshold")


def pr_curve(scored: DataFrame, drop_max_threshold: bool = False, **kw) -> DataFrame:
    """(threshold, precision, recall, tp, fp, ...) per distinct score; optionally without the highest score
    (both of the reference's optimisers drop it)."""
    pts = curve_points(scored, **kw)
    return pts.where(~F.col("is_max")) if drop_max_threshold else pts


def pr_areas(scored: DataFrame, **kw) -> DataFrame:
    """One row: pr_auc (trapezoid incl. the (r=0, p=1) end point), average_precision (step sum),
    avg_precision / avg_recall (plain means of the curve points incl. the end point), n_points."""
    return area_aggregates(curve_points(scored, **kw))


def area_aggregates(pts: DataFrame) -> DataFrame:
    dr = F.col("recall") - F.col("recall_prev")
    return pts.agg(
        F.sum(dr * (F.col("precision") + F.col("precision_prev")) / F.lit(2.0)).alias("pr_auc"),
        F.sum(dr * F.col("precision")).alias("average_precision"),
        ((F.sum("precision") + F.lit(1.0)) / (F.count(F.lit(1)) + F.lit(1))).alias("avg_precision"),
        (F.sum("recall") / (F.count(F.lit(1)) + F.lit(1))).alias("avg_recall"),
        (F.count(F.lit(1)) + F.lit(1)).alias("n_points"))


def roc_curve(scored: DataFrame, drop_intermediate: bool = True, **kw) -> DataFrame:
    """ROC vertices (threshold, fpr, tpr, tp, fp) in the reference library's form: a start point (0, 0)
    with threshold +inf, then distinct scores descending; with ``drop_intermediate`` only the first, the
    last and the points where the slope changes are kept (second difference of fp or tp non-zero)."""
    d = curve_points(scored, neighbours=True, **kw)
    first_or_last = F.col("pos_lo").isNull() | F.col("is_max")
    keep = first_or_last | (F.col("pos_lo") != F.col("pos")) | (F.col("neg_lo") != F.col("neg"))
    if drop_intermediate:
        d = d.where(keep)
    fpr = lambda c: safe_div(F.col(c), F.col("n_neg"), None)
    tpr = lambda c: safe_div(F.col(c), F.col("n_pos"), None)
    verts = d.select("threshold", "tp", "fp", "n_rows", "n_pos", "n_neg", fpr("fp").alias("fpr"), tpr("tp").alias("tpr"))
    start = d.where("is_max").select(F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                                     "n_rows", "n_pos", "n_neg", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return verts.unionByName(start)


def roc_auc(scored: DataFrame, **kw) -> DataFrame:
    """One row: roc_auc = trapezoid over all distinct thresholds (collinear points do not change it)."""
    pts = curve_points(scored, **kw)
    fpr = safe_div(F.col("fp"), F.col("n_neg"), None)
    tpr = safe_div(F.col("tp"), F.col("n_pos"), None)
    fpr0 = safe_div(F.col("fp_prev"), F.col("n_neg"), None)
    tpr0 = safe_div(F.col("tp_prev"), F.col("n_pos"), None)
    return pts.agg(F.sum((fpr - fpr0) * (tpr + tpr0) / F.lit(2.0)).alias("roc_auc"))
