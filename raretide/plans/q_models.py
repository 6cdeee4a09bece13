"""Registered queries: scaler, sampling, linear explanations, model comparison, Spark ML models (rows-only)
and the streaming operators (drained with availableNow; SQL twins on the batch tables)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from raretide.operators import evaluate as E
from raretide.operators import models as M
from raretide.operators import thresholds as T
from raretide.operators import trees as R
from raretide.operators.curves import pr_areas
from raretide.operators.explain import contribution_sums, contributions, mean_abs_contribution, pick_failure_row, sample_rows, separation_weights, weights_from_model
from raretide.operators.features import build_features
from raretide.operators.scale import align_schema, apply_scaler, fit_scaler, load_scaler, per_feature, save_scaler, select_features
from raretide.operators.scan import carry_last
from raretide.operators.windows import drop_unlabelled, label_lead, with_order
from raretide.plans.oracle import HOURLY_GAPS, READINGS, SCORED, scored_cte, with_ctes
from raretide.plans.oracle_features import features_sql
from raretide.plans.q_eval import CURVE, _metric_sql
from raretide.plans.q_misc import _REQ_SQL
from raretide.plans.q_series import FEATURES, SENSORS, labelled_split, split_sql
from raretide.plans.registry import ORACLES, register
from raretide.session import scratch_path, written
from raretide.sources import fixtures as fx
from raretide.sources import io as IO
from raretide.streaming import ops as S

_FEAT = split_sql("readings") + ",\n" + features_sql("sp", ["entity_id", "split"], SENSORS, "row_id",
                                                      ["row_id", "entity_id", "split", "ts", "failure", "failure_24h"])


def reading_features(spark, sf_dir, split=None):
    """Feature table of the readings, written once: statistics, scaling, models and explanations all read it.  Both splits, or the rows
    of one, whose series are its own."""
    rows = labelled_split(spark, sf_dir, "readings")
    rows = rows.where(F.col("split") == split) if split else rows
    return written(build_features(rows, ["entity_id"], SENSORS, split_col="split", one_pass=True), "features")


def _stats_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, avg({c}) AS mean, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS scale "
             f"FROM feat WHERE split = 'train'" for c in FEATURES]
    return "stats AS MATERIALIZED (" + "\nUNION ALL ".join(parts) + ")"


@register("fit_scaler", "feature:s mean:v scale:v", _FEAT + ",\n" + _stats_sql() + "\nSELECT * FROM stats")
def q_fit_scaler(spark, sf_dir):
    """Population mean / std per feature on the training split (std 0 -> 1)."""
    return fit_scaler(reading_features(spark, sf_dir, "train"), FEATURES)


_STATS_WIDE = "sw AS (SELECT " + ", ".join(
    f"max(mean) FILTER (WHERE feature = '{c}') AS m_{i}, max(scale) FILTER (WHERE feature = '{c}') AS s_{i}"
    for i, c in enumerate(FEATURES)) + " FROM stats)"


@register("apply_scaler", "row_id:l split:s " + " ".join(f"{c}:v" for c in FEATURES), _FEAT + ",\n" + _stats_sql() + ",\n" + _STATS_WIDE + """
SELECT row_id, split, """ + ", ".join(f"({c} - m_{i}) / s_{i} AS {c}" for i, c in enumerate(FEATURES)) + " FROM feat CROSS JOIN sw")
def q_apply_scaler(spark, sf_dir):
    """Train and validation features scaled with the training statistics."""
    f = reading_features(spark, sf_dir)
    stats = fit_scaler(f.where("split = 'train'"), FEATURES)
    return apply_scaler(f, stats, FEATURES).select("row_id", "split", *FEATURES)


_SAMPLE_KEY = "(((row_id % 2147483648) * 2654435761 + 42) % 4294967296)"


@register("sample_rows", "row_id:l entity_id:l ts:t temperature:d", with_ctes(READINGS) +
          f"SELECT row_id, entity_id, ts, temperature FROM readings ORDER BY {_SAMPLE_KEY}, row_id LIMIT 1000")
def q_sample_rows(spark, sf_dir):
    """Deterministic 1,000-row sample (hash order, seed 42)."""
    return sample_rows(fx.readings(spark, sf_dir)).select("row_id", "entity_id", "ts", "temperature")


@register("pick_failure_row", "row_id:l entity_id:l ts:t", split_sql("readings") +
          f" SELECT row_id, entity_id, ts FROM sp WHERE split = 'val' AND failure_24h = 1 ORDER BY {_SAMPLE_KEY}, row_id LIMIT 1")
def q_pick_failure_row(spark, sf_dir):
    """One positive validation row to explain."""
    return pick_failure_row(labelled_split(spark, sf_dir, "readings").where("split = 'val'")).select("row_id", "entity_id", "ts")


def _weights_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, coalesce(avg({c}) FILTER (WHERE failure_24h = 1) - avg({c}) FILTER (WHERE failure_24h = 0), 0.0) "
             f"/ max(s_{i}) AS weight, max(m_{i}) AS mean "
             f"FROM feat CROSS JOIN sw WHERE split = 'train'" for i, c in enumerate(FEATURES)]
    return "wts AS (" + "\nUNION ALL ".join(parts) + ")"


_LONG = "long AS (" + "\nUNION ALL ".join(f"SELECT row_id, '{c}' AS feature, {c} AS value FROM feat WHERE split = 'val'" for c in FEATURES) + ")"


@register("global_explanation", "feature:s importance:v", _FEAT + ",\n" + _stats_sql() + ",\n" + _STATS_WIDE + ",\n" + _weights_sql() + ",\n" + _LONG + """
SELECT feature, avg(abs(weight * (value - mean))) AS importance FROM long JOIN wts USING (feature) GROUP BY feature""")
def q_global_explanation(spark, sf_dir):
    """Mean |contribution| per feature of the linear separation scorer on the validation split."""
    f = reading_features(spark, sf_dir)
    stats = fit_scaler(f.where("split = 'train'"), FEATURES)
    w = separation_weights(f.where("split = 'train'"), stats, FEATURES)
    c = contributions(f.where("split = 'val'"), w, FEATURES)
    return mean_abs_contribution(c)


# ---------------------------------------------------------------- model comparison

_MODELS = {"model_a": ("0.7", "0.03", False), "model_b": ("0.4", "0.06", True)}


def _model_row_sql(name: str, wt: str, wv: str) -> str:
    curve = CURVE.replace(SCORED, scored_cte("scored", wt, wv))
    return curve + f""", cm AS (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.5::DOUBLE) AS tp,
  count(*) FILTER (WHERE label = 0 AND score >= 0.5::DOUBLE) AS fp, count(*) FILTER (WHERE label = 1 AND score < 0.5::DOUBLE) AS fn,
  avg(CASE WHEN (score >= 0.5::DOUBLE)::INT = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored),
fm AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS fp_, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS fr_ FROM cm),
eps AS (SELECT threshold, precision, recall, coalesce(2 * precision * recall / (precision + recall + 1e-9::DOUBLE), 0) AS f1 FROM tr),
best AS (SELECT * FROM eps ORDER BY f1 DESC, threshold LIMIT 1),
pa AS (SELECT * FROM tr WHERE precision >= 0.6::DOUBLE ORDER BY recall DESC, threshold LIMIT 1),
pb AS (SELECT * FROM tr ORDER BY precision DESC, threshold LIMIT 1),
pt AS (SELECT * FROM pa UNION ALL SELECT * FROM pb WHERE NOT EXISTS (SELECT 1 FROM pa))
SELECT '{name}' AS model, (SELECT sum((recall - recall_prev) * (precision + precision_prev) / 2) FROM lagged) AS pr_auc,
       fm.accuracy, fm.fp_ AS failure_precision, fm.fr_ AS failure_recall,
       CASE WHEN fm.fp_ + fm.fr_ > 0 THEN 2 * fm.fp_ * fm.fr_ / (fm.fp_ + fm.fr_) ELSE 0.0 END AS failure_f1,
       best.threshold AS best_threshold, best.precision AS best_precision, best.recall AS best_recall, best.f1 AS best_f1,
       pt.threshold AS precision_threshold, pt.precision AS precision_at_threshold, pt.recall AS recall_at_threshold,
       pt.alert_rate * 24 AS alerts_per_day, pt.fp::DOUBLE / pt.n_rows * 1000 AS false_positives_per_1000
FROM fm, best, pt"""


_CMP_SPEC = ("model:s pr_auc:d accuracy:d failure_precision:d failure_recall:d failure_f1:d best_threshold:d best_precision:d "
             "best_recall:d best_f1:d precision_threshold:d precision_at_threshold:d recall_at_threshold:d alerts_per_day:d "
             "false_positives_per_1000:d")
_CMP_SQL = "\nUNION ALL\n".join(f"SELECT * FROM ({_model_row_sql(n, a, b)})" for n, (a, b, _) in _MODELS.items())


def model_comparison(spark, sf_dir):
    rows = []
    for name, (_, _, second) in _MODELS.items():
        s = fx.scored(spark, sf_dir, second=second)
        rows.append(E.model_metrics(s, name))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


@register("model_comparison", _CMP_SPEC, _CMP_SQL)
def q_model_comparison(spark, sf_dir):
    """Per model: PR-AUC, accuracy and failure-class metrics at 0.5, best-F1 threshold, 60 %-precision threshold."""
    return model_comparison(spark, sf_dir)


@register("rank_models", "best_model:s best_pr_auc:d", f"SELECT model AS best_model, pr_auc AS best_pr_auc FROM ({_CMP_SQL}) ORDER BY pr_auc DESC LIMIT 1")
def q_rank_models(spark, sf_dir):
    """Model with the highest PR-AUC."""
    m = model_comparison(spark, sf_dir)
    return m.agg(F.max_by("model", "pr_auc").alias("best_model"), F.max("pr_auc").alias("best_pr_auc"))


@register("compare_baselines", "best_baseline:s", f"""SELECT CASE WHEN b.pr_auc > a.pr_auc THEN 'model_b' ELSE 'model_a' END AS best_baseline
FROM (SELECT * FROM ({_CMP_SQL}) WHERE model = 'model_a') a, (SELECT * FROM ({_CMP_SQL}) WHERE model = 'model_b') b""")
def q_compare_baselines(spark, sf_dir):
    """The second baseline wins only when its PR-AUC is strictly greater."""
    m = model_comparison(spark, sf_dir)
    a = m.where("model = 'model_a'").select(F.col("pr_auc").alias("a"))
    b = m.where("model = 'model_b'").select(F.col("pr_auc").alias("b"))
    return a.crossJoin(b).select(F.when(F.col("b") > F.col("a"), "model_b").otherwise("model_a").alias("best_baseline"))


# ---------------------------------------------------------------- Spark ML models

# A fitted model's scores are no SQL; what can be checked is: every validation row once with its label, a probability,
# and that walking the exported node table gives the model's own score.
_VAL_SQL = split_sql("readings") + " SELECT row_id, failure_24h AS label, true AS is_probability, true AS class_follows FROM sp WHERE split = 'val'"
_VAL_SPEC = "row_id:l label:i is_probability:b class_follows:b"
_TREE_SQL = _VAL_SQL.replace("true AS class_follows", "true AS class_follows, true AS table_agrees")


def _scaled(spark, sf_dir, split=None):
    f = reading_features(spark, sf_dir, split)
    return written(apply_scaler(f, fit_scaler(f.where("split = 'train'"), FEATURES), FEATURES), "scaled")


def _train_and_score(spark, sf_dir, model_type):
    scaled = _scaled(spark, sf_dir)
    model = M.train(scaled.where("split = 'train'"), FEATURES, model_type)
    return M.predict(model, scaled.where("split = 'val'"), FEATURES, keep=("row_id",))


def _checked(scored):
    return scored.select("row_id", "label", F.col("score").between(0, 1).alias("is_probability"),
                         (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("class_follows"))


register("train_logistic_regression", _VAL_SPEC, _VAL_SQL)(lambda spark, sf: _checked(_train_and_score(spark, sf, "logistic_regression")))


def train_trees(spark, sf_dir, model_type):
    """Class-weighted trees, scored by the model and by its exported node table."""
    scaled = _scaled(spark, sf_dir)
    model = M.train(scaled.where("split = 'train'"), FEATURES, model_type)
    val = scaled.where("split = 'val'")
    own = R.score_by_table(val, R.node_table(model, spark), FEATURES, keep=("row_id",)).select(
        "row_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin"))) if R.is_boosted(model) else F.col("margin")).alias("own"))
    scored = M.predict(model, val, FEATURES, keep=("row_id",))
    agrees = (F.abs(F.col("own") - F.col("score")) < 1e-9).alias("table_agrees")
    return scored.join(own, "row_id").select("row_id", "label", F.col("score").between(0, 1).alias("is_probability"),
                                             (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("class_follows"), agrees)


for _mt in ("random_forest", "gbt", "gbt_leaf"):
    register(f"train_{_mt}", _VAL_SPEC + " table_agrees:b", _TREE_SQL)(lambda spark, sf, _mt=_mt: train_trees(spark, sf, _mt))


@register("logistic_certificate", "feature:s stationary:b", "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*FEATURES, "(intercept)"]) + "]) AS feature, true AS stationary")
def q_logistic_certificate(spark, sf_dir):
    """Each component of the penalised gradient of the fitted logistic regression, against the largest one of the model that knows nothing."""
    train = _scaled(spark, sf_dir, "train")
    g = M.penalised_gradient(M.train(train, FEATURES, "logistic_regression"), train, FEATURES)
    most = F.max(F.abs("at_zero")).over(Window.partitionBy())  # one row a feature
    return g.select("feature", (F.abs("gradient") <= F.lit(M.STATIONARY) * most).alias("stationary"))


@register("evaluate_model", "rows:l positives:l areas_valid:b accuracy_valid:b recall_matches:b",
          split_sql("readings") + """ SELECT count(*) AS rows, sum(failure_24h) AS positives, true AS areas_valid, true AS accuracy_valid, true AS recall_matches
FROM sp WHERE split = 'val'""")
def q_evaluate_model(spark, sf_dir):
    """Full evaluation of the class-weighted logistic model on the validation split; the report's own sums are checked."""
    scored = written(_train_and_score(spark, sf_dir, "logistic_regression"), "evaluated")
    e = M.evaluate(scored)
    n, pos = (F.col(c) for c in ("n_rows", "n_pos"))
    recall = F.when(pos > 0, F.col("tp") / pos).otherwise(0.0)
    return e.select(n.alias("rows"), pos.alias("positives"), (F.col("pr_auc").between(0, 1) & F.col("average_precision").between(0, 1)).alias("areas_valid"),
                    (F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / n) < 1e-9).alias("accuracy_valid"),
                    (F.abs(F.col("failure_recall") - recall) < 1e-9).alias("recall_matches"))


# ---------------------------------------------------------------- streaming (availableNow replay)

_VOLUME = """SELECT w AS window_start, w + INTERVAL {span} AS window_end, count(*) FILTER (WHERE score >= 0.3::DOUBLE) AS alerts, count(*) AS readings
FROM (SELECT r.ts, s.score, unnest([time_bucket(INTERVAL {slide}, r.ts) - i * INTERVAL {slide} FOR i IN range({copies})]) AS w
      FROM readings r JOIN scored s USING (row_id)) GROUP BY 1, 2"""


@register("stream_alert_volume", "window_start:t window_end:t alerts:l readings:l",
          with_ctes(READINGS, SCORED) + "\n" + _VOLUME.format(span="1 DAY", slide="1 DAY", copies=1))
def q_stream_alert_volume(spark, sf_dir):
    """Daily alert volume from a streaming aggregation, the last day included (complete mode)."""
    return S.run_complete(S.stream_alert_volume(S.read_events_stream(spark, sf_dir)), "alert_volume")


@register("stream_alert_volume_sliding", "window_start:t window_end:t alerts:l readings:l",
          with_ctes(READINGS, SCORED) + "\n" + _VOLUME.format(span="6 HOUR", slide="1 HOUR", copies=6))
def q_stream_alert_volume_sliding(spark, sf_dir):
    """Alert volume of 6 h windows that slide by 1 h."""
    return S.run_complete(S.stream_alert_volume(S.read_events_stream(spark, sf_dir), window="6 hours", slide="1 hour"), "alert_volume_sliding")


@register("stream_dedupe", "entity_id:l readings:l", with_ctes(READINGS) +
          "SELECT entity_id, count(*) AS readings FROM (SELECT DISTINCT entity_id, ts FROM readings) GROUP BY entity_id")
def q_stream_dedupe(spark, sf_dir):
    """Readings per entity after streaming de-duplication; every third reading is sent twice."""
    events = S.read_events_stream(spark, sf_dir)
    twice = events.unionByName(events.where(F.pmod("event_id", F.lit(3)) == 0))
    d = S.run_available_now(S.stream_dedupe(twice), "dedupe")
    return d.groupBy("entity_id").agg(F.count(F.lit(1)).alias("readings"))


# ---------------------------------------------------------------- sources and sinks (round trips)


def _scratch(spark, name):
    return scratch_path(spark, f"io-{name}")


@register("read_readings_csv", "row_id:l entity_id:l ts:t temperature:d vibration:d pressure:d failure:i",
          with_ctes(READINGS) + "SELECT * FROM readings")
def q_read_readings_csv(spark, sf_dir):
    """Readings written as CSV with header and read back with the fixed schema."""
    p = _scratch(spark, "readings_csv")
    IO.write_readings_csv(fx.readings(spark, sf_dir), p)
    schema = "row_id long, entity_id long, temperature double, vibration double, pressure double, failure int, timestamp string"
    return IO.read_readings(spark, p, schema=schema)


@register("write_splits", "split:s rows:l", split_sql("readings") + " SELECT split, count(*) AS rows FROM sp GROUP BY split")
def q_write_splits(spark, sf_dir):
    """Labelled split written partitioned by split and read back."""
    p = _scratch(spark, "splits")
    IO.write_splits(labelled_split(spark, sf_dir, "readings"), p)
    return spark.read.parquet(p).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@register("save_load_scaler", "feature:s mean:v scale:v", _FEAT + ",\n" + _stats_sql() + "\nSELECT * FROM stats")
def q_save_load_scaler(spark, sf_dir):
    """Scaler statistics saved to parquet and loaded back."""
    p = _scratch(spark, "scaler")
    save_scaler(fit_scaler(reading_features(spark, sf_dir, "train"), FEATURES), p)
    return load_scaler(spark, p)


_REPORT_COUNTS = "\nUNION ALL ".join(f"SELECT '{n}' AS report, count(*) AS rows FROM ({q})" for n, q in (
    ("threshold_table", ORACLES["threshold_table"]), ("rare_event_metrics", ORACLES["rare_event_metrics"]), ("model_comparison", _CMP_SQL)))


@register("write_reports", "report:s rows:l", _REPORT_COUNTS)
def q_write_reports(spark, sf_dir):
    """Report tables (threshold table, rare-event metrics, model comparison) written as CSV and re-read."""
    s = fx.scored(spark, sf_dir)
    p = _scratch(spark, "reports")
    reps = {"threshold_table": T.threshold_table(s), "rare_event_metrics": E.rare_event_metrics(s),
            "model_comparison": model_comparison(spark, sf_dir)}
    IO.write_reports(reps, p)
    out = None
    for name in reps:
        d = spark.read.option("header", True).csv(f"{p}/{name}").agg(F.count(F.lit(1)).alias("rows")) \
            .select(F.lit(name).alias("report"), "rows")
        out = d if out is None else out.unionByName(d)
    return out


@register("save_load_model", _VAL_SPEC + " same:b", _VAL_SQL.replace("true AS class_follows", "true AS class_follows, true AS same"))
def q_save_load_model(spark, sf_dir):
    """Class-weighted logistic model saved with its metadata and loaded: it scores validation rows as the fitted one does."""
    f = reading_features(spark, sf_dir)
    model = M.train(f.where("split = 'train'"), FEATURES, "logistic_regression")
    p = _scratch(spark, "model")
    M.save_model(model, p, FEATURES, "logistic_regression", spark)
    loaded, feats, _ = M.load_model(p, spark)
    val = f.where("split = 'val'")
    own = M.predict(model, val, FEATURES, keep=("row_id",)).select("row_id", F.col("score").alias("own"))
    return M.predict(loaded, val, feats, keep=("row_id",)).join(own, "row_id").select(
        "row_id", "label", F.col("score").between(0, 1).alias("is_probability"), (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("class_follows"),
        (F.col("own") == F.col("score")).alias("same"))


@register("contributions_logistic", "row_id:l features:l adds_up:b", split_sql("readings") + f" SELECT row_id, {len(FEATURES)} AS features, true AS adds_up FROM sp WHERE split = 'val'")
def q_contributions_logistic(spark, sf_dir):
    """Contributions of the trained logistic model for every validation row: with the base value they add up to its margin."""
    scaled = _scaled(spark, sf_dir)
    train, val = scaled.where("split = 'train'"), scaled.where("split = 'val'")
    model = M.train(train, FEATURES, "logistic_regression", params={"maxIter": 30})
    weights = written(weights_from_model(spark, model, FEATURES, fit_scaler(train, FEATURES)), "weights")
    base = float(model.intercept) + (weights.agg(F.sum(F.col("weight") * F.col("mean"))).first()[0] or 0.0)
    sums = contribution_sums(val, weights, FEATURES)
    scored = M.predict(model, val, FEATURES, keep=("row_id",))
    own = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("total") + F.lit(base))))
    return sums.join(scored, "row_id").select("row_id", "features", (F.abs(own - F.col("score")) < 1e-9).alias("adds_up"))


@register("feature_importance", "features:l shares:b agrees:b train_rows:l", split_sql("readings") +
          f" SELECT {len(FEATURES)} AS features, true AS shares, true AS agrees, count(*) AS train_rows FROM sp WHERE split = 'train'")
def q_feature_importance(spark, sf_dir):
    """Random-forest feature importances: one per feature, summing to 1 (0 if no tree could split), and equal to the gains in the node table."""
    train = reading_features(spark, sf_dir, "train")
    model = M.train(train, FEATURES, "random_forest")
    own = R.importance_by_table(R.node_table(model, spark), FEATURES).withColumnRenamed("importance", "own")
    found = M.feature_importance(model, FEATURES, spark).join(own, "feature", "left")
    total = F.sum("importance")
    return found.agg(F.count_distinct("feature").alias("features"), (F.least(F.abs(total - 1), F.abs(total)) < 1e-9).alias("shares"),
                     F.bool_and(F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0))) < 1e-9).alias("agrees")).crossJoin(train.agg(F.count(F.lit(1)).alias("train_rows")))


@register("tree_contributions", "row_id:l features:l adds_up:b", split_sql("readings") + f" SELECT row_id, {len(FEATURES)} AS features, true AS adds_up FROM sp WHERE split = 'val'")
def q_tree_contributions(spark, sf_dir):
    """Exact Shapley contributions of a forest for every validation row: with the base value they add up to its probability."""
    f = reading_features(spark, sf_dir)
    model = M.train(f.where("split = 'train'"), FEATURES, "random_forest", params={"numTrees": 20, "maxDepth": 5})
    val = f.where("split = 'val'")
    contrib, base = R.tree_contributions(val, R.node_table(model, spark), FEATURES)
    sums = contrib.groupBy("row_id").agg(F.count_distinct("feature").alias("features"), F.sum("contribution").alias("total"))
    scored = M.predict(model, val, FEATURES, keep=("row_id",))
    return sums.join(scored, "row_id").select("row_id", "features", (F.abs(F.col("total") + F.lit(base) - F.col("score")) < 1e-9).alias("adds_up"))


# ---------------------------------------------------------------- report unions


_OPT_SQL = "\nUNION ALL\n".join(
    [f"SELECT * FROM ({_metric_sql('recall', r)})" for r in T.RECALL_TARGETS] +
    [f"SELECT * FROM ({_metric_sql('budget', b)})" for b in T.ALERT_BUDGETS])


@register("optimize_thresholds", "strategy:s target:d threshold:d precision:d recall:d f1:d tp:l fp:l fn:l tn:l "
          "alert_rate:d alerts_per_day_scaled:d specificity:d fallback:b", _OPT_SQL)
def q_optimize_thresholds(spark, sf_dir):
    """Recall targets 70/80/90 % and alert budgets 1/5/10 per day in one table."""
    return T.optimize_thresholds(fx.scored(spark, sf_dir))


@register("evaluation_basic_metrics", "pr_auc:d roc_auc:d avg_precision:d avg_recall:d",
          "SELECT a.pr_auc, b.roc_auc, c.avg_precision, c.avg_recall FROM (" + ORACLES["pr_auc"]
          + ") a, (" + ORACLES["roc_auc"] + ") b, ("
          + ORACLES["curve_means"] + ") c")
def q_eval_basic(spark, sf_dir):
    """Basic block of the evaluation report: PR-AUC, ROC-AUC, mean precision and recall of the curve."""
    from raretide.operators.curves import roc_auc
    s = fx.scored(spark, sf_dir)
    return pr_areas(s).select("pr_auc", "avg_precision", "avg_recall").crossJoin(roc_auc(s))


# ---------------------------------------------------------------- remaining inventory keys


@register("cast_timestamp", "row_id:l ts:t hour:t", with_ctes(READINGS) + """
SELECT row_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS TIMESTAMP) AS ts, date_trunc('hour', ts) AS hour FROM readings""")
def q_cast_timestamp(spark, sf_dir):
    """Timestamp text -> TIMESTAMP_NTZ (time-zone independent), and its hour."""
    from raretide.functions.timecols import trunc_hour
    r = fx.readings(spark, sf_dir).select("row_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))
    return r.select("row_id", F.col("t").cast("timestamp_ntz").alias("ts"), trunc_hour(F.col("t").cast("timestamp_ntz")).alias("hour"))


@register("drop_unlabelled", "entity_id:l rows:l positives:l", with_ctes(READINGS) + """
SELECT entity_id, count(*) AS rows, sum(failure_24h) AS positives FROM (
  SELECT entity_id, lead(failure, 24) OVER (PARTITION BY entity_id ORDER BY ts, row_id) AS failure_24h FROM readings)
WHERE failure_24h IS NOT NULL GROUP BY entity_id""")
def q_drop_unlabelled(spark, sf_dir):
    """Rows keeping a label 24 rows ahead, per entity."""
    d = drop_unlabelled(label_lead(fx.readings(spark, sf_dir), ["entity_id"]))
    return d.groupBy("entity_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("failure_24h").alias("positives"))


@register("select_features", "feature:s rows:l total:v", _FEAT + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS rows, avg({c}) AS total FROM feat" for c in sorted(FEATURES)))
def q_select_features(spark, sf_dir):
    """Model column contract, every feature-table column except keys, time and labels: rows and mean of each."""
    f = select_features(reading_features(spark, sf_dir), keep=()).drop("split", "row_id", "entity_id")
    found = per_feature(f, f.columns, [F.count("value").alias("rows"), F.avg("value").alias("total")])
    return found.select("feature", F.coalesce("rows", F.lit(0)).alias("rows"), "total")


_ALIGN = ["temperature", "vibration", "pressure_missing", "pressure"]


@register("align_schema", "row_id:l temperature:d vibration:d pressure_missing:d pressure:d", with_ctes(READINGS) +
          "SELECT row_id, temperature, vibration, 0.0 AS pressure_missing, pressure FROM readings")
def q_align_schema(spark, sf_dir):
    """Reindex to a column contract: order as the contract, missing columns as 0, extra columns dropped."""
    return align_schema(fx.readings(spark, sf_dir), _ALIGN, keep=["row_id"])


@register("forward_fill_hourly_gaps", "ts:t temperature:d vibration:d pressure:d", with_ctes(READINGS, HOURLY_GAPS) + """
SELECT ts, last_value(temperature IGNORE NULLS) OVER w AS temperature, last_value(vibration IGNORE NULLS) OVER w AS vibration,
       last_value(pressure IGNORE NULLS) OVER w AS pressure
FROM hourly_gaps WINDOW w AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_forward_fill(spark, sf_dir):
    """Last non-null value of each sensor over the single hourly series with null runs."""
    d = with_order(fx.hourly_gaps(spark, sf_dir), [], tiebreak=None)
    return carry_last(d, [], "rn", SENSORS, block_rows=64, total="_n").select("ts", *SENSORS)


_CONTRIB_SQL = _FEAT + ",\n" + _stats_sql() + ",\n" + _STATS_WIDE + ",\n" + _weights_sql() + ",\n" + _LONG + """
SELECT row_id, feature, value, weight * (value - mean) AS contribution FROM long JOIN wts USING (feature)"""


@register("contributions", "row_id:l feature:s value:v contribution:v", _CONTRIB_SQL)
def q_contributions(spark, sf_dir):
    """Per validation row and feature: additive contribution w * (x - mean) of the linear separation scorer."""
    f = reading_features(spark, sf_dir)
    stats = fit_scaler(f.where("split = 'train'"), FEATURES)
    w = separation_weights(f.where("split = 'train'"), stats, FEATURES)
    c = contributions(f.where("split = 'val'"), w, FEATURES, id_col="row_id")
    return c


@register("stream_validate", _REQ_SPEC_STREAM := "row_id:l ts:t temperature:d vibration:d pressure:d error:s valid:b",
          f"SELECT *, error IS NULL AS valid FROM ({_REQ_SQL})")
def q_stream_validate(spark, sf_dir):
    """Request validation on the event stream; rejected rows keep their error (file sink)."""
    return S.run_available_now(S.stream_validate(S.read_events_stream(spark, sf_dir)), "validate")


_EXPLAIN_SQL = _CONTRIB_SQL.replace("\nSELECT row_id, feature, value, weight", ",\ncon AS (SELECT row_id, feature, value, weight", 1) + f"""),
one AS (SELECT row_id FROM feat WHERE split = 'val' AND failure_24h = 1 ORDER BY {_SAMPLE_KEY}, row_id LIMIT 1)
SELECT 'global' AS kind, feature AS name, avg(abs(contribution)) AS value FROM con GROUP BY feature
UNION ALL SELECT 'failure_row' AS kind, feature AS name, contribution AS value FROM con JOIN one USING (row_id)"""


@register("explain_failures", "kind:s name:s value:v", _EXPLAIN_SQL)
def q_explain_failures(spark, sf_dir):
    """Global importance of every feature and the contributions of one positive validation row."""
    f = reading_features(spark, sf_dir)
    stats = fit_scaler(f.where("split = 'train'"), FEATURES)
    w = written(separation_weights(f.where("split = 'train'"), stats, FEATURES), "weights")  # both parts read it
    val = f.where("split = 'val'")
    every = mean_abs_contribution(contributions(val, w, FEATURES))
    one = contributions(pick_failure_row(val, "failure_24h"), w, FEATURES)
    return (every.select(F.lit("global").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value"))
            .unionByName(one.select(F.lit("failure_row").alias("kind"), F.col("feature").alias("name"), F.col("contribution").alias("value"))))


# ---------------------------------------------------------------- request forms, budgets of a larger data set, null keys

_THREE_SQL = f"SELECT row_id, temperature, vibration, pressure, CASE WHEN error LIKE '%: timestamp' THEN NULL ELSE error END AS error FROM ({_REQ_SQL})"


@register("parse_requests_without_time", "row_id:l temperature:d vibration:d pressure:d error:s stamped:b", f"SELECT *, true AS stamped FROM ({_THREE_SQL})")
def q_parse_requests_without_time(spark, sf_dir):
    """The three-field request form: stamped with the arrival time."""
    from raretide.sources.requests import REQUIRED_WITHOUT_TIME, parse_requests
    p = parse_requests(fx.requests(spark, sf_dir), required=REQUIRED_WITHOUT_TIME)
    return p.withColumn("stamped", F.col("ts").isNotNull())


@register("parse_requests_batch", "n:l row_id:l temperature:d error:s", f"""SELECT row_id // 4 AS n, row_id, temperature, error FROM ({_REQ_SQL})""")
def q_parse_requests_batch(spark, sf_dir):
    """Array bodies, four requests each: one row per request, in order."""
    from raretide.sources.requests import parse_requests
    r = fx.requests(spark, sf_dir).withColumn("n", F.floor(F.col("row_id") / 4).cast("long"))
    bodies = r.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("row_id", "request"))).alias("a"))
    bodies = bodies.select("n", F.col("a.row_id").alias("ids"), F.concat(F.lit("["), F.array_join(F.col("a.request"), ","), F.lit("]")).alias("request"))
    from raretide.sources.requests import request_objects
    items = request_objects(bodies).select("n", F.get("ids", F.col("_item")).alias("row_id"), F.to_json("_j").alias("request"))
    return parse_requests(items)


@register("threshold_for_alert_budget_of_total", "strategy:s target:d threshold:d precision:d recall:d f1:d tp:l fp:l fn:l tn:l "
          "alert_rate:d alerts_per_day_scaled:d specificity:d fallback:b", _metric_sql("budget", 5, 40_000))
def q_budget_total(spark, sf_dir):
    """Alert budget where the scored rows stand for a data set of 40,000 rows."""
    return T.for_alert_budget(fx.scored(spark, sf_dir), 5, total_samples=40_000)


@register("label_lead_null_keys", "row_id:l entity_id:l failure_24h:i", with_ctes(READINGS) + """
SELECT row_id, e AS entity_id, lead(failure, 24) OVER (PARTITION BY e ORDER BY ts, row_id) AS failure_24h
FROM (SELECT *, CASE WHEN entity_id % 5 <> 0 THEN entity_id END AS e FROM readings)""")
def q_label_lead_null_keys(spark, sf_dir):
    """Label lead where a fifth of the rows has no entity: they are one series."""
    r = fx.readings(spark, sf_dir).withColumn("entity_id", F.when(F.col("entity_id") % 5 != 0, F.col("entity_id")))
    return label_lead(r, ["entity_id"]).select("row_id", "entity_id", "failure_24h")
