"""Registered queries of the training jobs: cross-validation, search, baselines, production model, the evaluation bundle and the resumable pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from raretide.operators import artifact as A
from raretide.operators import evaluate as E
from raretide.operators import models as M
from raretide.operators.split import time_series_folds
from raretide.operators.tuning import cross_validate
from raretide.plans import pipeline as P
from raretide.plans.q_series import FEATURES, SENSORS, labelled_split, split_sql
from raretide.plans.registry import ORACLES, register
from raretide.session import scratch_path, written
from raretide.sources import fixtures as fx

EMBARGO = 24  # the label looks 24 rows ahead
# Small models, so that the jobs' queries stay quick; the pipeline's own defaults are the reference's.
SMALL = {"logistic_regression": {"maxIter": 20}, "random_forest": {"numTrees": 5, "maxDepth": 4}, "gbt": {"maxIter": 3, "maxDepth": 3}}
SMALL_SPACE = {"stepSize": ("log", 0.05, 0.3), "maxDepth": ("int", 2, 3), "maxIter": ("int", 2, 3), "positiveWeight": ("log", 0.1, 10.0)}


def _cv_sql() -> str:
    """Average precision of the closed-form scorer on the raw sensors, fold by fold."""
    out = split_sql("readings") + """,
tr AS (SELECT *, row_number() OVER (ORDER BY ts, row_id) AS p, count(*) OVER () AS n FROM sp WHERE split = 'train'),
f AS (SELECT *, n // 4 AS size, n - 3 * (n // 4) AS first_test FROM tr),
cv AS (SELECT fold, *, p > first_test + (fold - 1) * size AND p <= first_test + fold * size AS test, p <= first_test + (fold - 1) * size - """ + str(EMBARGO) + """ AS train
       FROM f, range(1, 4) t(fold)),
st AS (SELECT fold, count(*) AS train_rows, """ + ", ".join(
        f"avg({s}) AS m_{s}, CASE WHEN stddev_pop({s}) = 0 THEN 1.0 ELSE stddev_pop({s}) END AS s_{s}, "
        f"coalesce(avg({s}) FILTER (WHERE failure_24h = 1) - avg({s}) FILTER (WHERE failure_24h = 0), 0.0) AS d_{s}" for s in SENSORS) + """
       FROM cv WHERE train GROUP BY fold),
sc AS (SELECT fold, failure_24h AS label, 1 / (1 + exp(-(""" + " + ".join(f"d_{s} / s_{s} / {len(SENSORS)} * (({s} - m_{s}) / s_{s})" for s in SENSORS) + """))) AS score
       FROM cv JOIN st USING (fold) WHERE test),
by_score AS (SELECT fold, score, sum(label) AS tp, count(*) AS n FROM sc GROUP BY 1, 2),
cum AS (SELECT fold, tp, sum(tp) OVER w AS t, sum(n) OVER w AS k, sum(tp) OVER (PARTITION BY fold) AS pos, sum(n) OVER (PARTITION BY fold) AS test_rows
        FROM by_score WINDOW w AS (PARTITION BY fold ORDER BY score DESC))
SELECT fold, any_value(train_rows) AS train_rows, any_value(test_rows) AS test_rows, coalesce(sum(tp::DOUBLE / nullif(pos, 0) * t / k), 0.0) AS average_precision
FROM cum JOIN st USING (fold) GROUP BY fold"""
    return out


@register("time_series_cv", "fold:i train_rows:l test_rows:l average_precision:d", _cv_sql())
def q_time_series_cv(spark, sf_dir):
    """Three expanding folds in parallel with an embargo of the label's horizon: row counts and average precision of the closed-form scorer."""
    train = labelled_split(spark, sf_dir, "readings").where("split = 'train'")
    folded = written(time_series_folds(train, embargo_rows=EMBARGO), "cv")

    def fit_and_score(a, b):
        return A.score(A.fit_linear_artifact(a, SENSORS), b).select(F.col("failure_24h").cast("int").alias("label"), "score")

    found = cross_validate(folded, fit_and_score, 3, parallelism=3)
    return spark.createDataFrame(found, "fold int, train_rows long, test_rows long, average_precision double")


@register("tune", "trial:i in_space:b scored:b best_typed:b", "SELECT unnest(range(3)) AS trial, true AS in_space, true AS scored, true AS best_typed")
def q_tune(spark, sf_dir):
    """A search of three trials, two at once, over a small space, each trial three fits on expanding folds."""
    train = labelled_split(spark, sf_dir, "readings").where("split = 'train'")
    trials = written(M.tune(train, SENSORS, 3, space=SMALL_SPACE, at_once=2, embargo_rows=EMBARGO), "trials")
    best = M.best_params(trials)
    typed = isinstance(best["maxDepth"], int) and isinstance(best["stepSize"], float)
    inside = F.lit(True)
    for name, (_, low, high) in SMALL_SPACE.items():
        if name != "positiveWeight":  # times the ratio of the classes
            inside = inside & F.col("params")[name].cast("double").between(low, high)
    return trials.select("trial", inside.alias("in_space"), F.col("mean_average_precision").between(0, 1).alias("scored"), F.lit(typed).alias("best_typed"))


_PARTS = {"basic_metrics": "evaluation_basic_metrics", "classification_report": None, "threshold_table": "threshold_table", "precision_threshold": None,
          "threshold_optimization": "optimize_thresholds", "rare_event_metrics": "rare_event_metrics", "daily_alert_simulation": "daily_alert_simulation"}
_REPORT_SQL = "\nUNION ALL\n".join(f"SELECT '{k}' AS report, " + (f"count(*) AS rows FROM ({ORACLES[v]})" if v else ("3 AS rows" if k == "classification_report" else "1 AS rows"))
                                   for k, v in _PARTS.items())


@register("evaluation_report", "report:s rows:l", _REPORT_SQL)
def q_evaluation_report(spark, sf_dir):
    """The evaluation bundle of one scored table: its reports and their sizes."""
    out = None
    for name, df in E.evaluation_report(written(fx.scored(spark, sf_dir), "scored")).items():
        part = df.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def _val_counts(tables: str) -> str:
    return split_sql("readings") + f" SELECT name AS model, count(*) AS rows, sum(failure_24h) AS positives, true AS areas_valid FROM sp, (VALUES {tables}) t(name) WHERE split = 'val' GROUP BY name"


@register("run_baselines", "model:s rows:l positives:l areas_valid:b", _val_counts("('logistic_regression'), ('random_forest')"))
def q_run_baselines(spark, sf_dir):
    """Both baselines trained on the readings' features and evaluated on the validation split."""
    run = P.Manifest(spark, scratch_path(spark, "baselines"))
    features = run.table("features", lambda: P.labelled_features(fx.readings(spark, sf_dir)))
    _, _, table = P.run_baselines(features, run, FEATURES, params=SMALL)
    return table.select("model", F.col("n_rows").alias("rows"), F.col("n_pos").alias("positives"), F.col("pr_auc").between(0, 1).alias("areas_valid"))


@register("run_production", "model:s rows:l positives:l areas_valid:b", _val_counts("('gbt')"))
def q_run_production(spark, sf_dir):
    """The production model after a search of two trials, on the validation split."""
    run = P.Manifest(spark, scratch_path(spark, "production"))
    features = run.table("features", lambda: P.labelled_features(fx.readings(spark, sf_dir)))
    scored, _ = P.run_production(features, run, FEATURES, n_trials=2, params=SMALL["gbt"], space=SMALL_SPACE)
    return M.evaluate(scored).select(F.lit("gbt").alias("model"), F.col("n_rows").alias("rows"), F.col("n_pos").alias("positives"), F.col("pr_auc").between(0, 1).alias("areas_valid"))


@register("run_pipeline", "step:s rows:l", split_sql("readings") + """,
v AS (SELECT count(*) AS n, count(*) FILTER (WHERE split = 'val') AS k FROM sp)
SELECT step, CASE step WHEN 'features' THEN n WHEN 'baselines' THEN 2 WHEN 'scored_logistic_regression' THEN k WHEN 'scored_random_forest' THEN k WHEN 'scored_gbt' THEN k END AS rows
FROM v, (VALUES ('features'), ('model_logistic_regression'), ('scored_logistic_regression'), ('model_random_forest'), ('scored_random_forest'), ('baselines'), ('model_gbt'), ('scored_gbt'), ('reports')) t(step)""")
def q_run_pipeline(spark, sf_dir):
    """The whole pipeline with small models, then once more: the second run finds every step finished."""
    out, readings = scratch_path(spark, "pipeline"), fx.readings(spark, sf_dir)
    P.run_pipeline(readings, out, params=SMALL)
    _, again = P.run_pipeline(readings, out, params=SMALL)
    return again.steps().where(F.lit(not again.ran)).select("step", "rows")
