"""Composite batch jobs: the end-to-end pipeline as one Spark application that can be resumed.

Steps: readings -> 24-row label -> chronological split -> features per (entity, split) -> class-weighted baselines (LR, RF) and production
model (boosted trees), each one artifact from features to score -> validation scores -> threshold optimisation and evaluation -> model comparison -> report
tables under ``out_dir``.

Every step's result is a table (or an artifact) in ``out_dir`` on shared storage, and a manifest entry is written behind it.  A rerun reads what has an entry
with the same fingerprint and goes on from there; the fingerprint covers the step's parameters and all steps before it, so a changed parameter
redoes just what depends on it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from raretide.operators import artifact as A
from raretide.operators import evaluate as E
from raretide.operators import models as M
from raretide.operators.features import SENSORS, build_features, feature_names
from raretide.operators.scale import apply_scaler, fit_scaler
from raretide.operators.split import chrono_split
from raretide.operators.windows import drop_unlabelled, label_lead
from raretide.session import written
from raretide.sources.io import write_reports

BASELINES = ("logistic_regression", "random_forest")


class Manifest:
    """Finished steps of one run under ``folder``, with the fingerprint of what they were made from."""

    def __init__(self, spark: SparkSession, folder: str, version: str = ""):
        self.spark, self.folder, self.print, self.ran = spark, folder.rstrip("/"), hashlib.sha256(version.encode()).hexdigest(), []

    def _known(self, name: str, fingerprint: str) -> Row | None:
        """The entry of a step that was finished with this fingerprint."""
        try:
            entry = self.spark.read.parquet(f"{self.folder}/manifest/{name}").first()
        except AnalysisException:
            return None
        return entry if entry and entry["fingerprint"] == fingerprint else None

    def _finish(self, name: str, fingerprint: str, rows: int | None = None, detail: str | None = None) -> None:
        told = (("step", name, "string"), ("fingerprint", fingerprint, "string"), ("rows", rows, "long"), ("detail", detail, "string"))
        entry = self.spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, v, t in told])
        entry.write.mode("overwrite").parquet(f"{self.folder}/manifest/{name}")
        self.ran.append(name)

    def _next(self, name: str, told: dict) -> str:
        self.print = hashlib.sha256(json.dumps([self.print, name, told], sort_keys=True, default=str).encode()).hexdigest()
        return self.print

    def table(self, name: str, make: Callable[[], DataFrame], **told) -> DataFrame:
        """The table of a step: read if it is finished, else made, written and entered."""
        path, fingerprint = f"{self.folder}/{name}", self._next(name, told)
        if not self._known(name, fingerprint):
            make().write.mode("overwrite").parquet(path)
            self._finish(name, fingerprint, self.spark.read.parquet(path).count())
        return self.spark.read.parquet(path)

    def artifact(self, name: str, make: Callable[[], PipelineModel], **told) -> PipelineModel:
        path, fingerprint = f"{self.folder}/models/{name}", self._next(name, told)
        if not self._known(f"model_{name}", fingerprint):
            A.save_artifact(make(), path)
            self._finish(f"model_{name}", fingerprint)
        return A.load_artifact(path)

    def reports(self, name: str, make: Callable[[], dict[str, DataFrame]], **told) -> dict[str, DataFrame]:
        """Report tables as CSV folders; a finished step's reports are read back."""
        path, fingerprint = f"{self.folder}/reports", self._next(name, told)
        if entry := self._known(name, fingerprint):
            schemas = {k: T.StructType.fromJson(v) for k, v in json.loads(entry["detail"]).items()}
        else:
            reports = make()
            write_reports(reports, path)
            schemas = {k: df.schema for k, df in reports.items()}
            self._finish(name, fingerprint, detail=json.dumps({k: v.jsonValue() for k, v in schemas.items()}))
        return {k: self.spark.read.schema(v).option("header", True).csv(f"{path}/{k}") for k, v in schemas.items()}

    def steps(self) -> DataFrame:
        """step, fingerprint, rows, detail of the finished steps."""
        return self.spark.read.parquet(f"{self.folder}/manifest/*")


def labelled_features(readings: DataFrame, keys: Sequence[str] = ("entity_id",), sensors: Sequence[str] = SENSORS, tiebreak: str | None = "row_id") -> DataFrame:
    """Label, split, features per (keys, split)."""
    split = chrono_split(drop_unlabelled(label_lead(readings, list(keys), tiebreak=tiebreak)), tiebreak=tiebreak)
    return build_features(split, list(keys), sensors, split_col="split", tiebreak=tiebreak)


def feature_pipeline(readings: DataFrame, keys=("entity_id",), sensors=SENSORS, tiebreak: str | None = "row_id"):
    """Label, split, features per (keys, split), scaler fitted on train; returns (scaled, stats)."""
    feats = feature_names(sensors)
    f = written(labelled_features(readings, keys, sensors, tiebreak), "features")  # read by the scaler fit and by every model
    stats = fit_scaler(f.where("split = 'train'"), feats)
    return apply_scaler(f, stats, feats), stats


def scored_by(artifact: PipelineModel, rows: DataFrame, label: str = "failure_24h", keep: Sequence[str] = ("row_id", "ts")) -> DataFrame:
    """(keep..., label, score, prediction) of feature rows."""
    scored = A.score(artifact, rows)
    return scored.select(*[c for c in keep if c in rows.columns], F.col(label).cast("int").alias("label"), "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


def _model(features: DataFrame, run: Manifest, names: Sequence[str], model_type: str, label: str, params: dict) -> DataFrame:
    artifact = run.artifact(model_type, lambda: A.fit_artifact(features.where("split = 'train'"), names, model_type, label, params), features=list(names), label=label, params=params)
    return run.table(f"scored_{model_type}", lambda: scored_by(artifact, features.where("split = 'val'"), label))


def run_baselines(features: DataFrame, run: Manifest, names: Sequence[str], label: str = "failure_24h", params: dict | None = None):
    """Train both baselines, score the validation rows; returns (best name, scored tables, evaluation rows).

    The forest wins only if its PR-AUC is strictly greater."""
    scored = {name: _model(features, run, names, name, label, (params or {}).get(name, {})) for name in BASELINES}

    def evaluated() -> DataFrame:
        rows = [M.evaluate(scored[name]).select(F.lit(name).alias("model"), "*") for name in BASELINES]
        return rows[0].unionByName(rows[1])

    table = run.table("baselines", evaluated)
    area = {r["model"]: r["pr_auc"] or 0.0 for r in table.select("model", "pr_auc").collect()}  # two rows
    best = "random_forest" if area["random_forest"] > area["logistic_regression"] else "logistic_regression"
    return best, scored, table


def run_production(features: DataFrame, run: Manifest, names: Sequence[str], model_type: str = "gbt", n_trials: int = 0, label: str = "failure_24h",
                   params: dict | None = None, space: dict | None = None):
    """Train the production model (tuned with ``n_trials`` > 0) and score the validation rows: (scored, parameters)."""
    params = dict(params or {})
    if n_trials:
        train = features.where("split = 'train'")
        trials = run.table("trials", lambda: M.tune(train, names, n_trials, label, model_type=model_type, space=space), n_trials=n_trials, model_type=model_type, space=space)
        params |= M.best_params(trials)
    return _model(features, run, names, model_type, label, params), params


def run_pipeline(readings: DataFrame, out_dir: str, production_model: str = "gbt", keys=("entity_id",), tiebreak: str | None = "row_id", n_trials: int = 0,
                 total_samples: int | None = None, params: dict[str, dict] | None = None, space: dict | None = None, version: str = "") -> tuple[dict[str, DataFrame], Manifest]:
    """The full pipeline; returns the report tables (also CSV under ``out_dir``/reports) and the manifest.

    ``params`` has fixed parameters by model type, ``version`` names the readings: another version is another run."""
    names, params = feature_names(SENSORS), params or {}
    run = Manifest(readings.sparkSession, out_dir, version)
    features = run.table("features", lambda: labelled_features(readings, keys, SENSORS, tiebreak), keys=list(keys), tiebreak=tiebreak)
    best, scored, evaluated = run_baselines(features, run, names, params=params)
    prod, _ = run_production(features, run, names, production_model, n_trials, params=params.get(production_model), space=space)

    def reports() -> dict[str, DataFrame]:
        rows = E.model_metrics(scored[best], best, total_samples).unionByName(E.model_metrics(prod, production_model, total_samples))
        return {"model_comparison": rows.orderBy(F.col("pr_auc").desc()), "baselines": evaluated, **E.evaluation_report(prod, total_samples)}

    return run.reports("reports", reports, total_samples=total_samples, best=best), run
