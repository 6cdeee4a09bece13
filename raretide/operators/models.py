"""Class-weighted Spark ML classifiers with the reference's configurations, prediction and evaluation.

Training runs as Spark ML jobs on the assembled feature vector (treeAggregate per iteration); the
balanced class weights come from ``weights.with_weights``.  Evaluation composes the SQL-checked
operators on the scored table (label, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from raretide.functions.scalar import literal_table
from raretide.operators.scale import per_feature
from raretide.operators.tuning import SEARCH_SPACES, Space, cross_validate, in_threads, search
from raretide.operators.weights import scale_pos_weight, with_weights

SEED = 42
# Share of the largest gradient at zero below which a component counts as 0: the solver stops on relative changes of the loss.
STATIONARY = 0.01
MODEL_TYPES = ("logistic_regression", "random_forest", "gbt", "gbt_leaf")

# Fixed values of the reference's model configurations.
LR_PARAMS = {"maxIter": 1000, "C": 1.0, "tol": 1e-4}
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5}
GBT_PARAMS = {"stepSize": 0.1, "maxDepth": 6, "maxIter": 100, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
GBT_LEAF_PARAMS = {"stepSize": 0.1, "maxDepth": 6, "maxIter": 100, "subsamplingRate": 0.8,
                   "featureSubsetStrategy": "0.8", "minInstancesPerNode": 20}


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def make_estimator(model_type: str, params: dict | None = None, n_rows: int | None = None, seed: int = SEED):
    """Estimator for ``model_type``; unknown types raise ValueError before any job runs."""
    p = dict(params or {})
    if model_type == "logistic_regression":
        c = p.pop("C", LR_PARAMS["C"])
        reg = 1.0 / (c * n_rows) if n_rows else 0.0   # liblinear C with sum of balanced weights = n
        return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                  maxIter=p.get("maxIter", LR_PARAMS["maxIter"]), tol=p.get("tol", LR_PARAMS["tol"]),
                                  regParam=reg, elasticNetParam=0.0, standardization=False)
    if model_type == "random_forest":
        q = {**RF_PARAMS, **p}
        return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                      featureSubsetStrategy="sqrt", seed=seed, **q)
    if model_type in ("gbt", "gbt_leaf"):
        q = {**(GBT_PARAMS if model_type == "gbt" else GBT_LEAF_PARAMS), **p}
        return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=seed, **q)
    raise ValueError(f"Unknown model_type: {model_type}")


def train(df: DataFrame, features: Sequence[str], model_type: str = "gbt", label: str = "failure_24h",
          params: dict | None = None, seed: int = SEED):
    """Fit a class-weighted classifier; returns the fitted model."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"Unknown model_type: {model_type}")
    params = dict(params or {})
    positive = params.pop("positiveWeight", None)
    d = with_weights(df, label).withColumn("label", F.col(label).cast("double"))
    if positive is not None:  # in place of the balanced weights
        d = d.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(positive))).otherwise(F.lit(1.0)))
    d = assemble(d, features)
    n = d.count() if model_type == "logistic_regression" else None
    return make_estimator(model_type, params, n, seed).fit(d)


def predict(model, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("row_id", "ts"),
            label: str = "failure_24h") -> DataFrame:
    """Scored table (keep..., label, score = probability of class 1, prediction = class at 0.5)."""
    out = model.transform(assemble(df, features))
    keep = [c for c in keep if c in df.columns]
    return out.select(*keep, F.col(label).cast("int").alias("label"),
                      # a model trained on one class has a 1-element probability: positive probability 0
                      F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0)).alias("score"),
                      F.col("prediction").cast("int").alias("prediction"))


def evaluate(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: areas, accuracy, weighted and failure-class precision / recall / F1 and the confusion counts of a
    scored table."""
    from raretide.operators import evaluate as E
    from raretide.operators.curves import pr_areas, totals
    report = E.classification_report(scored, threshold)
    parts = {name: report.where(F.col("class") == cls).select(*[F.col(c).alias(f"{name}_{c}") for c in ("precision", "recall", "f1")])
             for name, cls in (("failure", "1"), ("weighted", "weighted avg"))}
    # every part is a one-row aggregate
    return (pr_areas(scored).select("pr_auc", "average_precision").crossJoin(E.accuracy(scored, threshold)).crossJoin(parts["weighted"])
            .crossJoin(parts["failure"]).crossJoin(E.confusion(scored, threshold)).crossJoin(totals(scored)))


def time_series_cv(df: DataFrame, features: Sequence[str], model_type: str = "gbt", label: str = "failure_24h", params: dict | None = None,
                   n_splits: int = 3, seed: int = SEED, embargo_rows: int = 0, parallelism: int = 1) -> list[float]:
    """Average precision of each expanding fold.  ``df`` may already hold ``fold``."""
    from raretide.operators.split import time_series_folds
    from raretide.session import written
    folded = df if "fold" in df.columns else written(time_series_folds(df, n_splits, embargo_rows=embargo_rows), "cv")

    def fit_and_score(train_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
        return predict(train(train_rows, features, model_type, label, params, seed), test_rows, features, label=label)

    return [r["average_precision"] for r in cross_validate(folded, fit_and_score, n_splits, parallelism)]


def penalised_gradient(model, df: DataFrame, features: Sequence[str], label: str = "failure_24h") -> DataFrame:
    """Optimality certificate of a fitted logistic regression on its training rows, by one aggregate: (feature, gradient, at_zero).

    ``gradient`` is that of the penalised weighted mean log loss at the coefficients (the constant under "(intercept)"), ``at_zero`` that of
    the model that knows nothing; at the optimum every gradient is 0."""
    names, coef = [*features, "(intercept)"], [*map(float, model.coefficients.toArray()), float(model.intercept)]
    x = [F.col(c).cast("double") for c in features] + [F.lit(1.0)]
    z = F.lit(0.0)
    for c, w in zip(x, coef):
        z = z + c * F.lit(w)
    d = with_weights(df, label).select(*[c.alias(n) for c, n in zip(x, names)], F.col("weight").alias("_w"), F.col(label).cast("double").alias("_y"),
                                       (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("_p"))
    sums = [F.sum("_w").alias("_n"), *[F.sum(F.col("_w") * (p - F.col("_y")) * F.col("value")).alias(k) for k, p in (("_g", F.col("_p")), ("_z", F.lit(0.5)))]]
    reg = [*[model.getRegParam() * c for c in coef[:-1]], 0.0]  # the constant is not penalised
    found = per_feature(d, names, sums, ["_w", "_p", "_y"]).join(F.broadcast(literal_table(df.sparkSession, list(zip(names, reg)), ["feature", "_r"])), "feature")
    return found.select("feature", (F.col("_g") / F.col("_n") + F.col("_r")).alias("gradient"), (F.col("_z") / F.col("_n")).alias("at_zero"))


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance) highest first: tree importances or |coefficients| of a linear model."""
    if hasattr(model, "featureImportances"):
        vals = [float(v) for v in model.featureImportances.toArray()]
    else:
        vals = [abs(float(v)) for v in model.coefficients.toArray()]
    t = literal_table(spark, list(zip(features, vals)), ["feature", "importance"])
    return t.orderBy(F.col("importance").desc(), F.col("feature"))


def tune(df: DataFrame, features: Sequence[str], n_trials: int = 50, label: str = "failure_24h", seed: int = SEED, model_type: str = "gbt",
         space: Space | None = None, at_once: int = 1, embargo_rows: int = 0, n_splits: int = 3) -> DataFrame:
    """Parzen search (``tuning``) over expanding time-series folds, scored by mean average precision, ``at_once`` trials in parallel.

    Returns one row per trial (trial, params as map, mean_average_precision).  Each fold is a Spark ML fit on the folded table, written once."""
    from raretide.operators.split import time_series_folds
    from raretide.session import written
    spark, space = df.sparkSession, SEARCH_SPACES[model_type] if space is None else space
    folded = written(time_series_folds(df, n_splits, embargo_rows=embargo_rows), "tune")
    ratio = scale_pos_weight(folded, label).first()["scale_pos_weight"] or 1.0

    def scaled(params: dict) -> dict:
        return {k: v * ratio if k == "positiveWeight" else v for k, v in params.items()}

    def score(params: dict) -> float:
        found = time_series_cv(folded, features, model_type, label, scaled(params), n_splits, seed)
        return sum(found) / len(found)

    trials = search(space, lambda asked: in_threads(spark, [lambda p=p: score(p) for p in asked], at_once, "trial"), n_trials, seed, at_once)
    rows = [(i, {k: str(v) for k, v in scaled(p).items()}, s) for i, (p, s) in enumerate(trials)]
    return spark.createDataFrame(rows, "trial int, params map<string,string>, mean_average_precision double")


_INTEGERS = frozenset(k for space in SEARCH_SPACES.values() for k, v in space.items() if v[0] == "int")


def best_params(trials: DataFrame) -> dict:
    """Parameters of the best trial (ties: the first), typed for ``train``."""
    row = trials.orderBy(F.desc("mean_average_precision"), "trial").first()
    if row is None:
        return {}
    return {k: int(v) if k in _INTEGERS else v if k == "featureSubsetStrategy" else float(v) for k, v in row["params"].items()}


def train_tuned(df: DataFrame, features: Sequence[str], n_trials: int = 50, label: str = "failure_24h", seed: int = SEED, model_type: str = "gbt"):
    """Tune, then fit on all rows with the best parameters: (model, parameters, trials)."""
    trials = tune(df, features, n_trials, label, seed, model_type)
    params = best_params(trials)
    return train(df, features, model_type, label, params, seed), params, trials


def save_model(model, path: str, features: Sequence[str], model_type: str, spark, params: dict | None = None,
               seed: int = SEED) -> None:
    model.write().overwrite().save(f"{path}/model")
    meta = spark.range(1).select(F.lit(model_type).alias("model_type"),
                                 F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
                                 F.create_map(*[x for k, v in (params or {}).items() for x in (F.lit(k), F.lit(str(v)))])
                                 .alias("best_params") if params else F.create_map().cast("map<string,string>").alias("best_params"),
                                 F.lit(seed).alias("random_seed"))
    meta.write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(path: str, spark):
    from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                           RandomForestClassificationModel)
    meta = spark.read.parquet(f"{path}/metadata").first()
    cls = {"logistic_regression": LogisticRegressionModel, "random_forest": RandomForestClassificationModel}.get(
        meta["model_type"], GBTClassificationModel)
    return cls.load(f"{path}/model"), list(meta["feature_columns"]), meta["model_type"]
