"""One persisted artifact from features to score: a ``PipelineModel`` of the column contract with its scaler, and the model.

``FeatureScaler`` holds the feature names in the model's order with their training means and population deviations.  It scales what a table has and puts
0 for what it lacks, by column expressions, so that it works on batches and streams alike.  ``LinearScorer`` scores scaled columns by a logistic of a
weighted sum; ``ClassifierScore`` turns a Spark ML classifier's probability into the ``score`` column.  All are
written with Spark ML's own writer and load in any session that has this package.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from raretide.operators import models as M
from raretide.operators.explain import separation_weights
from raretide.operators.features import SENSORS, build_features
from raretide.operators.scale import fit_scaler
from raretide.session import written


class _Named(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    features = Param(Params._dummy(), "features", "feature columns in the model's order", TypeConverters.toListString)


class FeatureScaler(_Named):
    """(x - mean) / scale of every feature; a feature that the table lacks is 0; other columns stay."""

    means = Param(Params._dummy(), "means", "training means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "training population deviations, 1 where 0", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, features=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        have = set(dataset.columns)
        told = zip(*(self.getOrDefault(p) for p in (self.features, self.means, self.scales)))
        return dataset.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) if c in have else F.lit(0.0) for c, m, s in told})


class LinearScorer(_Named):
    """score = 1 / (1 + exp(-(intercept + sum of weight * feature)))."""

    weights = Param(Params._dummy(), "weights", "weight of each feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "constant of the sum", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, features=None, weights=None, intercept=0.0):
        super().__init__()
        self._setDefault(intercept=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # An expression without generated code (the constant plus 0) keeps the sum out of whole-stage code, where it is one method, too long to be
        # compiled; Spark then splits it into methods that are.
        total = F.aggregate(F.array(F.lit(0.0)), F.lit(float(self.getOrDefault(self.intercept))), lambda constant, x: constant + x)
        for c, w in zip(self.getOrDefault(self.features), self.getOrDefault(self.weights)):
            total = total + F.lit(w) * F.col(c)
        return dataset.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-total)))


class ClassifierScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """score = probability of class 1 (0 for a model that has seen one class); the vectors are dropped."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0))
        return dataset.withColumn("score", score).drop("features", "rawPrediction", "probability")


def fit_feature_scaler(train: DataFrame, features: Sequence[str], stats: DataFrame | None = None) -> FeatureScaler:
    """The scaler of ``train``, or of its statistics ``stats`` where they are known."""
    stats = {r["feature"]: r for r in (fit_scaler(train, features) if stats is None else stats).collect()}  # one row per feature
    return FeatureScaler(features=list(features), means=[stats[c]["mean"] or 0.0 for c in features], scales=[stats[c]["scale"] for c in features])


def fit_artifact(train: DataFrame, features: Sequence[str], model_type: str = "gbt", label: str = "failure_24h", params: dict | None = None,
                 seed: int = M.SEED) -> PipelineModel:
    """Scaler and classifier fitted on a feature table."""
    scaler = fit_feature_scaler(train, features)
    model = M.train(scaler.transform(train), features, model_type, label, params, seed)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return PipelineModel([scaler, assembler, model, ClassifierScore()])


def fit_linear_artifact(train: DataFrame, features: Sequence[str], label: str = "failure_24h") -> PipelineModel:
    """Scaler and the closed-form scorer: each scaled feature weighs the standardised difference of its class means, over the number of features."""
    stats = written(fit_scaler(train, features), "stats")  # one row per feature, read twice
    scaler = fit_feature_scaler(train, features, stats)
    weights = {r["feature"]: r["weight"] for r in separation_weights(train, stats, features, label).collect()}  # one row per feature
    return PipelineModel([scaler, LinearScorer(features=list(features), weights=[weights[c] / len(features) for c in features])])


def save_artifact(artifact: PipelineModel, path: str) -> None:
    artifact.write().overwrite().save(path)


def load_artifact(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def transform_features(artifact: PipelineModel, readings: DataFrame, keys: Sequence[str] = ("entity_id",), sensors: Sequence[str] = SENSORS,
                       scale: bool = True, **options) -> DataFrame:
    """Features of new readings, scaled by the artifact's statistics (``scale``)."""
    made = build_features(readings, keys, sensors, **options)
    return artifact.stages[0].transform(made) if scale else made


def score(artifact: PipelineModel, features: DataFrame) -> DataFrame:
    """A feature table (batch or stream) with ``score``."""
    return artifact.transform(features)

