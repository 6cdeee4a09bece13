"""Cross-validation on expanding folds and hyperparameter search.

Folds and trials are Spark jobs started from threads, each with a scheduler pool of its own, so that small fits fill the cluster together.  The search is a
tree-structured Parzen estimator: after ``STARTUP`` random trials, each parameter is drawn from a density over its values in the best
trials, and of ``CANDIDATES`` draws the one is taken that is likeliest there against the other trials.  A round's trials are
proposed from the rounds before it, each with a seed of its own, so results depend on the seed and the round size only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

STARTUP, CANDIDATES, BEST_SHARE, BEST_MOST = 10, 24, 0.1, 25

# The search spaces of the reference's tuner, (kind, low, high), under Spark's names: stepSize is the learning rate, maxIter the number of trees,
# featureSubsetStrategy the share of columns, minInstancesPerNode the least rows of a leaf, minInfoGain the least gain of a cut.  positiveWeight is a
# factor of the ratio of negatives to positives.
_COMMON = {"stepSize": ("log", 0.01, 0.3), "maxDepth": ("int", 3, 10), "maxIter": ("int", 50, 300), "subsamplingRate": ("uniform", 0.6, 1.0),
           "featureSubsetStrategy": ("uniform", 0.6, 1.0)}
SEARCH_SPACES = {
    "gbt": {"positiveWeight": ("log", 0.1, 10.0), **_COMMON, "minInstancesPerNode": ("int", 1, 10), "minInfoGain": ("uniform", 0.0, 5.0)},
    "gbt_leaf": {**_COMMON, "minInstancesPerNode": ("int", 10, 100)},
}

Space = dict[str, tuple[str, float, float]]


def in_threads(spark: SparkSession, jobs: Sequence[Callable[[], object]], parallelism: int, pool: str) -> list:
    """Results of the jobs in order, at most ``parallelism`` at a time, each in a scheduler pool of its own."""
    def run(numbered):
        number, job = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{number % parallelism}")
        return job()

    if parallelism <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(parallelism) as threads:
        # a wrapper for each job: every thread starts from a copy of this thread's properties
        return [f.result() for f in [threads.submit(inheritable_thread_target(spark)(run), x) for x in enumerate(jobs)]]


# ---------------------------------------------------------------- cross-validation

def training_rows(folded: DataFrame, fold: int) -> DataFrame:
    """Rows before a fold's test block, without those that its embargo takes out."""
    early = F.col("fold") < fold
    if "embargoed" in folded.columns:
        early = early & ~(F.col("embargoed") & (F.col("fold") == fold - 1))
    return folded.where(early)


def cross_validate(folded: DataFrame, fit_and_score: Callable[[DataFrame, DataFrame], DataFrame], n_splits: int, parallelism: int = 1) -> list[dict]:
    """For each expanding fold the row counts and the average precision of the test block.

    ``folded`` has ``fold`` (``time_series_folds``) and is read several times: pass a written table.  ``fit_and_score`` takes training and test rows
    and returns the test rows' (label, score)."""
    from raretide.operators.curves import pr_areas
    from raretide.session import written

    def one(fold: int) -> dict:
        train, test = training_rows(folded, fold), folded.where(F.col("fold") == fold)
        scored = written(fit_and_score(train, test), f"fold-{fold}")
        area = pr_areas(scored).select("average_precision").first()[0]
        return {"fold": fold, "train_rows": train.count(), "test_rows": scored.count(), "average_precision": float(area or 0.0)}

    return in_threads(folded.sparkSession, [lambda k=k: one(k) for k in range(1, n_splits + 1)], parallelism, "fold")


# ---------------------------------------------------------------- search

def to_params(point: dict[str, float], space: Space) -> dict:
    """Parameters of a point of the unit cube."""
    out = {}
    for name, u in point.items():
        kind, low, high = space[name]
        if kind == "int":
            out[name] = min(int(high), int(low) + int(u * (high - low + 1)))
        elif kind == "log":
            out[name] = math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        else:
            out[name] = low + u * (high - low)
    if "featureSubsetStrategy" in out:
        out["featureSubsetStrategy"] = f"{out['featureSubsetStrategy']:.3f}"
    return out


class Density:
    """Parzen density on [0, 1]: a truncated normal about each value, as wide as the gap to its neighbours, and a wide one for the rest."""

    def __init__(self, values: Sequence[float]):
        ordered = sorted(values)
        least = 1.0 / min(100, len(ordered) + 2)
        edges = [0.0, *ordered, 1.0]
        gaps = [max(edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1]) for i in range(len(ordered))]
        self.parts = [(v, min(1.0, max(least, g))) for v, g in zip(ordered, gaps)] + [(0.5, 1.0)]

    @staticmethod
    def _below(x: float, mean: float, width: float) -> float:
        return 0.5 * (1.0 + math.erf((x - mean) / (width * math.sqrt(2.0))))

    def draw(self, rng: random.Random) -> float:
        mean, width = rng.choice(self.parts)
        while not 0.0 <= (x := rng.gauss(mean, width)) < 1.0:
            pass
        return x

    def log(self, x: float) -> float:
        total = sum(math.exp(-0.5 * ((x - m) / w) ** 2) / (w * math.sqrt(2.0 * math.pi) * (self._below(1.0, m, w) - self._below(0.0, m, w)))
                    for m, w in self.parts)
        return math.log(total / len(self.parts) + 1e-300)


def propose(space: Space, trials: Sequence[tuple[dict, float]], number: int, seed: int, startup: int = STARTUP) -> dict[str, float]:
    """The point of trial ``number`` given (point, score) of earlier trials, the higher the better."""
    rng = random.Random(f"{seed}:{number}")
    if len(trials) < startup:
        return {name: rng.random() for name in space}
    ranked = sorted(trials, key=lambda t: -t[1])
    n = min(BEST_MOST, math.ceil(BEST_SHARE * len(ranked)))
    out = {}
    for name in space:
        good, rest = (Density([p[name] for p, _ in part]) for part in (ranked[:n], ranked[n:]))
        out[name] = max((good.draw(rng) for _ in range(CANDIDATES)), key=lambda x: good.log(x) - rest.log(x))
    return out


def search(space: Space, objective: Callable[[list[dict]], list[float]], n_trials: int, seed: int, at_once: int = 1, startup: int = STARTUP) -> list[tuple[dict, float]]:
    """(parameters, score) of every trial; ``objective`` scores a round's parameters."""
    trials: list[tuple[dict, float]] = []
    while len(trials) < n_trials:
        points = [propose(space, trials, len(trials) + k, seed, startup) for k in range(min(at_once, n_trials - len(trials)))]
        trials += list(zip(points, objective([to_params(p, space) for p in points])))
    return [(to_params(p, space), score) for p, score in trials]
