"""Quality classifier: Bradley-Terry scores learned from preference pairs.

Each low-quality training document is paired with ``PAIRS`` high-quality ones (by rank in a seeded order); a pair
says that the second is preferred.  Logistic loss on the feature differences, without intercept, gives one weight
per feature; a document's margin is their sum.  The threshold is the quantile of the training margins at their share
of low-quality rows (halfway to the next margin), and the score is a logistic curve of the margin that is 0.3 there.

The pairs, the quantile and the curve come from all labelled training rows.  Ranks are counted by pieces and quantiles
by narrowing counts, so no task and no driver holds them all.  Features are shares and counts of the whole text only.
Null and empty texts have all features 0.  Without both labels every score is the share of label 1 (or 1).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import PIECE_ROWS, broadcast_up_to, fold, seeded, table, written
from raretide.operators.scan import nth_keys, with_row_index

PAIRS, DECISION = 8, 0.3
FINE = 2 ** 30  # parts of 1 in which margins are counted for quantiles


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


# The character classes counted.
CLASSES = {
    "upper": _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _bytes("0123456789"),
    "stop": _bytes(".,;:?"),
    "loud": _bytes("!"),
    "sign": _bytes("#$%&*+-/<=>@[]^_`{|}~\\"),
    "bar": _bytes("|"),
    "line": _bytes("\n"),
}
NAMES = [*CLASSES, "signed_words", "upper_words", "repeats", "same_next", "top_word", "word_length", "short"]
FEATURES = [*NAMES, *(f"{n}_root" for n in NAMES)]


def _per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (run[offs[1:]] - run[offs[:-1]]).astype(float)


def features(texts: pa.Array) -> np.ndarray:
    data, offs = tv.buffers(texts)
    n_bytes = np.maximum(np.diff(offs), 1).astype(float)
    words, counts = tv.word_hashes(data, offs, tv.SPACE_SEP)
    n_words = np.maximum(counts, 1).astype(float)
    cols = [_per_text(CLASSES[c][data], offs) / n_bytes for c in CLASSES]
    upper, sign = CLASSES["upper"][data], (CLASSES["sign"] | CLASSES["loud"])[data]
    edge = sign.copy()  # a sign after a word character: counts words that end in signs once
    if len(data):
        gap = tv.SPACE_SEP[data]
        edge[0] = False
        edge[1:] &= ~sign[:-1] & ~gap[:-1]
        double = np.zeros_like(upper)
        double[1:] = upper[1:] & upper[:-1]
        begun = double.copy()
        begun[1:] &= ~double[:-1]
    else:
        begun = edge
    cols.append(_per_text(edge, offs) / n_words)
    cols.append(_per_text(begun, offs) / n_words)
    first = np.cumsum(counts) - counts
    repeats, top = np.zeros(len(counts)), np.zeros(len(counts))
    for i in np.flatnonzero(counts):
        own, n = np.unique(words[first[i]:first[i] + counts[i]], return_counts=True)
        # the share of repeated words grows with length by itself; the exponent that links both does not
        repeats[i] = 1 - math.log(len(own) + 1) / math.log(counts[i] + 1)
        top[i] = n.max() / counts[i] if counts[i] > 9 else 0.0
    same = np.zeros(len(words), dtype=bool)
    same[1:] = words[1:] == words[:-1]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    cols += [repeats, _per_text(same, bounds) / n_words, top]
    cols.append(np.minimum(n_bytes / n_words, 100) / 100)
    cols.append(1 / (1 + counts))
    x = np.column_stack(cols)
    x[counts == 0] = 0.0
    return np.concatenate([x, np.sqrt(np.maximum(x, 0))], axis=1)


def _map_features(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text"):
                x = features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in columns] + [pa.array(list(x), pa.list_(pa.float64()))], names=columns + ["x"])
    return run


def _map_margin(columns: list[str], weights: list[float]):
    w = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in columns] + [pa.array(features(part.column("text")) @ w)], names=columns + ["__margin"])
    return run


def training(docs: DataFrame, labels: DataFrame, small: int = 1_000_000) -> DataFrame:
    """``doc_id, quality, x`` of all labelled training rows: crc32(doc_id) mod 5 is not 0.  At most ``small`` labels are broadcast."""
    known = labels.where((fold("doc_id", 5) != 0) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    joined = docs.select("doc_id", "text").join(broadcast_up_to(known, small), "doc_id").select("doc_id", "quality", "text")
    return written(joined.mapInArrow(_map_features(["doc_id", "quality"]), "doc_id long, quality int, x array<double>"), "quality-training")


sample = training  # its name while the rows were a sample


def middle(rows: DataFrame, low: int, high: int) -> float:
    """The mean of the values at two 1-based positions of the only column, whole numbers."""
    found = nth_keys(rows, rows.columns, list(dict.fromkeys([low, high])))
    return (found[0][0] + found[-1][0]) / 2


def learn(train: DataFrame, pairs: int = PAIRS) -> dict:
    """Feature weights, threshold and curve from ``doc_id, quality, x`` rows, a written table."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    sizes = {r["quality"]: r["count"] for r in train.groupBy("quality").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return {"weights": [0.0] * len(FEATURES), "threshold": 0.0, "slope": 0.0, "level": n1 / max(1, n0 + n1) if n0 + n1 else 1.0}
    place = F.conv(F.substring(seeded("doc_id", "pair-1"), 1, 15), 16, 10).cast("long")
    piece = 2 ** 60 // -(-(n0 + n1) // PIECE_ROWS)
    ranked = with_row_index(train.withColumn("_place", place), ["quality"], "_place", "doc_id", piece, name="r").withColumn("r", F.col("r") - 1)
    low = ranked.where("quality = 0").select(F.col("x").alias("x0"), F.col("r").alias("r0"), F.explode(F.sequence(F.lit(0), F.lit(min(pairs, n1) - 1))).alias("j"))
    low = low.withColumn("r", (F.col("r0") * pairs + F.col("j")) % n1)
    both = low.join(ranked.where("quality = 1").select("r", F.col("x").alias("x1")), "r")
    better = F.zip_with("x1", "x0", lambda a, b: a - b)
    flip = (F.col("j") + F.col("r0")) % 2 == 0  # either order of a pair says the same
    data = both.select(F.when(flip, better).otherwise(F.transform(better, lambda v: -v)).alias("d"), flip.cast("double").alias("label"))
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=200).fit(
        data.select(array_to_vector("d").alias("features"), "label"))
    w = [float(v) for v in model.coefficients]
    margin = F.aggregate(F.zip_with("x", F.lit(w), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    margins = written(train.select(F.floor(margin * FINE).alias("m")), "quality-margins")
    threshold = middle(margins, n0, n0 + 1)
    far = margins.select(F.abs(2 * F.col("m") - int(2 * threshold)).alias("m"))  # twice the distance, a whole number
    spread = middle(far, (n0 + n1 + 1) // 2, (n0 + n1) // 2 + 1) / 2 / FINE or 1.0
    return {"weights": w, "threshold": threshold / FINE, "slope": 4.0 / spread, "level": DECISION}


def score(docs: DataFrame, model: dict, keep: list[str], out: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and the score (0.3 at the threshold), named ``out``."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["__margin double"])
    found = docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(_map_margin(keep, model["weights"]), schema)
    level = min(max(model["level"], 1e-9), 1 - 1e-9)
    z = (F.col("__margin") - model["threshold"]) * model["slope"] + math.log(level / (1 - level))
    return found.select(*keep, (1 / (1 + F.exp(-z))).alias(out))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(sample(docs, table(spark, sf_dir, "labels")))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))
