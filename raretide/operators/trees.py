"""Fitted forests as a relational table, scored by walking it, and exact Shapley contributions.

``node_table`` exports a random forest or boosted trees to one row per node, from which SQL alone can score: a row's margin is the sum over trees of weight *
value of the leaf it falls into.  For a forest the margin is the probability of class 1; for boosted trees the probability is
1 / (1 + exp(-2 * margin)).

``tree_contributions`` splits a margin into one contribution per feature: the Shapley values of the game in which a feature that is not in the coalition
follows both branches by their share of training weight.  Trees go to the tasks once; a leaf's game has only the features on its path
as players, and its values depend on a row only through which of the path's conditions hold, so each pattern of these is
solved once a batch, by the polynomial of its coalitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from raretide.session import scratch_path, written

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, cover double, gain double, weight double"


def is_boosted(model) -> bool:
    return "GBT" in type(model).__name__


def node_table(model, spark) -> DataFrame:
    """One row per node (``NODES``) in preorder; leaves have no feature.  ``cover`` is the training weight that reached the node."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    d = F.col("nodeData")
    stats = F.col("nodeData.impurityStats")
    leaf = d.leftChild < 0
    total = stats[0] if is_boosted(model) else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    value = d.prediction if is_boosted(model) else F.when(total > 0, F.get(stats, 1) / total).otherwise(F.lit(0.0))
    weights = [float(w) if is_boosted(model) else 1.0 / len(model.treeWeights) for w in model.treeWeights]
    saved = spark.read.parquet(f"{path}/data")
    if saved.where(d.split.numCategories >= 0).limit(1).count():
        raise ValueError("categorical splits are not supported")
    return written(saved.select(
        F.col("treeID").alias("tree"), d.id.alias("node"), F.when(~leaf, d.split.featureIndex).alias("feature"),
        F.when(~leaf, d.split.leftCategoriesOrThreshold[0]).alias("threshold"), F.when(~leaf, d.leftChild).alias("left"), F.when(~leaf, d.rightChild).alias("right"),
        F.coalesce(value, F.lit(0.0)).alias("value"), total.alias("cover"), F.when(~leaf, d.gain).alias("gain"),
        F.get(F.array(*map(F.lit, weights)), F.col("treeID")).alias("weight")), "nodes")


class Walk:
    """A tree as arrays by position in preorder; a leaf leads to itself."""

    def __init__(self, rows: Sequence):
        rows = sorted(rows, key=lambda r: r["node"])
        at = {r["node"]: i for i, r in enumerate(rows)}
        inner = [r["feature"] is not None for r in rows]
        self.feature = np.array([r["feature"] if k else 0 for r, k in zip(rows, inner)], dtype=int)
        self.threshold = np.array([r["threshold"] if k else 0.0 for r, k in zip(rows, inner)])
        self.left, self.right = (np.array([at[r[side]] if k else i for i, (r, k) in enumerate(zip(rows, inner))]) for side in ("left", "right"))
        self.value = np.array([r["value"] * r["weight"] for r in rows])
        level = np.zeros(len(rows), dtype=int)
        for i, k in enumerate(inner):  # parents come first
            if k:
                level[self.left[i]] = level[self.right[i]] = level[i] + 1
        self.depth = int(level.max())

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The value of the leaf each row falls into; a missing value is not below any threshold."""
        at, every = np.zeros(len(x), dtype=int), np.arange(len(x))
        with np.errstate(invalid="ignore"):
            for _ in range(self.depth):
                at = np.where(x[every, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]


def node_rows(nodes: DataFrame) -> list[list]:
    """Every tree's node rows, by tree; the table has the size of the model."""
    trees: dict[int, list] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], []).append(r)
    return [trees[t] for t in sorted(trees)]


def matrix(part: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """Columns of a batch as an array, a row of it per row; nulls are missing values."""
    return np.stack([part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns], axis=1)


def score_by_table(df: DataFrame, nodes: DataFrame, features: Sequence[str], name: str = "margin", keep: Sequence[str] | None = None,
                   rows_at_once: int = 2000) -> DataFrame:
    """``df`` (its columns ``keep``; default: all) with the margin of every row, by walking the node table.

    The table goes to all tasks once: its size is the model's (trees times nodes of a tree), not the data's.  A batch takes
    each tree's steps together, as many as the tree is deep."""
    kept = list(df.columns if keep is None else keep)
    numbers = [f"__x{i}" for i in range(len(features))]
    sent = df.sparkSession.sparkContext.broadcast([Walk(rows) for rows in node_rows(nodes)])
    kind = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                x, total = matrix(part, numbers), np.zeros(part.num_rows)
                for tree in sent.value:
                    total += tree.margins(x)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(total)], names=kind.names)

    return df.select(*kept, *[F.col(c).cast("double").alias(n) for c, n in zip(features, numbers)]).mapInArrow(run, kind)


def importance_by_table(nodes: DataFrame, features: Sequence[str], per_tree: bool = True) -> DataFrame:
    """(feature, importance): gains weighted by cover, shares within each tree (``per_tree``, as forests do) and then over all."""
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
    if per_tree:
        sums = gains.groupBy("tree").agg(F.sum("g").alias("all"))
        gains = gains.join(F.broadcast(sums), "tree").withColumn("g", F.col("g") / F.col("all"))
    shares = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    shares = shares.crossJoin(F.broadcast(shares.agg(F.sum("g").alias("all"))))
    return shares.select(F.get(F.array(*map(F.lit, features)), F.col("feature")).alias("feature"), (F.col("g") / F.col("all")).alias("importance"))


# ---------------------------------------------------------------- contributions

class Leaf:
    """A leaf's game: for each feature on its path the interval that leads there and the share of training weight that went along."""

    def __init__(self, value: float, path: dict[int, tuple[float, float, float]]):
        self.value, self.features = value, np.array(list(path), dtype=int)
        low, high, share = np.array(list(path.values())).reshape(-1, 3).T
        self.low, self.high, self.share = low, high, share
        m = len(self.features)
        self.weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]

    def follows(self, x: np.ndarray) -> np.ndarray:
        """Whether each row's feature leads to the leaf; a missing value is not below any threshold."""
        v = x[:, self.features]
        with np.errstate(invalid="ignore"):
            return ((v <= self.high) | np.isinf(self.high)) & (~(v <= self.low) | np.isinf(self.low))

    def values(self, follows: np.ndarray) -> np.ndarray:
        """Shapley values of the path's features for each pattern of conditions."""
        o, z, m = follows.astype(float), self.share, len(self.features)
        p = np.zeros((len(o), m + 1))  # coefficients of the product of (share + follows * y) by coalition size
        p[:, 0] = 1
        for j in range(m):
            p[:, 1:] = z[j] * p[:, 1:] + o[:, j, None] * p[:, :-1]
            p[:, 0] *= z[j]
        out = np.zeros((len(o), m))
        for i in range(m):
            on = follows[:, i]
            q = p[:, :m] / z[i]  # without feature i, where it does not follow
            last = np.zeros(len(o))
            for k in range(m - 1, -1, -1):  # where it does: divide by (share + y), highest power first
                last = p[:, k + 1] - z[i] * last
                q[:, k] = np.where(on, last, q[:, k])
            out[:, i] = self.value * (o[:, i] - z[i]) * (q @ np.array(self.weights))
        return out


def leaves(rows: Sequence) -> list[Leaf]:
    """The leaves of one tree from its node rows."""
    node = {r["node"]: r for r in rows}
    out, todo = [], [(0, {})]
    while todo:
        at, path = todo.pop()
        r = node[at]
        if r["feature"] is None:
            out.append(Leaf(r["value"] * r["weight"], path))
            continue
        low, high, share = path.get(r["feature"], (-math.inf, math.inf, 1.0))
        for child, bounds in ((r["left"], (low, min(high, r["threshold"]))), (r["right"], (max(low, r["threshold"]), high))):
            part = node[child]["cover"] / r["cover"] if r["cover"] else 0.5
            todo.append((child, path | {r["feature"]: (*bounds, share * part)}))
    return out


def forest_leaves(nodes: DataFrame) -> list[list[Leaf]]:
    """Every tree's leaves."""
    return [leaves(rows) for rows in node_rows(nodes)]


def base_value(forest: list[list[Leaf]]) -> float:
    """The margin when no feature is known."""
    return sum(leaf.value * float(np.prod(leaf.share)) for tree in forest for leaf in tree)


def shapley(forest: list[list[Leaf]], x: np.ndarray) -> np.ndarray:
    """Contribution of each column of ``x`` to the margin of each row."""
    out = np.zeros(x.shape)
    for tree in forest:
        for leaf in tree:
            m = len(leaf.features)
            if m and leaf.value:
                follows = leaf.follows(x)
                _, first, which = np.unique(follows @ (1 << np.arange(m)), return_index=True, return_inverse=True)
                out[:, leaf.features] += leaf.values(follows[first])[which]
    return out


def tree_contributions(df: DataFrame, nodes: DataFrame, features: Sequence[str], id_col: str = "row_id", rows_at_once: int = 2000) -> tuple[DataFrame, float]:
    """Long table (id, feature, value, contribution) of every row, and the base value: their sum is the row's margin."""
    spark, names = df.sparkSession, list(features)
    forest = forest_leaves(nodes)
    sent = spark.sparkContext.broadcast(forest)
    kind = f"{id_col} {df.schema[id_col].dataType.simpleString()}, feature string, value double, contribution double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                x = matrix(part, names)
                ids = part.column(id_col).take(pa.array(np.repeat(np.arange(part.num_rows), len(names))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(names * part.num_rows), pa.array(x.ravel()), pa.array(shapley(sent.value, x).ravel())],
                                                 names=[id_col, "feature", "value", "contribution"])

    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in names])
    return rows.mapInArrow(run, kind), base_value(forest)
