"""Exported forests: scored by DuckDB, importances, and contributions against all coalitions."""

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

NAMES = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def rows(spark):
    d = spark.range(400, numPartitions=2).select("id", *[(F.floor(F.rand(i + 1) * 40) / 4).alias(c) for i, c in enumerate(NAMES)])
    label = ((F.col("x0") + F.col("x1") * F.col("x2") / 5 + F.rand(99) * 3 > 9) & (F.col("x3") < 8)).cast("int")
    from raretide.session import written
    return written(d.withColumn("failure_24h", label), "trees")


@pytest.fixture(scope="module", params=["random_forest", "gbt"])
def fitted(spark, rows, request):
    from raretide.operators import models as M
    from raretide.operators import trees as R
    params = {"numTrees": 4, "maxDepth": 4} if request.param == "random_forest" else {"maxIter": 4, "maxDepth": 3}
    model = M.train(rows, NAMES, request.param, params=params)
    return model, R.node_table(model, spark), M.predict(model, rows, NAMES, keep=("id",))


def margin_of(model, p):
    return 0.5 * math.log(p / (1 - p)) if "GBT" in type(model).__name__ else p


def test_sql_scores_the_exported_table(spark, rows, fitted, tmp_path):
    """A recursive walk in DuckDB over the nodes gives the model's probability; the expressions in Spark give it too."""
    from raretide.operators import trees as R
    model, nodes, scored = fitted
    nodes.coalesce(1).write.parquet(f"{tmp_path}/nodes")
    rows.write.parquet(f"{tmp_path}/rows")
    con = duckdb.connect()
    got = dict(con.execute(f"""
      WITH RECURSIVE n AS (SELECT * FROM '{tmp_path}/nodes/*.parquet'),
      r AS (SELECT id, [{', '.join(NAMES)}] AS x FROM '{tmp_path}/rows/*.parquet'),
      walk AS (SELECT id, x, tree, 0 AS node FROM r, (SELECT DISTINCT tree FROM n)
        UNION ALL SELECT id, x, w.tree, CASE WHEN x[feature + 1] <= threshold THEN n."left" ELSE n."right" END FROM walk w JOIN n ON n.tree = w.tree AND n.node = w.node WHERE feature IS NOT NULL)
      SELECT id, sum(value * weight) FROM walk JOIN n USING (tree, node) WHERE feature IS NULL GROUP BY id""").fetchall())
    own = {r["id"]: r["margin"] for r in R.score_by_table(rows, nodes, NAMES).select("id", "margin").collect()}
    want = {r["id"]: margin_of(model, r["score"]) for r in scored.collect()}
    assert len(set(want.values())) > 5 and set(got) == set(want) == set(own)
    for i in want:
        assert abs(got[i] - want[i]) < 1e-9 and abs(own[i] - want[i]) < 1e-9


def test_importances_follow_from_the_table(spark, fitted):
    from raretide.operators import models as M
    from raretide.operators import trees as R
    model, nodes, _ = fitted
    want = {r["feature"]: r["importance"] for r in M.feature_importance(model, NAMES, spark).collect()}
    got = {r["feature"]: r["importance"] for r in R.importance_by_table(nodes, NAMES, per_tree=not R.is_boosted(model)).collect()}
    assert {k: round(v, 9) for k, v in want.items() if v} == {k: round(v, 9) for k, v in got.items()} and len(got) > 2


def expected(tree, x, known):
    """Mean value of a tree when only the features in ``known`` are followed."""
    def go(at):
        r = tree[at]
        if r["feature"] is None:
            return r["value"] * r["weight"]
        if r["feature"] in known:
            return go(r["left"] if x[r["feature"]] <= r["threshold"] else r["right"])
        return sum(tree[c]["cover"] / r["cover"] * go(c) for c in (r["left"], r["right"]))
    return go(0)


def test_contributions_are_the_shapley_values(spark, rows, fitted):
    from raretide.operators import trees as R
    model, nodes, scored = fitted
    some = rows.where("id < 25")
    contrib, base = R.tree_contributions(some, nodes, NAMES, "id", rows_at_once=7)
    got = {(r["id"], r["feature"]): r["contribution"] for r in contrib.collect()}
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    m = len(NAMES)
    for r in some.collect():
        x = [r[c] for c in NAMES]
        game = {s: sum(expected(t, x, s) for t in trees.values()) for k in range(m + 1) for s in map(frozenset, itertools.combinations(range(m), k))}
        assert abs(game[frozenset()] - base) < 1e-9
        for i, c in enumerate(NAMES):
            want = sum(math.factorial(len(s)) * math.factorial(m - 1 - len(s)) / math.factorial(m) * (game[s | {i}] - game[s]) for s in game if i not in s)
            assert abs(got[r["id"], c] - want) < 1e-9
    sums = {i: base + sum(v for (j, _), v in got.items() if i == j) for i in {k[0] for k in got}}
    for r in scored.where("id < 25").collect():
        assert abs(sums[r["id"]] - margin_of(model, r["score"])) < 1e-9


def test_missing_values_and_single_leaves(spark):
    from raretide.operators import trees as R
    rows = [{"node": 0, "feature": 0, "threshold": 1.0, "left": 1, "right": 2, "value": 0.0, "cover": 4.0, "weight": 1.0},
            {"node": 1, "feature": None, "value": 1.0, "cover": 1.0, "weight": 1.0}, {"node": 2, "feature": None, "value": 3.0, "cover": 3.0, "weight": 1.0}]
    forest = [R.leaves(rows), R.leaves([{"node": 0, "feature": None, "value": 5.0, "cover": 4.0, "weight": 1.0}])]
    assert R.base_value(forest) == 7.5
    assert R.shapley(forest, np.array([[np.nan], [0.0], [1.0], [2.0]])).ravel().tolist() == [0.5, -1.5, -1.5, 0.5]


def test_scores_are_made_in_as_many_steps_as_a_tree_is_deep(spark):
    """Batches, kept columns, nulls and clashing names; the plan walks arrays and evaluates no expression per tree."""
    from raretide.operators import trees as R
    schema = R.NODES
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1, 2, 0.0, 4.0, 1.0, 0.5), (0, 1, None, None, None, None, 1.0, 1.0, None, 0.5), (0, 2, 1, 5.0, 3, 4, 0.0, 3.0, 1.0, 0.5),
                                   (0, 3, None, None, None, None, 3.0, 2.0, None, 0.5), (0, 4, None, None, None, None, 7.0, 1.0, None, 0.5),
                                   (1, 0, None, None, None, None, 10.0, 4.0, None, 0.5)], schema)
    rows = spark.createDataFrame([(1, 0.0, 9.0, "a"), (2, 1.0, 9.0, "b"), (3, 2.0, 5.0, None), (4, 2.0, 6.0, "c"), (5, None, 1.0, "d"), (None, float("nan"), None, "e")],
                                 "id long, x0 double, x1 double, tag string")
    want = {1: 5.5, 2: 5.5, 3: 6.5, 4: 8.5, 5: 6.5, None: 8.5}
    scored = R.score_by_table(rows, nodes, ["x0", "x1"], rows_at_once=2)
    assert scored.columns == ["id", "x0", "x1", "tag", "margin"] and {r["id"]: r["margin"] for r in scored.collect()} == want
    few = R.score_by_table(rows, nodes, ["x0", "x1"], name="m", keep=("id",))
    assert few.columns == ["id", "m"] and {r["id"]: r["m"] for r in few.collect()} == want
    assert R.score_by_table(rows.limit(0), nodes, ["x0", "x1"]).count() == 0
    assert R.Walk([r for r in nodes.collect() if r["tree"] == 0]).depth == 2 and R.Walk([r for r in nodes.collect() if r["tree"] == 1]).depth == 0
