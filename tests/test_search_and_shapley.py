"""Successive halving against an exhaustive search; Shapley values against all coalitions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from lakeops.plans import features as FT
from lakeops.plans import search, shapley


def coalition_value(leaves, row, inside):
    """Expected margin when the features of the coalition are known."""
    total = 0.0
    for leaf in leaves:
        weight = 1.0
        for f in leaf.features:
            weight *= float(leaf.meets(row[None, :], f)[0]) if f in inside else leaf.shares[f]
        total += leaf.value * weight
    return total


def by_all_coalitions(leaves, row, n):
    out = np.zeros(n)
    for j in range(n):
        others = [f for f in range(n) if f != j]
        for size in range(n):
            for inside in combinations(others, size):
                weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                out[j] += weight * (coalition_value(leaves, row, {*inside, j}) - coalition_value(leaves, row, set(inside)))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    kind = rng.integers(0, 4, 600)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (kind == 2)).astype(int)
    df = spark.createDataFrame([(i, *map(float, v), int(k), int(t), float(v[0] + k)) for i, (v, k, t) in enumerate(zip(x, kind, y))],
                               "id int, a double, b double, c double, d double, kind int, label int, target double")
    wide = VectorAssembler(inputCols=["a", "b", "c", "d", "kind"], outputCol="raw").transform(df)
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=6).fit(wide).transform(wide).cache()


@pytest.mark.parametrize("kind", ["boosted", "tree", "forest"])
def test_attributions(spark, rows, kind):
    if kind == "boosted":
        model = GBTClassifier(maxDepth=4, maxIter=5, seed=1).fit(rows)
        told = vector_to_array("rawPrediction")[1]
    elif kind == "tree":
        model, told = DecisionTreeRegressor(labelCol="target", maxDepth=5).fit(rows), F.col("prediction")
    else:
        model, told = RandomForestRegressor(labelCol="target", numTrees=4, maxDepth=4, seed=1).fit(rows), F.col("prediction") * 4
    scored = model.transform(rows).select("id", "features", told.alias("told"))
    out = shapley.explain(model, scored).orderBy("id").collect()
    assert len(out) == 600
    for r in out:  # base value and attributions add up to what the model says
        assert r["base_value"] + sum(r["attributions"]) == pytest.approx(r["told"], abs=1e-9)
        assert r["margin"] == pytest.approx(r["told"], abs=1e-9)
    leaves, n = shapley.leaves_of(model)
    features = {r["id"]: r["features"].toArray() for r in scored.collect()}
    for r in out[:12]:
        assert r["attributions"] == pytest.approx(by_all_coalitions(leaves, features[r["id"]], n), abs=1e-9)
    if kind == "boosted":
        assert any(isinstance(s, frozenset) for leaf in leaves for tests in leaf.tests.values() for s, _ in tests)
        shown = {r["feature"]: r["mean_size"] for r in shapley.importance(shapley.explain(model, scored), ["a", "b", "c", "d", "kind"]).collect()}
        sizes = np.abs([r["attributions"] for r in out]).mean(axis=0)
        assert [shown[f] for f in ("a", "b", "c", "d", "kind")] == pytest.approx(sizes.tolist())


def test_draw():
    space = {"x": [1, 2, 3], "y": ["a", "b"]}
    assert len(search.draw(space, 100)) == 6 and search.draw(space, 4, 1) == search.draw(space, 4, 1)
    drawn = search.draw({"n": (2, 9), "rate": (0.001, 1.0, "log"), "share": (0.5, 1.0), "k": [1, 2]}, 50)
    assert len(drawn) == 50
    assert all(2 <= p["n"] <= 9 and isinstance(p["n"], int) and 0.001 <= p["rate"] <= 1 and 0.5 <= p["share"] <= 1 for p in drawn)


def test_rungs():
    assert search.rungs(9, 9000, 1000, 3) == [(9, 1000), (3, 3000), (1, 9000)]
    assert search.rungs(9, 9000, 5000, 3) == [(9, 9000)]
    assert search.rungs(2, 10 ** 6, 10, 2) == [(2, 500_000), (1, 1_000_000)]


def test_halving_finds_what_an_exhaustive_search_finds(spark):
    df = spark.range(2000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    fitted = []

    def fit(rows, params):
        fitted.append((rows.count(), rows.filter("label = 1").count(), params["q"]))
        return params

    def score(params, rows):
        return -abs(params["q"] - 0.62)

    trials = [{"q": i / 20} for i in range(20)]
    best, out = search.halving_search(df, df.limit(10), ["id"], "label", trials, fit, score, least_rows=200, factor=2)
    assert best == max(trials, key=lambda p: score(p, None))
    table = [tuple(r) for r in out.orderBy("rung", "trial").collect()]
    assert [(n, r) for r, n in sorted({(x[3], sum(1 for y in table if y[0] == x[0])) for x in table})] == [(20, 250), (10, 500), (5, 1000), (2, 2000)]
    assert {(n, one) for n, one, _ in fitted} == {(250, 62), (500, 125), (1000, 250), (2000, 500)} or all(abs(one * 4 - n) <= 4 for n, one, _ in fitted)
    for rung in range(3):  # those that go on are those kept
        assert {x[1] for x in table if x[0] == rung and x[5]} == {x[1] for x in table if x[0] == rung + 1}
    assert sum(x[5] for x in table if x[0] == 3) == 1


def test_search_of_a_classifier(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 2))
    df = spark.createDataFrame([(i, float(a), float(b), int(a * b > 0)) for i, (a, b) in enumerate(x)], "id int, a double, b double, label int")
    space = {"maxDepth": [1, 4], "maxIter": [5]}  # one split per tree cannot see the product
    model, trials = FT.search_classifier(df.filter("id < 800"), df.filter("id >= 800"), ["id"], "label", ["a", "b"], space, least_rows=200, factor=2)
    assert model.stages[-1].getMaxDepth() == 4
    assert trials.filter("kept").orderBy(F.col("rung").desc()).first()["params"] == '{"maxDepth": 4, "maxIter": 5}'
