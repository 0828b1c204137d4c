"""Shapley values of the features for fitted Spark trees.

A feature that is not in a coalition sends a row down both branches, in
proportion to the training rows that went there. For one leaf only the features
on its path matter: with o = 1 if the row meets all conditions of the feature
on the path and z the share of training rows that do, the leaf counts by the product of
o (inside the coalition) and z (outside). The weights of all coalitions of one size
are a coefficient of the product of (z + o t) over the other features, so a leaf
with d features costs d times d squared operations, not 2 to the d. All rows of a batch are
done at once. The values of a row add up to its margin less the base value.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import work_dir


class Leaf:
    """Value of a leaf and, per feature on its path, the conditions and the share of rows that meet them."""

    def __init__(self, value: float, conditions: list[tuple[int, object, bool]], shares: list[float]):
        self.value = value
        self.features = sorted({f for f, _, _ in conditions})
        self.tests = {f: [(split, left) for g, split, left in conditions if g == f] for f in self.features}
        self.shares = {f: float(np.prod([s for (g, _, _), s in zip(conditions, shares) if g == f])) for f in self.features}

    def meets(self, rows: np.ndarray, feature: int) -> np.ndarray:
        ok = np.ones(len(rows), dtype=bool)
        for split, left in self.tests[feature]:
            x = rows[:, feature]
            goes_left = np.isin(x, list(split)) if isinstance(split, frozenset) else x <= split
            ok &= goes_left == left
        return ok


def leaves_of(model) -> tuple[list[Leaf], int]:
    """The leaves of all trees, with the weights of the trees in their values, and the number of features.

    For tree models of Spark ML with one output per tree (regression trees, boosted trees). The nodes come to the
    driver: as many as the trees have.
    """
    path = work_dir(_session(), "trees")
    model.write().overwrite().save(path)
    nodes = _session().read.parquet(f"{path}/data").collect()
    weights = list(getattr(model, "treeWeights", None) or [1.0])
    trees: dict[int, dict[int, object]] = {}
    for r in nodes:
        tree, node = (r["treeID"], r["nodeData"]) if "treeID" in r.__fields__ else (0, r)
        trees.setdefault(tree, {})[node["id"]] = node
    out: list[Leaf] = []
    for tree, held in sorted(trees.items()):
        stack = [(0, [], [])]
        while stack:
            at, conditions, shares = stack.pop()
            node = held[at]
            if node["leftChild"] < 0:
                out.append(Leaf(node["prediction"] * weights[tree], conditions, shares))
                continue
            split = node["split"]
            values = split["leftCategoriesOrThreshold"]
            test = values[0] if split["numCategories"] < 0 else frozenset(values)
            for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
                share = _rows(held[child]) / max(_rows(node), 1e-300)
                stack.append((child, [*conditions, (split["featureIndex"], test, left)], [*shares, share]))
    return out, model.numFeatures


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _rows(node) -> float:
    """Training rows of a node."""
    return float(node["rawCount"]) if "rawCount" in node.__fields__ else float(node["impurityStats"][0])


def base_value(leaves: list[Leaf]) -> float:
    """The expected margin: every leaf by the share of rows that reach it."""
    return sum(leaf.value * float(np.prod(list(leaf.shares.values()))) for leaf in leaves)


def attributions(leaves: list[Leaf], rows: np.ndarray, n_features: int) -> np.ndarray:
    """Shapley values, one row per row and one column per feature."""
    out = np.zeros((len(rows), n_features))
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        inside = np.stack([leaf.meets(rows, f) for f in leaf.features]).astype(float)
        outside = np.array([leaf.shares[f] for f in leaf.features])
        weights = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
        for j, feature in enumerate(leaf.features):
            # Coefficients of the product over the other features, by the size of the coalition.
            sizes = np.zeros((d, len(rows)))
            sizes[0] = 1.0
            for i in range(d):
                if i != j:
                    grown = sizes * outside[i]
                    grown[1:] += sizes[:-1] * inside[i]
                    sizes = grown
            out[:, feature] += leaf.value * (inside[j] - outside[j]) * (weights @ sizes)
    return out


def explain(model, df: DataFrame, features_col: str = "features", name: str = "attributions") -> DataFrame:
    """``df`` with the attribution of every feature (an array), ``base_value`` and ``margin``.

    ``model`` is a fitted tree model; ``features_col`` is the vector it was fitted on. The margin is what the model
    sums up: the prediction of a regression, half the log odds of boosted trees for two classes. Only the leaves go to the tasks.
    """
    leaves, n_features = leaves_of(model)
    base = base_value(leaves)
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    taken = [c for c in df.columns if c != features_col]
    row = df.select(F.struct(*taken).alias("row") if taken else F.lit(0).alias("row"), vector_to_array(features_col).alias("x"))
    kind = row.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.array(batch.column("x").to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            values = attributions(shared.value, rows, n_features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(list(values), pa.list_(pa.float64())),
                 pa.array(base + values.sum(axis=1))], names=["row", name, "margin"])

    out = row.mapInArrow(run, f"row {kind}, `{name}` array<double>, margin double")
    return out.select(*(["row.*"] if taken else []), name, F.lit(base).alias("base_value"), "margin")


def importance(explained: DataFrame, features: list[str], name: str = "attributions") -> DataFrame:
    """Mean absolute attribution per feature, as a summary plot shows it."""
    per = explained.select(F.posexplode(F.transform(name, lambda x: F.abs(x))).alias("at", "size"))
    return per.groupBy("at").agg(F.avg("size").alias("mean_size")).select(
        F.element_at(F.array(*[F.lit(f) for f in features]), F.col("at") + 1).alias("feature"), "mean_size")
