"""Sketches against exact answers, merged in different ways."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import sketches as K


@pytest.fixture(scope="module")
def rows(spark):
    """A hot group, a group of nulls, and values of very different frequency."""
    n = 120_000
    day = F.col("id") % 30
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    user = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 40_000)
    item = F.when(F.rand(3) < 0.2, F.lit("top")).otherwise(F.concat(F.lit("i"), F.floor(F.pow(F.rand(4), 3) * 5000)))
    return spark.range(n).select(group.alias("g"), day.alias("day"), user.alias("user"), item.alias("item"), (F.rand(5) * 1000).alias("x")).cache()


def test_distinct_counts_merge_to_any_grain(rows):
    mart = K.distinct_mart(rows, ["g", "day"], {"users": "user", "items": "item"})
    for keys in (["g"], ["day"], []):
        got = {tuple(r[k] for k in keys): r for r in K.distinct_counts(K.merge_distinct(mart, keys, ["users", "items"]), ["users", "items"]).collect()}
        exact = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user").alias("users"), F.count_distinct("item").alias("items")).collect()
        assert len(got) == len(exact)
        for r in exact:
            one = got[tuple(r[k] for k in keys)]
            assert one["n_rows"] == r["n"]
            for c in ("users", "items"):
                assert abs(one[c] - r[c]) <= K.distinct_error() * r[c]
                if r[c] <= 2 ** K.LG_K:
                    assert one[c] == r[c]  # exact while all hashes fit


def test_set_counts(spark):
    a, b = spark.range(0, 30_000), spark.range(20_000, 60_000)
    both = a.agg(F.theta_sketch_agg("id", K.LG_K).alias("a")).crossJoin(b.agg(F.theta_sketch_agg("id", K.LG_K).alias("b")))
    got = both.select(*[c.alias(n) for n, c in K.set_counts(F.col("a"), F.col("b")).items()]).first()
    for name, exact in (("either", 60_000), ("both", 10_000), ("first_only", 20_000)):
        assert abs(got[name] - exact) <= K.distinct_error() * 60_000


def test_quantiles_within_the_rank_error(rows):
    mart = K.quantile_mart(rows, ["g", "day"], {"x": "x"})
    shares = [0.01, 0.1, 0.5, 0.9, 0.99]
    told = {r["g"]: r["q"] for r in K.merge_quantiles(mart, ["g"], ["x"]).select("g", K.quantiles(F.col("x"), shares).alias("q")).collect()}
    values = {}
    for r in rows.select("g", "x").collect():
        values.setdefault(r["g"], []).append(r["x"])
    assert told.keys() == values.keys()
    for g, xs in values.items():
        xs = np.sort(xs)
        for share, q in zip(shares, told[g]):
            assert abs(np.searchsorted(xs, q, side="right") / len(xs) - share) <= K.rank_error() + 1 / len(xs)


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, x double")
    got = {r["g"]: r["q"] for r in K.quantile_mart(none, ["g"], {"x": "x"}).select("g", K.quantiles(F.col("x"), [0.5]).alias("q")).collect()}
    assert got == {"a": None, "b": [2.0]}


@pytest.mark.parametrize("tracked", [100, 1000, 8000])
def test_frequent_values_within_the_count_error(rows, tracked):
    merged = K.merge_frequent(K.frequent_mart(rows, ["g", "day"], "item", tracked), ["g"], tracked)
    exact = {(r["g"], r["item"]): r["count"] for r in rows.groupBy("g", "item").count().collect()}
    sizes = {}
    for (g, _), n in exact.items():
        sizes[g] = sizes.get(g, 0) + n
    got = K.frequent_values(merged, 20).collect()
    for r in got:
        assert r["n_rows"] == sizes[r["g"]]
        assert abs(r["count"] - exact.get((r["g"], r["item"]), 0)) <= K.count_error(tracked) * sizes[r["g"]] + 1e-9
    # Every value above the bound is among those given out, or the list is full of more frequent ones.
    for g in sizes:
        named = [r for r in got if r["g"] == g]
        top = max((k for k in exact if k[0] == g), key=exact.get)
        if exact[top] > 2 * K.count_error(tracked) * sizes[g]:
            assert top[1] in {r["item"] for r in named}
