"""Exact samples and splits against a sort."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.operators.sampling import exact_sample, exact_split


def place(key, seed):
    return int(hashlib.md5(f"{key}#{seed}".encode()).hexdigest()[:15], 16)


def table(spark, n=3000):
    kinds = ["a"] * 20 + ["b"] * 5 + [None] * 2 + ["c"]
    return spark.createDataFrame([(i, kinds[i % len(kinds)] if i != 7 else "once", i * 0.5) for i in range(n)], "id bigint, kind string, x double")


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_sample_is_the_smallest_hashes_and_nested(spark):
    df = table(spark)
    ids = sorted(range(3000), key=lambda i: place(i, 5))
    held = {}
    for n in (0, 1, 17, 500, 2999, 3000, 5000):
        got = exact_sample(df.repartition(11), ["id"], n, seed=5)
        assert got.columns == df.columns
        held[n] = {r["id"] for r in got.collect()}
        assert held[n] == set(ids[:n])
    assert held[17] < held[500]


def test_sample_per_class(spark):
    df = table(spark)
    got = exact_sample(df, ["id"], 50, ["kind"], seed=1).collect()
    assert Counter(r["kind"] for r in got) == {"a": 50, "b": 50, None: 50, "c": 50, "once": 1}
    got = exact_sample(df, ["id"], {"a": 30, None: 3, "zzz": 9}, ["kind"], seed=1).collect()
    assert Counter(r["kind"] for r in got) == {"a": 30, None: 3}


@pytest.mark.parametrize("partitions", [1, 13])
def test_split_has_exact_shares_of_every_class(spark, partitions):
    df = table(spark).repartition(partitions)
    got = exact_split(df, ["id"], {"train": 0.6, "val": 0.2, "test": 0.2}, ["kind"], seed=3).collect()
    sizes, parts, want = Counter(), Counter(), {}
    for r in got:
        sizes[r["kind"]] += 1
        parts[r["kind"], r["split"]] += 1
    for kind, n in sizes.items():
        train, both = int(n * 0.6 + 0.5 + 1e-9), int(n * 0.8 + 0.5 + 1e-9)
        assert [parts[kind, p] for p in ("train", "val", "test")] == [train, both - train, n - both]
        own = sorted((r["id"] for r in got if r["kind"] == kind), key=lambda i: place(i, 3))
        want |= {i: "train" if at < train else "val" if at < both else "test" for at, i in enumerate(own)}
    assert {r["id"]: r["split"] for r in got} == want


def test_keys_that_repeat(spark):
    """A key that a third of the rows share is cut within, by as many rows as are missing."""
    df = spark.createDataFrame([(1 if i % 3 == 0 else i, i % 4) for i in range(900)], "id int, v int")
    for n in (1, 100, 333, 899):
        one = exact_sample(df, ["id"], n)
        assert one.count() == n
        assert order(one.collect()) == order(exact_sample(df.repartition(7), ["id"], n).collect())


def test_empty_and_clashing_columns(spark):
    none = table(spark).limit(0)
    assert exact_sample(none, ["id"], 5).count() == exact_split(none, ["id"], {"a": 0.5, "b": 0.5}).count() == 0
    clash = table(spark, 10).withColumns({"g": F.lit(1), "h": F.lit(2), "cut": F.lit(3), "at": F.lit(4), "take": F.lit(5), "n": F.lit(6)})
    assert exact_sample(clash, ["id"], 4).count() == 4
    with pytest.raises(ValueError):
        exact_sample(clash.withColumn("_h", F.lit(1)), ["id"], 4)
