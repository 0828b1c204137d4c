"""Unions, ordering and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import unit_hash


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL of named branches with the branch name in ``tag``."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Repeatable sample: a key is in or out, on every run and every cluster."""
    return df.filter(unit_hash(key, seed) < min(max(fraction, 0.0), 1.0))
