"""Row expectations and table checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.aggregates import duplicates


class Expectations(NamedTuple):
    good: DataFrame
    bad: DataFrame
    metrics: DataFrame


def expect_or_drop(df: DataFrame, rules: Mapping[str, str]) -> Expectations:
    """Keep rows that satisfy every named rule; a rule that is NULL is violated.

    ``metrics`` has one row per rule with passed and failed counts, from one
    pass over the input.
    """
    holds = {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    every = F.lit(True)
    for test in holds.values():
        every = every & test
    one_row = df.agg(*[
        F.struct(F.count_if(t).alias("passed"), F.count_if(~t).alias("failed")).alias(n)
        for n, t in holds.items()
    ])
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`.passed"), F.col(f"`{n}`.failed")) for n in holds
    ]))
    metrics = one_row.select(per_rule.alias("m")).select("m.*")
    return Expectations(df.filter(every), df.filter(~every), metrics)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate keys; empty when the key is unique."""
    return duplicates(df, keys)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count per column, one row per column."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one_row.unpivot([], list(cols), "column_name", "n_null")


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    p = parent.select(F.col(parent_key).alias("_parent"))
    return child.join(p, child[child_key] == p["_parent"], "left_anti").filter(
        F.col(child_key).isNotNull())


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest as text.

    Distinct values are estimated in one pass; ``exact_distinct`` counts them,
    for which every row is copied once per column.
    """
    count_distinct = F.count_distinct if exact_distinct else F.approx_count_distinct
    one_row = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            count_distinct(F.col(c)).alias("n_distinct"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
        ).alias(f"c{i}")
        for i, c in enumerate(df.columns)
    ])
    return one_row.select(F.explode(F.array(*one_row.columns)).alias("p")).select("p.*")
