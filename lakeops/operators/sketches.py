"""Sketch columns: distinct counts, quantiles and frequent values that merge.

A mart keeps one sketch per fine group, from one pass without a row copy per
count. Coarser groups, other periods and set operations are merges of sketches; the rows are
not read again. Sketches have a fixed size, so a hot group is as large as any other,
and partial sketches are merged before the shuffle. Every estimate has a stated error bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12  # a distinct sketch keeps 2**LG_K hashes and is exact up to as many values
KLL_K = 400
TRACKED = 1000  # values of a frequency sketch


def distinct_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Relative error of a distinct count that is passed once in 370 times (three sigmas)."""
    return sigmas / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Error of the rank of a quantile, as a share of the rows, that is passed once in 100 times.

    Fixed value: the fitted error formula of this kind of sketch.
    """
    return 2.296 / k ** 0.9021


def count_error(tracked: int = TRACKED) -> float:
    """Largest error of the count of a value, as a share of all rows. Never passed.

    The sketch holds its values in a table of a power of two of places, filled to three quarters.
    """
    places = 2 ** max(3, int(-(-log2(tracked / 0.75) // 1)))
    return 3.5 / places


def distinct_mart(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """Per group one sketch for each named column, and ``n_rows``. Nulls are not counted."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.theta_sketch_agg(F.col(c), lg_k).alias(name) for name, c in counted.items()])


def merge_distinct(mart: DataFrame, keys: Sequence[str], names: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """The mart for coarser groups."""
    return mart.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *[F.theta_union_agg(F.col(n), lg_k).alias(n) for n in names])


def distinct_counts(mart: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sketches replaced by their estimates."""
    return mart.withColumns({n: F.theta_sketch_estimate(F.col(n)) for n in names})


def set_counts(a: Column, b: Column) -> dict[str, Column]:
    """Distinct values in either, in both, and in the first only. The error is relative to those in either."""
    return {"either": F.theta_sketch_estimate(F.theta_union(a, b)), "both": F.theta_sketch_estimate(F.theta_intersection(a, b)),
            "first_only": F.theta_sketch_estimate(F.theta_difference(a, b))}


def quantile_mart(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], k: int = KLL_K) -> DataFrame:
    """Per group one quantile sketch for each named measure. Nulls are left out."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(name) for name, c in measures.items()])


def merge_quantiles(mart: DataFrame, keys: Sequence[str], names: Sequence[str], k: int = KLL_K) -> DataFrame:
    return mart.groupBy(*keys).agg(*[F.kll_merge_agg_double(F.col(n), k).alias(n) for n in names])


def quantiles(sketch: Column, shares: Sequence[float]) -> Column:
    """Values at the given shares of the rows; null for a sketch without a row."""
    has_rows = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(has_rows, F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(s))) for s in shares]))


def frequent_mart(df: DataFrame, keys: Sequence[str], value: str, tracked: int = TRACKED, name: str = "frequent") -> DataFrame:
    """Per group counters of its frequent values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.expr(f"approx_top_k_accumulate(`{value}`, {int(tracked)})").alias(name))


def merge_frequent(mart: DataFrame, keys: Sequence[str], tracked: int = TRACKED, name: str = "frequent") -> DataFrame:
    return mart.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.expr(f"approx_top_k_combine(`{name}`, {int(tracked)})").alias(name))


def frequent_values(mart: DataFrame, k: int, name: str = "frequent") -> DataFrame:
    """The ``k`` most frequent values of each group as rows, with their estimated counts."""
    keys = [c for c in mart.columns if c != name]
    return mart.select(*keys, F.inline(F.expr(f"approx_top_k_estimate(`{name}`, {int(k)})")))
