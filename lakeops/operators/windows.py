"""Window operators.

Filters on ``row_number``/``rank`` are written so that Spark places a
WindowGroupLimit before the shuffle: each task forwards at most the wanted
rows per group, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.null_safe import null_safe_join
from lakeops.operators.numbering import MAX_GROUP_ROWS, fits_one_task


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group; end ``order`` with a unique column."""
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(Window.partitionBy(*group).orderBy(*_cols(order))))
    out = out.filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; null order values lose."""
    newest = [F.col(c).desc_nulls_last() for c in [*order, *tiebreak]]
    return top_n(df, keys, newest, 1)


def rank_best(df: DataFrame, group: Sequence[str], by: str, descending: bool = False,
              rank_col: str = "rnk") -> DataFrame:
    """Rows of rank 1, all ties kept; a null value wins only where there is no other.

    The best value of a group is an aggregate and its rows are found by a join,
    so the ties of a hot group are never sorted in one task.
    """
    best = df.groupBy(*group).agg((F.max if descending else F.min)(by).alias(by))
    return null_safe_join(df, best, [*group, by], "left_semi").withColumn(rank_col, F.lit(1))


def ranked_totals(totals: DataFrame, order: Sequence[Column | str], n: int,
                  rank_col: str = "row_num") -> DataFrame:
    """Best ``n`` rows of an aggregate with their global rank.

    Sort and limit come first (a distributed top-k), so the one-task window
    numbers only the ``n`` rows that are left.
    """
    best = totals.orderBy(*_cols(order)).limit(n)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*_cols(order))))


def rolling(df: DataFrame, keys: Sequence[str], order: str,
            measures: Mapping[str, Column], n: int = 7) -> DataFrame:
    """Aggregates over the current and the ``n - 1`` rows before it.

    Meant for series that hold one row per key and period: a key then has as
    many rows as there are periods, however much data lies behind them.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumns({name: agg.over(w) for name, agg in measures.items()})


def cumulative_share(dist: DataFrame, order: str, share: str, name: str = "cumulative_share") -> DataFrame:
    """Running total of a share, over a distribution (a few labelled rows)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return dist.withColumn(name, F.sum(share).over(w))


def repeat_purchase(df: DataFrame, keys: Sequence[str], date: str, tiebreak: Sequence[str],
                    max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Repeat flag and days since the previous purchase of the same item.

    Where groups fit one task (measured by a narrow count), one window does it. Otherwise
    only dates go through the window: a row per key and date carries the date
    before it and the first line of the date. Later lines of a date have that
    date itself as their predecessor. Both give the same rows; ``tiebreak`` must be unique within a date. Null users,
    items and dates are values like others; a null date has no predecessor and is none.
    """
    if fits_one_task(df.select(*keys), keys, max_group_rows):
        lines = df.withColumn("_prev", F.lag(date).over(Window.partitionBy(*keys).orderBy(date, *tiebreak)))
        return lines.select(*df.columns, F.col("_prev").isNotNull().alias("is_repeat_purchase"),
                            F.datediff(F.col(date), F.col("_prev")).alias("days_since_last_purchase"))
    line = F.struct(*[F.col(c) for c in tiebreak])
    by_day = df.groupBy(*keys, date).agg(F.min(line).alias("_first_line"))
    by_day = by_day.withColumn("_before", F.lag(date).over(Window.partitionBy(*keys).orderBy(date)))
    first = line.eqNullSafe(F.col("_first_line"))
    out = null_safe_join(df, by_day, [*keys, date], "left").withColumn(
        "_prev", F.when(first, F.col("_before")).otherwise(F.col(date)))
    return out.select(*df.columns, F.col("_prev").isNotNull().alias("is_repeat_purchase"),
                      F.datediff(F.col(date), F.col("_prev")).alias("days_since_last_purchase"))
