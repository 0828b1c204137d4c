"""Row numbers and neighbours, for groups of any size.

``row_number()`` and ``lead()`` over a window send every row of a group to one
task, and a group may hold a third of all rows. The functions here therefore
measure the largest group first (one narrow aggregate). Up to a limit they use
the window; above it they range-partition by group and order: a big group is
then spread over many slices, and what crosses a slice border is settled on one
summary row per slice. The slices are kept by a reliable checkpoint, so that a
lost executor, or a second branch of the plan, sees the same borders.

The order must be total (end it with a unique column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import checkpointed
from lakeops.sources.writers import with_known_size

MAX_GROUP_ROWS = 2_000_000  # rows of one group that one task may sort
_SLICE_BITS = 33  # monotonically_increasing_id(): slice number above, position below


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; one number comes to the driver."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def fits_one_task(df: DataFrame, keys: Sequence[str], max_group_rows: int) -> bool:
    """Whether no group has more rows than one task may sort.

    Rows per first key are an upper bound and cheap to count (few groups, so
    the partial aggregate does the work); all keys are counted only if needed.
    """
    if largest_group(df, keys[:1]) <= max_group_rows:
        return True
    return len(keys) > 1 and largest_group(df, keys) <= max_group_rows


def sliced(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows sorted by group and order, with ``_pos`` and ``_slice``."""
    keys = [*group, *order]
    ranged = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return checkpointed(ranged).withColumn("_slice", F.shiftright("_pos", _SLICE_BITS))


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                name: str = "rn", max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """``row_number()`` within the group. With an empty group the whole frame is
    numbered 1…n without gaps, always by slices."""
    if group and fits_one_task(df, group, max_group_rows):
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    rows = sliced(df, group, order)
    pieces = rows.groupBy("_slice", *group).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per slice and group: this window sees summaries, not data rows.
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if not group:  # a few rows; once stored their size is known, and the data rows are not shuffled to meet them
        pieces = with_known_size(pieces)
    p = pieces.select(F.col("_slice").alias("_s"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                      "_first", "_before")
    on = rows["_slice"] == p["_s"]
    for i, g in enumerate(group):
        on = on & rows[g].eqNullSafe(p[f"_g{i}"])
    return (
        rows.join(p, on)
        .withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
        .select(*df.columns, name)
    )


def following_pairs(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                    max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Counts of (value, next value) over neighbouring rows of a group."""
    narrow = df.select(*dict.fromkeys([*group, *order, value]))
    if fits_one_task(narrow, group, max_group_rows):
        following = F.lead(F.struct(value)).over(Window.partitionBy(*group).orderBy(*order))
        pairs = narrow.select(F.col(value).alias("source"), following.alias("_next")).filter("_next IS NOT NULL")
        return pairs.groupBy("source", F.col(f"_next.{value}").alias("target")).agg(
            F.count(F.lit(1)).alias("weight"))
    rows = sliced(narrow, group, order)
    here = F.struct(*[F.col(g) for g in group], F.col(value).alias("_v")).alias("_here")
    rows = rows.select("_slice", "_pos", here)
    in_slice = Window.partitionBy("_slice").orderBy("_pos")
    inside = rows.select("_here", F.lead("_here").over(in_slice).alias("_next"))
    # Across a border: last row of a slice with the first row of the next one.
    ends = rows.groupBy("_slice").agg(
        F.min_by("_here", "_pos").alias("_head"), F.max_by("_here", "_pos").alias("_tail"))
    across = ends.select(F.col("_tail").alias("_here"),
                         F.lead("_head").over(Window.orderBy("_slice")).alias("_next"))
    same = F.col("_next").isNotNull()
    for g in group:
        same = same & F.col(f"_here.{g}").eqNullSafe(F.col(f"_next.{g}"))
    return (
        inside.unionByName(across).filter(same)
        .groupBy(F.col("_here._v").alias("source"), F.col("_next._v").alias("target"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def surrogate_key(df: DataFrame, order: Sequence[Column | str], name: str = "id") -> DataFrame:
    """Dense ids 1…n in the given order."""
    return number_rows(df, [], order, name)
