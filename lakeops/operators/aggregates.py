"""Aggregation operators. All rely on partial aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.null_safe import null_safe_join


def cond_agg(df: DataFrame, keys: Sequence[str], specs: Mapping[str, Column]) -> DataFrame:
    """Group once and compute every named (conditional) aggregate."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in specs.items()])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def distribution(df: DataFrame, cols: Sequence[str] | str, count_col: str = "n",
                 share_col: str = "share") -> DataFrame:
    """Count per value and its share of all rows (percent)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
    return share_of_total(counts, count_col, share_col)


def share_of_total(df: DataFrame, measure: str, share_col: str = "share") -> DataFrame:
    """Measure in percent of its total; the total is a scalar subquery."""
    total = df.agg(F.sum(measure).alias("total")).scalar()
    return df.withColumn(share_col, F.col(measure) * F.lit(100.0) / total)


def rates(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Share of rows for which each predicate holds (null counts as no)."""
    hit = {n: F.coalesce(p, F.lit(False)).cast("int") for n, p in predicates.items()}
    return df.agg(*[(F.sum(h) / F.count(F.lit(1))).alias(n) for n, h in hit.items()])


def bounds(df: DataFrame, col: str) -> DataFrame:
    """Smallest and largest value and the row count, as one row."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"),
                  F.count(F.lit(1)).alias("n_rows"))


def count_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur how often."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
    return per_key.groupBy("occurrences").agg(F.count(F.lit(1)).alias("n_keys"))


def accuracy_alert(df: DataFrame, pred: str, label: str, threshold: float = 0.8) -> DataFrame:
    """Share of right predictions and whether it fell below the threshold."""
    right = F.sum((F.col(pred) == F.col(label)).cast("int"))
    return (
        df.agg(F.count(F.lit(1)).alias("n"), right.cast("bigint").alias("n_right"))
        .withColumn("accuracy", F.col("n_right") / F.col("n"))
        .withColumn("alert", F.col("accuracy") < threshold)
    )


def _bytes_of(value: Column, dtype: T.DataType) -> Column:
    """Rough size of a value: 16 bytes per field, plus the length of its text."""
    if isinstance(dtype, T.StructType):
        total = F.lit(0)
        for f in dtype.fields:
            total = total + _bytes_of(value[f.name], f.dataType)
        return total
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.octet_length(F.to_json(F.struct(value))) + 16
    return F.lit(16)


def collect_parts(df: DataFrame, keys: Sequence[str], value: Column, row_id: Sequence[str],
                  max_bytes: int = 32 << 20, name: str = "items") -> DataFrame:
    """Group members as sorted lists, one row per group and ``part``.

    A group has as many parts as its own size asks for, one for every
    ``max_bytes`` begun, numbered from 0; members are dealt to them by a hash of
    ``row_id``. The grain is the same at every size, no member is left out, and
    no task or cell has to hold a whole hot group. Figures of the whole group
    belong in a table of their own.
    """
    members = df.select(*keys, F.xxhash64(*row_id).alias("_h"), value.alias("_value"))
    size = _bytes_of(F.col("_value"), members.schema["_value"].dataType)
    parts = F.greatest(F.ceil(F.sum(size) / F.lit(float(max_bytes))), F.lit(1)).cast("bigint")
    sized = null_safe_join(members, members.groupBy(*keys).agg(parts.alias("_parts")), keys, "inner")
    return sized.groupBy(*keys, F.pmod("_h", "_parts").alias("part")).agg(
        F.sort_array(F.collect_list("_value")).alias(name))


def concat_group(df: DataFrame, keys: Sequence[str], text: str, row_id: Sequence[str],
                 sep: str = " ", max_bytes: int = 32 << 20, name: str = "text") -> DataFrame:
    """Texts of a group joined in sorted order, in parts like :func:`collect_parts`."""
    parts = collect_parts(df, keys, F.col(text), row_id, max_bytes, "_list")
    return parts.withColumn(name, F.array_join("_list", sep)).drop("_list")
