"""Upserts on Parquet tables and state rebuilt from a change log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.null_safe import null_safe_join
from lakeops.operators.windows import latest_per_key
from lakeops.session import checkpointed, work_dir
from lakeops.sources.writers import write_table


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           set_cols: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Target after a MERGE: matched rows updated, unmatched ones inserted.

    ``set_cols`` maps target columns to source expressions; by default every
    target column takes the source column of its name. Target columns left out
    keep their old value on update and are NULL on insert. The source keys must
    be unique, as MERGE demands. The source is computed once, into a reliable
    checkpoint that the check and the join both read; one full outer join does
    update and insert together. NULL keys match nothing, so such rows are
    inserted.
    """
    if set_cols is None:
        set_cols = {c: c for c in target.columns if c not in keys and c in source.columns}
    exprs = {n: F.expr(e) if isinstance(e, str) else e for n, e in set_cols.items()}
    new = checkpointed(source.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                                     *[e.alias(f"_s_{n}") for n, e in exprs.items()]))
    per_key = new.groupBy(*[f"_k_{k}" for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    if not per_key.filter("n > 1").isEmpty():
        raise ValueError(f"source has duplicate keys in {list(keys)}")
    same_key = reduce(lambda a, b: a & b, [target[k] == new[f"_k_{k}"] for k in keys])
    joined = target.join(new.withColumn("_in_source", F.lit(True)), same_key, "full_outer")
    hit, out = F.col("_in_source").isNotNull(), []
    for c in target.columns:
        dtype = target.schema[c].dataType
        if c in keys:
            out.append(F.when(hit, F.col(f"_k_{c}")).otherwise(F.col(c)).cast(dtype).alias(c))
        elif c in exprs:
            out.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).cast(dtype).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 partition_by: str, set_cols: Mapping[str, Column | str] | None = None) -> DataFrame:
    """MERGE into a partitioned Parquet table, rewriting only touched partitions.

    ``partition_by`` must be one of the keys, so a row cannot change partition.
    The partition of NULL is a partition like others: its old rows are kept. The
    merged partitions are staged in the shared folder first: no plan writes to a
    path it reads.
    """
    if partition_by not in keys:
        raise ValueError("the partition column has to be part of the key")
    target = spark.read.parquet(path)
    touched = source.select(partition_by).distinct()
    affected = null_safe_join(target, touched, [partition_by], "left_semi").select(*target.columns)
    merged = upsert(affected, source, keys, set_cols)
    staged = write_table(merged, work_dir(spark, "upsert"))
    return write_table(staged.select(*target.columns), path, partition_by=[partition_by], dynamic=True)


def state_as_of(change_log: DataFrame, keys: Sequence[str], seq: str, version,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Table state after all changes up to and including ``version``."""
    return latest_per_key(change_log.filter(F.col(seq) <= F.lit(version)), keys, [seq], tiebreak)
