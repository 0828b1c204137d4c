"""Type-1 change application on plain Parquet.

A target is a folder of change batches. Each micro-batch is reduced to its
newest row per key and written to ``batch=<id>``; writing a batch again
replaces it, so a retried batch changes nothing. The current state is the
newest row per key over all batches, and :func:`compact` folds old ones now and
then, so that a read does not go over the whole history. The sequence column is
kept in the files, hence a late record with an older sequence loses also across batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.windows import latest_per_key
from lakeops.session import work_dir


def write_changes(batch: DataFrame, batch_id: int, target: str, keys: Sequence[str],
                  sequence_by: str) -> None:
    """One batch of changes, idempotent by batch id."""
    newest = latest_per_key(batch, keys, [sequence_by], _tiebreak(batch, keys, sequence_by))
    newest.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")


def apply_changes(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str],
                  sequence_by: str) -> StreamingQuery:
    """Run the stream over everything available and apply it to the target."""
    query = (
        stream.writeStream
        .foreachBatch(lambda df, batch_id: write_changes(df, batch_id, target, keys, sequence_by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def current_state(spark: SparkSession, target: str, keys: Sequence[str], sequence_by: str,
                  except_cols: Sequence[str] = ()) -> DataFrame:
    """Newest row per key; ``except_cols`` are left out of the result."""
    log = spark.read.option("basePath", target).parquet(target).drop("batch")
    state = latest_per_key(log, keys, [sequence_by], _tiebreak(log, keys, sequence_by))
    return state.drop(*except_cols)


def compact(spark: SparkSession, target: str, keys: Sequence[str], sequence_by: str, upto: int) -> str:
    """Fold the batches up to ``upto`` of a target into one, in place.

    Batches after ``upto`` are not touched, so changes may go on arriving: name
    a batch that is complete. The folded batch gets a new id below all others and
    is complete before the batches it replaces are removed; a fold that was cut
    short leaves rows twice, which count once, and the next one completes it. A
    reader that has listed a removed batch already has to read again.
    """
    paths = [p for p in _batches(spark, target) if _batch_id(p) <= upto]
    if len(paths) < 2:
        return target
    log = spark.read.option("mergeSchema", True).parquet(*paths)
    newest = latest_per_key(log, keys, [sequence_by], _tiebreak(log, keys, sequence_by))
    newest.write.parquet(f"{target}/batch={min(0, *map(_batch_id, paths)) - 1}")
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return target


def _batches(spark: SparkSession, target: str) -> list[str]:
    """Folders of the batches of a target; their number is bounded by folding now and then."""
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [f.getPath().toString() for f in found if "/batch=" in f.getPath().toString()]


def _batch_id(path: str) -> int:
    return int(path.rsplit("batch=", 1)[1])


def refresh(df: DataFrame, out: str | None = None) -> DataFrame:
    """Write a derived table in full and read it back."""
    spark = df.sparkSession
    path = out or work_dir(spark, "refresh")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _tiebreak(df: DataFrame, keys: Sequence[str], sequence_by: str) -> list[str]:
    """Equal sequences are settled by the remaining columns, in column order."""
    simple = {"string", "date", "timestamp", "timestamp_ntz", "boolean"}
    return [n for n, t in df.dtypes
            if n not in keys and n != sequence_by and (t in simple or t.startswith(("int", "bigint", "double", "float", "decimal", "smallint", "tinyint")))]
