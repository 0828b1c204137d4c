"""What the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import work_dir

ROWS_AT_ONCE = 256
ASCII_SPACE = " \t\n\x0b\x0c\r"


def map_rows(df: DataFrame, schema: str, names: list[str], make: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """One output row per input row, through Arrow batches.

    ``make`` runs once per task and returns a function from the values of a row
    to the tuple of output values. ``names`` are the output columns in order.
    """
    arrow = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = [one(*values) for values in zip(*[c.to_pylist() for c in part.columns])]
                yield as_batch(rows, names, arrow)

    return df.mapInArrow(run, schema)


def as_batch(rows: list[tuple], names: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    """Rows as an Arrow batch of the given schema."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=arrow.field(n).type) for n, c in zip(names, columns)], schema=arrow)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def arrow_schema(schema: str) -> pa.Schema:
    return _arrow_schema(None, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet in the shared folder and read again.

    Later branches read the same rows even if an executor is lost meanwhile.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_mark(text_col: str) -> Column:
    """With the id, tells rows apart that repeat an id with another text."""
    return F.xxhash64(F.col(text_col))


def kept_rows(docs: DataFrame, verdicts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` that a deduplication keeps, with their own columns.

    ``verdicts`` has one row per row of ``docs``: ``_id``, ``_mark`` and ``kept``.
    Of rows that repeat both id and text, one stays.
    """
    verdicts = stored(verdicts, "verdicts")

    def row_is(other: DataFrame):
        return docs[id_col].eqNullSafe(other["_id"]) & (F.xxhash64(docs[text_col]) == other["_mark"])

    # Written, so that Spark knows its size when it plans the join with the texts.
    dropped = stored(verdicts.filter(~F.col("kept")).select("_id", "_mark").distinct(), "dropped")
    out = docs.join(dropped, row_is(dropped), "left_anti")
    again = verdicts.filter("kept").groupBy("_id", "_mark").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if again.isEmpty():
        return out
    single = docs.join(dropped, row_is(dropped), "left_anti").join(again, row_is(again), "left_anti")
    repeated = docs.join(again, row_is(again), "left_semi").dropDuplicates([id_col, text_col])
    return single.unionByName(repeated)


def file_system(uri: str):
    """pyarrow file system and path for a URI or a plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def held_out(column: str, buckets: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; null ids are held out."""
    here = F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(buckets)) == remainder
    return F.coalesce(here, F.lit(True))
