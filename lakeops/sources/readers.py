"""Batch readers for text, binary and table sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.columns import base64_text


def read_csv(spark: SparkSession, path: str, infer: bool = True, **options) -> DataFrame:
    """CSV with a header line; types inferred unless ``infer`` is off."""
    return spark.read.options(header=True, inferSchema=infer, **options).csv(path)


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  **options) -> DataFrame:
    """CSV whose quoted fields may hold commas, quotes and line breaks, for small files: one task reads each.

    Large files are read by ``quoted_csv.read_quoted_csv``.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"', **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType | str,
                    header: bool = False, **options) -> DataFrame:
    """CSV read with a declared schema (StructType or DDL text)."""
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def with_rescued(raw: DataFrame, schema: T.StructType | str, column: str = "_rescued_data") -> DataFrame:
    """Type an all-text frame; what does not fit is kept as JSON in one column.

    Values that cannot be read as the declared type, and columns the schema
    does not name, go into ``column``; it is NULL for clean rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    wanted = {f.name: f.dataType for f in schema.fields}
    typed, misfits = [], []
    for name, dtype in wanted.items():
        if name not in raw.columns:
            typed.append(F.lit(None).cast(dtype).alias(name))
            continue
        value = F.col(name).try_cast(dtype)
        typed.append(value.alias(name))
        misfits.append((name, F.when(F.col(name).isNotNull() & value.isNull(), F.col(name))))
    misfits += [(name, F.col(name)) for name in raw.columns if name not in wanted]
    rescued = F.lit(None).cast("string")
    if misfits:
        any_bad = F.coalesce(*[m for _, m in misfits]).isNotNull()
        rescued = F.when(any_bad, F.to_json(F.struct(*[m.alias(n) for n, m in misfits])))
    return raw.select(*typed, rescued.alias(column))


def read_binary_b64(spark: SparkSession, paths: str | Sequence[str], strip: str = "^file:") -> DataFrame:
    """Files as base64 text, keyed by their path without the scheme."""
    return (
        spark.read.format("binaryFile").load(paths)
        .select(F.regexp_replace("path", strip, "").alias("path"),
                base64_text("content").alias("content_b64"))
    )


def sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text with ``{name}`` placeholders bound to DataFrames."""
    return spark.sql(text, **frames)


def rows(spark: SparkSession, data: Iterable, schema) -> DataFrame:
    """Literal rows as a DataFrame."""
    return spark.createDataFrame(data, schema)


def spine(spark: SparkSession, n: int, name: str = "id", start: int = 0) -> DataFrame:
    """``n`` consecutive ids, produced on the executors."""
    return spark.range(start, start + n).withColumnRenamed("id", name)
