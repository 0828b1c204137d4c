"""Projections, filters and whole-frame cleansing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _expr(e: Column | str) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Select ``{new name: expression}``."""
    return df.select(*[_expr(e).alias(name) for name, e in spec.items()])


def select_except(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def derive(df: DataFrame, steps: Sequence[tuple[str, Column | str]]) -> DataFrame:
    """Add columns one after the other; later ones may use earlier ones."""
    for name, e in steps:
        df = df.withColumn(name, _expr(e))
    return df


def clean_names(df: DataFrame) -> DataFrame:
    """Column names without blanks; ``(`` becomes ``-`` and ``)`` goes."""
    return df.toDF(*[re.sub(r"\s|\)", "", n).replace("(", "-") for n in df.columns])


def cast_to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Bring the named columns to the schema's types; unreadable values are NULL.

    Columns the schema does not name pass through unchanged.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        F.col(n).try_cast(types[n]).alias(n) if n in types else F.col(n) for n in df.columns
    ])


def optional_filter(df: DataFrame, wanted: Mapping[str, Any]) -> DataFrame:
    """Equality filters for those parameters that were given."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def active_only(df: DataFrame, cancel_flag: str) -> DataFrame:
    """Rows known not to be cancelled; an unknown state does not pass."""
    return df.filter(~F.col(cancel_flag))


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols else None)


def latest_partition(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date, by a scalar subquery."""
    newest = df.agg(F.max(date_col).alias("newest")).scalar()
    return df.filter(F.col(date_col) == newest)


def update_where(df: DataFrame, predicate: Column | str,
                 assignments: Mapping[str, Column | str]) -> DataFrame:
    """The frame after ``UPDATE … SET … WHERE predicate``."""
    hit = F.coalesce(_expr(predicate), F.lit(False))
    return df.withColumns({
        name: F.when(hit, _expr(e)).otherwise(F.col(name)) for name, e in assignments.items()
    })


def suspicious_text(df: DataFrame, col: str, marker: str = " -") -> DataFrame:
    """Rows whose text holds a marker that only noise has."""
    return df.filter(F.col(col).contains(marker))
