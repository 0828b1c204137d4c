"""Silver masters and logs: one projection per bronze table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import flag, status_code
from lakeops.functions.dates import day
from lakeops.operators.clean import project


def silver_master(bronze: DataFrame, keep: Sequence[str] = (), dates: Mapping[str, str] | None = None,
                  flags: Sequence[str] = (), codes: Mapping[str, Mapping[str, int]] | None = None,
                  more: Mapping[str, Column] | None = None, distinct: bool = False) -> DataFrame:
    """Columns kept as they are, times as dates (``{new: old}``), booleans as 0/1
    (null: 0), status texts as codes (others: 0) and further expressions."""
    spec: dict[str, Column | str] = {c: F.col(c) for c in keep}
    spec |= {new: F.to_date(old) for new, old in (dates or {}).items()}
    spec |= {c: flag(c) for c in flags}
    spec |= {c: status_code(c, mapping) for c, mapping in (codes or {}).items()}
    out = project(bronze, spec | dict(more or {}))
    return out.distinct() if distinct else out


def age_columns(birth_date: str, as_of: str) -> dict[str, Column]:
    """Age in years of 365.25 days, and its bands of five and ten years."""
    years = F.datediff(day(as_of), F.col(birth_date)) / 365.25
    return {"age": F.floor(years).cast("int"), "age_group_5": (F.floor(years / 5) * 5).cast("int"),
            "age_group_10": (F.floor(years / 10) * 10).cast("int")}
