"""Date and time expressions. ``as_of`` always comes in as a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.columns import as_col


def day(value: Column | str) -> Column:
    """ISO text or Column to a DATE column."""
    return F.lit(value).cast("date") if isinstance(value, str) else value.cast("date")


def age_years(birth: Column | str, as_of: Column | str) -> Column:
    return F.floor(F.datediff(day(as_of), as_col(birth)) / 365.25).cast("int")


def age_band(birth: Column | str, as_of: Column | str, width: int) -> Column:
    """Lower end of the age band of the given width in years."""
    years = F.datediff(day(as_of), as_col(birth)) / 365.25
    return (F.floor(years / width) * width).cast("int")


def quarter_label(c: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_col(c)).cast("string"))


def weekday_number(c: Column | str) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(as_col(c)) - 1


def holiday_flag(c: Column | str, holidays: Sequence[str]) -> Column:
    return F.when(as_col(c).cast("string").isin(*holidays), 1).otherwise(0)


def fiscal_year(c: Column | str, start_month: int = 4) -> Column:
    """Year in which the fiscal year containing the date began."""
    return F.year(F.add_months(as_col(c), 1 - start_month))


def fiscal_quarter(c: Column | str, start_month: int = 4) -> Column:
    return F.quarter(F.add_months(as_col(c), 1 - start_month))


def fiscal_half(c: Column | str, start_month: int = 4) -> Column:
    return F.when(fiscal_quarter(c, start_month) <= 2, "H1").otherwise("H2")


def loose_timestamp(c: Column | str, fmt: str = "M/d/yy H:mm") -> Column:
    """``3/7/24 9:05`` and ``12/11/24 10:30`` alike; unreadable text is NULL."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def ordinal_date(c: Column | str) -> Column:
    """``19th July 2023`` to ISO text; NULL if unreadable."""
    plain = F.regexp_replace(as_col(c), r"(\d+)(st|nd|rd|th)", "$1")
    return F.date_format(F.try_to_timestamp(plain, F.lit("d MMMM yyyy")), "yyyy-MM-dd")


def month_text(c: Column | str) -> Column:
    """``July 2023`` to ``2023-07``; NULL if unreadable."""
    return F.date_format(F.try_to_timestamp(as_col(c), F.lit("MMMM yyyy")), "yyyy-MM")


def local_time(c: Column | str, zone: str = "Asia/Tokyo") -> Column:
    """UTC timestamp as wall-clock time of a zone."""
    return F.from_utc_timestamp(as_col(c), zone)
