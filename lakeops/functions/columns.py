"""Cleansing, mapping, binning, masking and money expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money -----------------------------------------------------------------


def cents(amount: Column | str) -> Column:
    """Amount as a whole number of cents, so that sums do not depend on order."""
    return F.rint(as_col(amount) * 100).cast("bigint")


def money_sum(amount: Column | str, when: Column | None = None) -> Column:
    """Exact sum of a money column as DOUBLE; 0 for groups with no matching row
    when a condition is given."""
    if when is None:
        return F.sum(cents(amount)) / F.lit(100.0)
    return F.sum(F.when(when, cents(amount)).otherwise(F.lit(0))) / F.lit(100.0)


def safe_div(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """``num / den``; ``default`` where the denominator is zero or null."""
    quotient = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


# --- flags and mappings ----------------------------------------------------


def flag(c: Column | str) -> Column:
    """Boolean to 0/1, null counts as 0."""
    return F.coalesce(as_col(c).cast("int"), F.lit(0))


def status_code(c: Column | str, mapping: Mapping[str, int], default: int = 0) -> Column:
    """Status text to an integer code."""
    out = None
    for text, code in mapping.items():
        test = as_col(c) == text
        out = F.when(test, code) if out is None else out.when(test, code)
    return F.lit(default) if out is None else out.otherwise(default)


def map_values(c: Column | str, mapping: Mapping[str, str], default: str | None = "") -> Column:
    """Look a value up in a small fixed mapping."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), as_col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str],
              right_closed: bool = False) -> Column:
    """Label by upper edge; the last label takes everything left, nulls included.

    ``right_closed`` compares with ``<=`` in place of ``<``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = as_col(c)
    out = None
    for edge, label in zip(edges, labels):
        test = value <= edge if right_closed else value < edge
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(labels[-1]) if out is None else out.otherwise(labels[-1])


def ranges_label(c: Column | str, ranges: Sequence[tuple[float, float | None, str]],
                 default: str, half_open: bool = False) -> Column:
    """Label by a list of ``(low, high, label)``; gaps fall to ``default``."""
    value = as_col(c)
    out = None
    for low, high, label in ranges:
        test = value >= low
        if high is not None:
            test = test & ((value < high) if half_open else (value <= high))
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(default) if out is None else out.otherwise(default)


# --- dirty text ------------------------------------------------------------

SENTINELS = ("", "N/A", "null")


def clean_text(c: Column | str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Trim, and turn placeholder words into NULL."""
    trimmed = F.trim(as_col(c))
    return F.when(~trimmed.isin(*sentinels), trimmed)


def clean_numeric(c: Column | str, dtype: str = "double",
                  sentinels: Sequence[str] = SENTINELS) -> Column:
    """Number from dirty text; anything unreadable is NULL, never an error."""
    return clean_text(c, sentinels).try_cast(dtype)


def to_score(c: Column | str) -> Column:
    """Text to a score in [0, 1]; unreadable text is NULL."""
    number = F.trim(as_col(c)).try_cast("double")
    inside = F.when(number < 0, F.lit(0.0)).when(number > 1, F.lit(1.0)).otherwise(number)
    return F.when(~F.isnan(number), inside)


def missing_to_dash(c: Column | str, marker: str = " -") -> Column:
    """Missing result to '-'; a result with the marker inside is noise, also '-'."""
    text = F.coalesce(as_col(c), F.lit("-"))
    return F.when(text.contains(marker), F.lit("-")).otherwise(text)


def base64_text(c: Column | str) -> Column:
    """Base64 on one line; Spark breaks long output into lines of 76 characters."""
    return F.translate(F.base64(as_col(c)), "\r\n", "")


# --- masking ---------------------------------------------------------------


def mask_email(c: Column | str, privileged: bool) -> Column:
    """Full address for privileged readers, a fixed stand-in for others."""
    return as_col(c) if privileged else F.lit("***@example.com")


def mask_hash(c: Column | str, privileged: bool) -> Column:
    return as_col(c) if privileged else F.sha2(as_col(c).cast("string"), 256)


def mask_encrypt(c: Column | str, key: str, protect: bool, mode: str = "GCM") -> Column:
    """Base64 of the AES-encrypted text for readers who must not see it."""
    value = as_col(c)
    if not protect:
        return value
    padding = "PKCS" if mode == "ECB" else "DEFAULT"
    return base64_text(F.aes_encrypt(value.cast("binary"), F.lit(key).cast("binary"),
                                     F.lit(mode), F.lit(padding)))


# --- repeatable sampling ---------------------------------------------------


def unit_hash(c: Column | str, seed: int | str = 0) -> Column:
    """Repeatable number in [0, 1) per key; same key, same value, on any cluster."""
    digest = F.md5(F.concat_ws("#", as_col(c).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
