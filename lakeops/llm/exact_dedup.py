"""Exact duplicates by a 128-bit content hash, with a comparison of the bytes.

Everything here is DataFrame operations. The texts cross the network once: rows
are grouped by hash *and* normalised text, so equal texts are merged in each
task before the shuffle (a hot group arrives as one row per task) and unequal
texts of one hash stay apart, byte for byte. All else moves hashes and ids only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import kept_rows, row_mark, stored

SPACE = r"[\x20\x09-\x0D]+"


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The group of equal texts of every row.

    Texts are equal when identical after deleting ASCII white space; null
    counts as empty, and all empty texts are one group. Of a group, the row with
    the most code points in the original text stays, then the one with the
    smallest id (a null id before all others). Returns one row per row:
    the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (of the
    normalised text in UTF-8). Rows that repeat an id with the same text have
    the same result. Only the two named columns are read. An empty table gives
    an empty result.
    """
    return _groups(docs, id_col, text_col, content_hash).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def _groups(docs: DataFrame, id_col: str, text_col: str, content_hash: Callable[[Column], Column]) -> DataFrame:
    original = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), row_mark(text_col).alias("_mark"), F.length(original).alias("_points"),
                       F.regexp_replace(original, SPACE, "").alias("_text"))
    rows = rows.withColumn("_hash", content_hash(F.col("_text")))
    best = F.min(F.struct((-F.col("_points")).alias("less"), F.col("_id").alias("id")))
    classes = rows.groupBy("_hash", "_text").agg(
        F.count(F.lit(1)).alias("group_size"), best.alias("_best"))
    shown = [F.col("_best.id").alias("keep_id"), "group_size", F.sha2("_text", 256).alias("text_sha256")]
    by_hash = stored(classes.select("_hash", *shown), "exact-classes")
    clashes = by_hash.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")

    ids = rows.select("_id", "_mark", "_hash")
    if clashes.isEmpty():
        found = ids.join(by_hash, "_hash")
    else:  # different texts with one hash: their rows are told apart by the texts themselves
        plain = ids.join(by_hash.join(clashes, "_hash", "left_anti"), "_hash")
        apart = rows.join(clashes, "_hash", "left_semi").join(
            classes.join(clashes, "_hash", "left_semi").select("_hash", "_text", *shown), ["_hash", "_text"])
        found = plain.unionByName(apart.select(*plain.columns))
    return found.withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id")))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with their own columns."""
    verdicts = _groups(docs, id_col, text_col, content_hash).select("_id", "_mark", "kept")
    return kept_rows(docs, verdicts, id_col, text_col)
