"""The operators of this subpackage as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import ann, bpe, exact_dedup, html_text, langid, line_dedup, mixing, packing, periodic, quality, simhash, variants, warc
from lakeops.llm.common import held_out

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


@_query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), least_revisit_bytes=0)


@_query
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@_query
def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out("doc_id", 4, 2)
    return langid.identify(_table(spark, sf_dir, "documents"), ~out, out)


@_query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@_query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("repeats")


@_query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(norm) AS text_sha256
FROM rows
WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""


@_query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out("doc_id", 5, 0), threshold=0.3)


@_query
def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"), plant=True)


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"), delete_every=31)


@_query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_lines(_table(spark, sf_dir, "documents"))


ORACLES["op13_line_dedup"] = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, row_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
marked AS (SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row_id
"""
