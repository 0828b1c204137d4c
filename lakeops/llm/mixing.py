"""Mix sources to target weights by capped water-filling.

Sources share a budget by weight. A source whose share is above its cap (its
words times the maximum of epochs) is clamped there, and the excess goes to the
others by weight, until no share is above its cap. That fixes the water level, the
share per unit of weight: sources with a smaller cap per weight are clamped. It is found by sums over
ranges of the cap per weight, from coarse to fine, so the number of jobs does not
grow with the sources. A target is then taken as whole repetitions of all documents of the
source and one more of some of them: those with the smallest seeded hashes, up
to the one that comes nearest to the target. That threshold, too, is found by sums
over ranges of hashes, so no source is ever sorted. Rows equal in id and text
are numbered, and the number goes into the hash: they are taken one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import stored
from lakeops.operators.numbering import number_rows

WORD = r"[^\x20\x09-\x0D]+"
_HASH_BITS = 48
_LEVEL_BITS = 12  # a level sums at most 2**12 ranges per source


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def water_level(sources: DataFrame, total: float) -> float | None:
    """Share per unit of weight at which the capped shares sum up to ``total``; None if all are clamped.

    ``sources`` has ``cap`` and ``weight``. Each round brings at most 2**12 sums to the driver and narrows the range
    of caps per weight by that factor.
    """
    rows = sources.filter("weight > 0").withColumn("ratio", F.col("cap") / F.col("weight"))
    low, high, all_caps, free = rows.agg(F.min("ratio"), F.max("ratio"), F.sum("cap"), F.sum("weight")).first()
    if low is None or total >= all_caps:
        return None
    clamped = 0.0  # caps of the sources below the range; ``free``: weights from the range on
    while low < high:
        step = (high - low) / (1 << _LEVEL_BITS)
        at = F.least(F.floor((F.col("ratio") - low) / step), F.lit((1 << _LEVEL_BITS) - 1))
        sums = rows.filter(F.col("ratio").between(low, high)).groupBy(at.alias("at")).agg(
            F.sum("cap").alias("cap"), F.sum("weight").alias("weight"), F.min("ratio").alias("low"), F.max("ratio").alias("high"))
        for r in sums.orderBy("at").collect():
            if clamped + r["low"] * free >= total:  # the level is below all of this range
                return (total - clamped) / free
            if clamped + r["cap"] + r["high"] * (free - r["weight"]) >= total:
                low, high = r["low"], r["high"]
                break
            clamped, free = clamped + r["cap"], free - r["weight"]
        else:
            return None
    return (total - clamped) / free


def targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``target`` of each source, from its ``source_size`` and ``weight``.

    ``sources`` must be stored: it is read a few times.
    """
    cap, weight = F.col("source_size") * F.lit(float(max_epochs)), F.col("weight")
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = water_level(sources.select(cap.alias("cap"), "weight"), total)
    if level is None:
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(weight * F.lit(level), cap))


def thresholds(facts: DataFrame, needed: DataFrame) -> DataFrame:
    """Largest hash to take per source, so that the sizes come nearest to ``need``.

    ``facts``: source, size and hash ``h``; ``needed``: source and need (null
    sources are marked by ``source_key``). Adds ``limit``; -1 takes none.
    """
    state = needed.select("source_key", F.col("need").cast("double").alias("need"), F.lit(0).cast("bigint").alias("prefix"))
    state = state.withColumn("range_size", F.lit(0).cast("bigint"))
    for shift in range(_HASH_BITS - _LEVEL_BITS, -1, -_LEVEL_BITS):
        here = facts.join(state, "source_key").filter(F.shiftright("h", shift + _LEVEL_BITS) == F.col("prefix"))
        sums = here.groupBy("source_key", "need", F.shiftright("h", shift).alias("range")).agg(F.sum("size").alias("size"))
        upto = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("size").over(upto))
        # The range in which the need is met: all before it are taken whole.
        crossing = sums.filter(F.col("upto") >= F.col("need")).groupBy("source_key").agg(
            F.min(F.struct("range", F.col("size").alias("range_size"), "upto", "need")).alias("_")).select("source_key", "_.*")
        state = stored(crossing.select(
            "source_key", (F.col("need") - (F.col("upto") - F.col("range_size"))).alias("need"),
            F.col("range").alias("prefix"), "range_size"), "mix-level")
    # One hash is left; it is taken if that comes nearer to the need than leaving it.
    last = F.when(F.col("need") * 2 >= F.col("range_size"), F.col("prefix")).otherwise(F.col("prefix") - 1)
    return state.select("source_key", last.alias("limit"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every row.

    Size is the number of words between ASCII white space (null text: 0).
    Sources in order of code points, null last as a source of its own, get
    ``weights`` in turn and share ``share`` times all words; no target exceeds
    ``max_epochs`` times the words of its source. Returns the id, ``size``,
    ``source_size``, ``target`` (of the row's source), ``repeats`` (times the
    row is taken) and ``taken`` (words, repeats counted). The same rows and seed
    give the same result, in any partitioning; of rows equal in id and text
    some may be taken more often than others. An empty table gives an empty result.
    """
    facts, by_source = _plan(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    out = facts.join(by_source, "source_key")
    repeats = (F.col("whole") + F.when(F.col("h") <= F.col("limit"), 1).otherwise(0)).cast("int")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"),
                      (F.col("size") * repeats).alias("taken"))


def _row_hash(seed: int, id_col: str, text_col: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 64 - _HASH_BITS)


def _apart(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows with a hash of their own each, where several have one: their number goes into it.

    Such rows are equal in id and text, so it does not matter which has which number; ``order`` makes
    it the same on every run. Most tables have none, and then the rows pass as they are.
    """
    again = stored(rows.groupBy("source_key", "h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("source_key", "h"), "mix-again")
    if again.isEmpty():
        return rows
    numbered = number_rows(rows.join(again, ["source_key", "h"], "left_semi"), ["source_key", "h"], order, "_copy")
    own = F.shiftrightunsigned(F.xxhash64("h", F.col("_copy").cast("bigint")), 64 - _HASH_BITS)
    many = numbered.withColumn("h", F.when(F.col("_copy") > 1, own).otherwise(F.col("h"))).drop("_copy")
    return rows.join(again, ["source_key", "h"], "left_anti").unionByName(many)


def _source_key(source: Column) -> Column:
    """A key that joins null sources too: they are marked by a name no source has."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def _plan(docs, weights, share, max_epochs, seed, id_col, text_col, source_col) -> tuple[DataFrame, DataFrame]:
    source = F.col(source_col).cast("string")
    facts = stored(docs.select(
        F.col(id_col).alias("id"), _source_key(source).alias("source_key"), source.alias("source"),
        word_count(F.col(text_col)).alias("size"), _row_hash(seed, id_col, text_col).alias("h")), "mix-facts")
    facts = _apart(facts, ["id", "size"])
    sources = facts.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sources, [], [F.col("source").asc_nulls_last()])
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = targets(stored(ranked.select("source_key", "source_size", pick.alias("weight")), "mix-sources"),
                      share, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    weighed = weighed.withColumn("whole", rate.cast("bigint"))
    needed = weighed.select("source_key", (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"))
    limits = thresholds(facts.select("source_key", "size", "h"), needed.filter("need > 0"))
    by_source = weighed.join(limits, "source_key", "left").withColumn("limit", F.coalesce("limit", F.lit(-1)))
    # Written, so that Spark knows its size when it plans the join with the rows.
    return facts, stored(by_source.select("source_key", "source_size", "target", "whole", "limit"), "mix-by-source")


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0,
          seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    _, by_source = _plan(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       _source_key(F.col(source_col).cast("string")).alias("source_key"),
                       _row_hash(seed, id_col, text_col).alias("h"))
    rows = _apart(rows, [F.to_json(F.col("row"))])
    rows = rows.join(by_source.select("source_key", "whole", "limit"), "source_key")
    times = (F.col("whole") + F.when(F.col("h") <= F.col("limit"), 1).otherwise(0)).cast("int")
    # explode of an empty array drops the row
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
