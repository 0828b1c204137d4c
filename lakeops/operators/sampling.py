"""Samples and splits of exact sizes, without sorting a class.

A row's place is a repeatable hash of its key. The n rows with the smallest
hashes are a sample of exactly n; such samples are mergeable (the sample of a union is
in the union of the samples) and nested. The hash at which a sample ends is found by counts over ranges of
hashes, from coarse to fine: five narrow passes, whatever the size of a class.
Only rows that share the hash of a cut are numbered, to take as many of them as are missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.numbering import number_rows
from lakeops.session import work_dir

HASH_BITS = 60
LEVEL_BITS = 12  # a level counts at most 2**12 ranges per class and cut


def place(keys: Sequence[str], seed: int | str = 0) -> Column:
    """60 bits of a repeatable hash of the key."""
    text = F.concat_ws("#", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _class_key(cols: Sequence[str]) -> Column:
    """A key in which null is a class of its own."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)])) if cols else F.lit("")


def cut_points(facts: DataFrame, needs: DataFrame) -> DataFrame:
    """The hash at which ``need`` rows of a class are reached, for each cut.

    ``facts``: class ``g`` and hash ``h``, stored; ``needs``: ``g``, ``cut`` and ``need`` (from 1 to
    the rows of the class). Returns ``g``, ``cut``, ``at`` and ``take``, the rows of the very hash ``at`` that belong below the cut.
    """
    state = needs.select("g", "cut", F.col("need").cast("bigint").alias("need"), F.lit(0).cast("bigint").alias("prefix"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        here = facts.join(state, "g").filter(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        counts = here.groupBy("g", "cut", "need", F.shiftright("h", shift).alias("range")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("g", "cut").orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
        crossing = counts.withColumn("upto", upto).filter(F.col("upto") >= F.col("need")).groupBy("g", "cut").agg(
            F.min(F.struct("range", "n", "upto", "need")).alias("_"))
        state = _stored(crossing.select("g", "cut", (F.col("_.need") - (F.col("_.upto") - F.col("_.n"))).alias("need"),
                                        F.col("_.range").alias("prefix")), "sample-level")
    return state.select("g", "cut", F.col("prefix").alias("at"), F.col("need").alias("take"))


def _parts(df: DataFrame, keys: Sequence[str], by: Sequence[str], shares: Mapping[str, Column], seed: int | str,
           name: str) -> DataFrame:
    """Every row with its part; ``shares`` give the rows of each part but the last, cumulated, from the class size ``n``."""
    taken = [c for c in df.columns if c.lower() in ("_g", "_h", "_n", "_cuts", "_tie")]
    if taken:
        raise ValueError(f"columns of these names are used here: {taken}")
    rows = df.withColumns({"_g": _class_key(by), "_h": place(keys, seed)})
    facts = _stored(rows.select(F.col("_g").alias("g"), F.col("_h").alias("h")), "sample-facts")
    sizes = facts.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    ends = list(shares.values())[:-1]
    cuts = sizes.select("g", F.posexplode(F.array(*[e.cast("bigint") for e in ends])).alias("cut", "need"))
    cuts = _stored(cuts, "sample-cuts")
    found = cut_points(facts, cuts.filter("need > 0"))
    # A cut before the first row lies below every hash.
    points = cuts.join(found, ["g", "cut"], "left").select(
        "g", "cut", F.coalesce("at", F.lit(-1)).alias("at"), F.coalesce("take", F.lit(0)).alias("take"))
    by_class = _stored(points.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("cut", "at", "take"))).alias("_cuts")), "sample-points")
    joined = rows.join(by_class.withColumnRenamed("g", "_g"), "_g")
    on_cut = F.exists("_cuts", lambda c: c["at"] == F.col("_h"))
    # Rows with the hash of a cut are few, unless a key repeats; equal rows are interchangeable.
    border = number_rows(joined.filter(on_cut), ["_g", "_h"], [F.to_json(F.struct(*df.columns))], "_tie")
    whole = joined.filter(~on_cut).withColumn("_tie", F.lit(0).cast("bigint")).unionByName(border.withColumn("_tie", F.col("_tie").cast("bigint")))
    names = F.array(*[F.lit(p) for p in shares])
    passed = F.size(F.filter("_cuts", lambda c: (F.col("_h") > c["at"]) | ((F.col("_h") == c["at"]) & (F.col("_tie") > c["take"]))))
    return whole.withColumn(name, F.element_at(names, passed + 1)).select(*df.columns, name)


def exact_split(df: DataFrame, keys: Sequence[str], fractions: Mapping[str, float], by: Sequence[str] = (),
                seed: int | str = 0, name: str = "split") -> DataFrame:
    """Every row with its part; in each class (``by``) each part has its exact share, rounded.

    The cumulated share of a class of n rows is rounded half up, so a part is off by less than one row. The last
    part takes the rest. Null is a class. The same rows give the same split in any partitioning.
    """
    upto, ends = 0.0, {}
    for part, share in fractions.items():
        upto += share
        ends[part] = F.floor(F.col("n") * F.lit(min(upto, 1.0)) + F.lit(0.5 + 1e-9))
    return _parts(df, keys, by, ends, seed, name)


def exact_sample(df: DataFrame, keys: Sequence[str], n: int | Mapping, by: Sequence[str] = (), seed: int | str = 0) -> DataFrame:
    """Exactly ``n`` rows of every class, or all of a smaller one: those with the smallest hashes of the key.

    ``n`` may be a mapping from the values of the one column ``by`` to sizes; other values give none.
    Samples of one seed are nested in each other.
    """
    if isinstance(n, Mapping):
        size = F.lit(0)
        for value, rows in n.items():
            key = F.to_json(F.struct(F.lit(value).cast(df.schema[by[0]].dataType).cast("string").alias("k0")))
            size = F.when(F.col("g") == key, F.lit(int(rows))).otherwise(size)
    else:
        size = F.lit(int(n))
    out = _parts(df, keys, by, {"in": F.least(F.col("n"), size), "out": F.col("n")}, seed, "_part")
    return out.filter(F.col("_part") == "in").drop("_part")
