"""Labels for texts, learned from labelled ones: naive Bayes on hashed words and word pairs.

Learning counts grams per label, batch by batch and then in one aggregate; the model is a table of at most
2**BITS rows. Labelling sends that model to the tasks: the weights of a text are summed where it is
read, so a text is a row of sums in the shuffle, not a row per gram. Words and their hashes are made in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import work_dir

BITS = 18
SMOOTHING = 0.5


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """``text`` replaced by ``grams``: hashes of the words and of the pairs of neighbouring words, in lower case; empty for a null text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    # A column of its own, so that a text is split once.
    rows = df.withColumn("grams", words)
    n = F.greatest(F.size("grams") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("grams", 1, n), F.slice("grams", 2, n), lambda a, b: F.xxhash64(F.concat(a, F.lit(" "), b)))
    return rows.withColumn("grams", F.concat(F.transform("grams", lambda w: F.xxhash64(w)), pairs)).drop(text)


def _places(grams: pa.ListArray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The row of each gram, and its place among 2**bits."""
    owner = np.repeat(np.arange(len(grams)), np.diff(grams.offsets.to_numpy()))
    return owner, grams.flatten().to_numpy() & ((1 << bits) - 1)


class LabelModel:
    """``labels`` in order, their log priors, and a stored table: ``gram`` and ``weights``, one per label.

    ``unseen`` are the weights of a gram that no labelled text has.
    """

    def __init__(self, labels: list[str], priors: list[float], unseen: list[float], weights: DataFrame, bits: int):
        self.labels, self.priors, self.unseen, self.weights, self.bits = labels, priors, unseen, weights, bits

    def table(self) -> np.ndarray:
        """The weights by gram, 2**bits rows."""
        out = np.tile(np.array(self.unseen), (1 << self.bits, 1))
        known = self.weights.select("gram", "weights").toArrow()
        if known.num_rows:
            out[known["gram"].to_numpy()] = known["weights"].combine_chunks().flatten().to_numpy().reshape(known.num_rows, -1)
        return out


def _counts(bits: int):
    """Grams of a batch, counted by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").dictionary_encode()
            owner, flat = _places(batch.column("grams"), bits)
            label = labels.indices.to_numpy()[owner]
            for i, name in enumerate(labels.dictionary.to_pylist()):
                n = np.bincount(flat[label == i])
                found = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(n[found])], names=["label", "gram", "n"])

    return run


def _sums(table, bits: int):
    """Per row the sums of the weights of its grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = table.value
        for batch in batches:
            owner, flat = _places(batch.column("grams"), bits)
            sums = [np.bincount(owner, own[flat], batch.num_rows).astype(float) for own in weights.T]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *map(pa.array, sums)], names=["_key", *[f"_s{i}" for i in range(len(sums))]])

    return run


def learn_labels(labelled: DataFrame, text: str, label: str, bits: int = BITS, smoothing: float = SMOOTHING) -> LabelModel:
    """Model of all rows with a label. One row per label comes to the driver."""
    spark, path = labelled.sparkSession, work_dir(labelled.sparkSession, "label-counts")
    rows = labelled.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    counted = with_grams(rows, "text").mapInArrow(_counts(bits), "label string, gram bigint, n bigint")
    counted.groupBy("label", "gram").agg(F.sum("n").alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    docs = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    totals = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    labels, all_docs = sorted(docs), sum(docs.values())
    width = 1 << bits
    logs = [F.log(F.lit(float(totals.get(x, 0) + smoothing * width))) for x in labels]
    own = [F.coalesce(F.max(F.when(F.col("label") == x, F.col("n"))), F.lit(0)) for x in labels]
    where = work_dir(spark, "label-weights")
    counts.groupBy("gram").agg(F.array(*[F.log(n + F.lit(smoothing)) - t for n, t in zip(own, logs)] or [F.lit(0.0)]).alias("weights")).write.parquet(where)
    unseen = [log(smoothing) - log(totals.get(x, 0) + smoothing * width) for x in labels]
    return LabelModel(labels, [log(docs[x] / all_docs) for x in labels], unseen, spark.read.parquet(where), bits)


def label_texts(model: LabelModel, df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``label`` and ``probability`` for every key; rows that repeat a key count as one text.

    A text without words gets the most frequent label. Ties go to the first label by name. Without any label
    in the model both are null.
    """
    if not model.labels:
        keys = df.select(F.col(key).alias("_key")).distinct()
        return keys.select(F.col("_key").alias(key), F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("probability"))
    rows = with_grams(df.select(F.col(key).alias("_key"), F.col(text).alias("text")), "text")
    kind = df.schema[key].dataType.simpleString()
    width = len(model.labels)
    per_row = rows.mapInArrow(_sums(df.sparkSession.sparkContext.broadcast(model.table()), model.bits),
                              f"_key {kind}, " + ", ".join(f"_s{i} double" for i in range(width)))
    joined = per_row.groupBy("_key").agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(width)])
    scores = F.array(*[F.col(f"_s{i}") + F.lit(p) for i, p in enumerate(model.priors)])
    scored = joined.withColumn("_scores", scores).withColumn("_top", F.array_max("_scores"))
    total = F.aggregate("_scores", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("_top")))
    at = F.array_position("_scores", F.col("_top")).cast("int")
    return scored.select(F.col("_key").alias(key), F.element_at(F.array(*map(F.lit, model.labels)), at).alias("label"), (F.lit(1.0) / total).alias("probability"))


def held_out(key: str, buckets: int = 5) -> Column:
    """Whether a row is kept from learning, by a hash of its key."""
    digest = F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit("held")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets == 0


def accuracy(found: DataFrame, truth: DataFrame, key: str, label: str, only: Column) -> float | None:
    """Share of right labels among the rows where ``only`` holds."""
    both = truth.filter(only & F.col(label).isNotNull()).select(key, F.col(label).cast("string").alias("_true")).join(found, key)
    return both.agg(F.avg((F.col("_true") == F.col("label")).cast("double"))).first()[0]


def stars(found: DataFrame, of: dict[str, int], key: str, names: Sequence[str] = ("label", "probability")) -> DataFrame:
    """Labels as text like "5 stars", as a sentiment model gives them, with their probability."""
    number = F.lit(None).cast("int")
    for value, n in of.items():
        number = F.when(F.col(names[0]) == value, F.lit(n)).otherwise(number)
    return found.select(key, F.concat(number.cast("string"), F.when(number == 1, " star").otherwise(" stars")).alias("emotion"),
                        F.col(names[1]).alias("probability"))
