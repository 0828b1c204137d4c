"""Summaries of many answers: the sentences that are most central in their group.

Sentences of a group are linked by the terms they share. A walk goes from a
sentence to one of its terms, by weight, and from there to a sentence with that term; the
share of time it spends at a sentence is its rank. Links between sentences are never made: each step of the
power iteration is two sums over the pairs (sentence, term), so the
work grows with the words. Rare terms weigh more. Every answer takes part, and a group has one summary at any size.

A group of up to ``GROUP_BYTES`` of text is ranked whole in a task; if every such group is
one row, no text is shuffled. Larger groups are cut into blocks; the terms of a block are summed there, and Spark sums them over the blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import work_dir

DAMPING = 0.85
ROUNDS = 8
GROUP_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20  # of sentences that a task walks at once, in larger groups
ROWS_AT_ONCE = 128
_ENDS = r"[.!?。！？\n]+"


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _group_key(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the key of its group in ``g``."""
    return df.withColumn("g", _group_key(keys))


def _sentences_of(text: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), _ENDS), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def _words_of(sentence: Column) -> Column:
    """Distinct words in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(sentence), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def sentences(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Distinct sentences of each group: ``g`` (the keys as text), ``sentence`` and ``id``."""
    rows = df.select(_group_key(keys).alias("g"), F.explode(_sentences_of(F.col(text))).alias("sentence")).distinct()
    return rows.withColumn("id", F.xxhash64("g", "sentence"))


def sentence_ranks(rows: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``rows`` (stored) with their ``rank``, the shares of a group adding up to one.

    A sentence without a term is reached by chance only. Sentences stay in their blocks, which Spark keeps on disk; a round
    sends a row for each term of a block, however often it occurs there, and gets back what the term has in all blocks.
    """
    spark = rows.sparkSession
    sizes = _stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("sentence")).alias("bytes")), "summary-sizes")
    block = F.xxhash64("g", F.pmod("id", F.ceil(F.col("bytes") / F.lit(block_bytes))))
    words = _words_of(F.col("sentence"))
    index = rows.join(sizes, "g").select(block.alias("b"), "id", F.col("size").cast("double").alias("size"),
                                         F.transform(words, lambda w: F.xxhash64("g", w)).alias("terms"))
    # With a number of partitions of its own the blocks stay where they are in all rounds.
    index = index.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "b").persist(StorageLevel.DISK_ONLY)
    try:
        held = index.select("b", F.explode("terms").alias("term")).groupBy("b", "term").agg(F.count(F.lit(1)).cast("double").alias("df"))
        everywhere = Window.partitionBy("term")
        known = held.select(F.col("b").alias("b"), "term", F.sum("df").over(everywhere).alias("df"), F.lit(0.0).alias("mass"))
        for i in range(rounds):
            sent = _in_blocks(index, known, _masses(i == 0, damping), "b bigint, term bigint, df double, mass double")
            known = sent.select("b", "term", "df", F.sum("mass").over(everywhere).alias("mass"))
        ranks = _stored(_in_blocks(index, known, _last_ranks(rounds == 0, damping), "id bigint, rank double"), "summary-ranks")
    finally:
        index.unpersist()
    return rows.join(ranks, "id")


def _in_blocks(index: DataFrame, known: DataFrame, step: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return index.groupBy("b").cogroup(known.withColumn("b", F.col("b").alias("b")).groupBy("b")).applyInArrow(step, schema)


def _block_walk(block: pa.Table, known: pa.Table, first: bool, damping: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of the sentences of a block from what its terms have in all blocks; the sentence and term of each link, and ``df``."""
    said = block["terms"].combine_chunks()
    size, n = block["size"].to_numpy(), len(block)
    owner = np.repeat(np.arange(n), pc.list_value_length(said).to_numpy(zero_copy_only=False))
    terms, df = known["term"].to_numpy(), known["df"].to_numpy()
    order = np.argsort(terms)
    place = order[np.searchsorted(terms, said.flatten().to_numpy(), sorter=order)] if len(terms) else np.empty(0, np.int64)
    ranks = 1.0 / size
    if not first:
        ranks = (1 - damping) * ranks + damping * np.bincount(owner, (known["mass"].to_numpy() / df)[place], n)
    return ranks, owner, place, df


def _masses(first: bool, damping: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A step from the sentences of a block to its terms, by weight."""

    def step(block: pa.Table, known: pa.Table) -> pa.Table:
        ranks, owner, place, df = _block_walk(block, known, first, damping)
        weight = np.log1p(block["size"].to_numpy()[owner] / df[place])
        share = ranks / np.maximum(np.bincount(owner, weight, len(ranks)), 1e-300)
        mass = np.bincount(place, share[owner] * weight, len(df)).astype(float)
        return pa.table({"b": known["b"], "term": known["term"], "df": known["df"], "mass": mass})

    return step


def _last_ranks(first: bool, damping: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def step(block: pa.Table, known: pa.Table) -> pa.Table:
        return pa.table({"id": block["id"], "rank": _block_walk(block, known, first, damping)[0]})

    return step


def _ranks_of_group(terms: np.ndarray, sizes: np.ndarray, rounds: int, damping: float) -> np.ndarray:
    """Ranks of the sentences of one group; ``terms`` has those of one sentence after the other, ``sizes`` their numbers."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, place, df = np.unique(terms, return_inverse=True, return_counts=True)
    weight = np.log1p(n / df)[place]
    to_term = weight / np.bincount(owner, weight, n)[owner]
    to_sentence = (1.0 / df)[place]
    ranks = np.full(n, 1.0 / n)
    for _ in range(rounds):
        mass = np.bincount(place, ranks[owner] * to_term, len(df))
        ranks = (1 - damping) / n + damping * np.bincount(owner, mass[place] * to_sentence, n)
    return ranks


def _summary_of(parts: Iterator[tuple[list[str], pa.ListScalar]], n: int, sep: str, rounds: int, damping: float) -> tuple[str, int]:
    """Summary and number of sentences of a group, from the sentences of its rows and their terms."""
    seen: dict[str, int] = {}
    terms, sizes = [], []
    for said, own in parts:
        if not said:
            continue
        lengths, flat = np.diff(own.offsets.to_numpy()), own.flatten().to_numpy()
        fresh = []
        for i, sentence in enumerate(said):
            if sentence not in seen:
                seen[sentence] = len(seen)
                fresh.append(i)
        keep = np.zeros(len(said), dtype=bool)
        keep[fresh] = True
        terms.append(flat[np.repeat(keep, lengths)])
        sizes.append(lengths[keep])
    if not seen:
        return "", 0
    ranks = np.round(_ranks_of_group(np.concatenate(terms), np.concatenate(sizes), rounds, damping), 9)
    if n < len(seen):  # only those that may be among the best are sorted
        least = np.partition(ranks, -n)[-n] if n else np.inf
        best = sorted((-r, s) for s, r in zip(seen, ranks.tolist()) if r >= least)[:n]
    else:
        best = sorted((-r, s) for s, r in zip(seen, ranks.tolist()))
    return sep.join(s for _, s in best), len(seen)


def _in_tasks(df: DataFrame, keys: Sequence[str], text: str, n: int, sep: str, rounds: int, damping: float, single: bool) -> DataFrame:
    """Summaries of groups that fit a task; ``single``: every group is one row. Sentences and terms are made by Spark."""
    rows = df.select(*keys, "g", F.col(text).alias("_text"))
    if not single:
        rows = rows.repartition("g").sortWithinPartitions("g")
    said = _sentences_of(F.col("_text"))
    rows = rows.select(*keys, "g", said.alias("_said")).select("*", F.transform(
        "_said", lambda s: F.transform(_words_of(s), lambda w: F.xxhash64(w))).alias("_terms"))
    kinds = [df.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", g string, summary string, n_sentences bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last group so far
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                starts = list(range(batch.num_rows)) if single else _starts(batch.column("g"))
                if held and (single or held[0].column("g")[0].as_py() != batch.column("g")[0].as_py()):
                    yield finished([held])
                    held = []
                cuts = [*starts, batch.num_rows]
                slices = [batch.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]
                groups = [[*held, slices[0]], *[[s] for s in slices[1:]]]
                held = groups.pop()
                if groups:
                    yield finished(groups)
        if held:
            yield finished([held])

    def finished(groups: list[list[pa.RecordBatch]]) -> pa.RecordBatch:
        found = [_summary_of(((said, own.values) for b in g for said, own in zip(b.column("_said").to_pylist(), b.column("_terms"))),
                             n, sep, rounds, damping) for g in groups]
        heads = pa.Table.from_batches([g[0].slice(0, 1).select([*keys, "g"]) for g in groups]).combine_chunks()
        out = [heads[k].combine_chunks() for k in (*keys, "g")] + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())]
        return pa.RecordBatch.from_arrays(out, names=[*keys, "g", "summary", "n_sentences"])

    return rows.mapInArrow(run, schema)


def _starts(groups: pa.Array) -> list[int]:
    """Places at which another group begins (rows of a group follow each other)."""
    codes = groups.dictionary_encode().indices.to_numpy()
    return [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist()]


def ranked_summaries(df: DataFrame, keys: Sequence[str], text: str, n: int = 3, sep: str = ". ", rounds: int = ROUNDS,
                     group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per group the ``n`` most central sentences, best first: the keys, ``summary`` and ``n_sentences``.

    Ranks that differ by less than a billionth are equal, and go by the text. A group without a sentence has an empty summary.
    """
    rows = keyed(df, keys)
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"))
    fits = F.col("bytes") <= group_bytes
    n_large, n_small, most = sizes.agg(F.count_if(~fits), F.count_if(fits), F.max(F.when(fits, F.col("n_rows")))).first()
    if not n_large:
        return _in_tasks(rows, keys, text, n, sep, rounds, DAMPING, most == 1).drop("g")
    if not n_small:
        return _by_index(df, keys, text, n, sep, rounds)
    # At most one large group for every ``group_bytes`` of text.
    large = _stored(sizes.filter(~fits).select("g"), "summary-large")
    small = _in_tasks(rows.join(large, "g", "left_anti"), keys, text, n, sep, rounds, DAMPING, most == 1).drop("g")
    return small.unionByName(_by_index(rows.join(large, "g", "left_semi"), keys, text, n, sep, rounds))


def _by_index(df: DataFrame, keys: Sequence[str], text: str, n: int, sep: str, rounds: int) -> DataFrame:
    """Summaries of groups of any size."""
    rows = _stored(sentences(df, keys, text), "summary-sentences")
    ranked = sentence_ranks(rows, rounds)
    order = Window.partitionBy("g").orderBy(F.round("rank", 9).desc(), "sentence")
    best = ranked.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= n)
    short = best.groupBy("g").agg(F.array_join(F.sort_array(F.collect_list(F.struct("_at", "sentence")))["sentence"], sep).alias("summary"))
    counts = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n_sentences"))
    groups = keyed(df.select(*keys).distinct(), keys)
    return groups.join(short, "g", "left").join(counts, "g", "left").select(
        *keys, F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("n_sentences", F.lit(0)).cast("bigint").alias("n_sentences"))
