"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints within the radius must meet in some table for certain, not just
probably. Bit ``i`` of a fingerprint gets a vector ``m(i)`` of radius + 1 bits,
never zero. For every vector ``v`` other than zero there is a table whose mask
keeps the bits with an odd scalar product ``<m(i), v>``. The vectors of up to
``radius`` differing bits span no more than ``radius`` dimensions, so some ``v``
is orthogonal to all of them; its mask keeps none of these bits, and both
fingerprints have the same key in its table.

Copies are merged first: only distinct fingerprints are hashed. Of a bucket only
a spanning forest of links is given out, never all pairs; a bucket too large for
one task is cut into blocks, and each two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, kept_rows, map_rows, row_mark, stored
from lakeops.llm.components import connected_components

BITS = 64
SEED = 42
BUCKET_ROWS = 4096  # fingerprints of one bucket that one task compares; larger buckets are cut into blocks
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle_words: int) -> int:
    """64-bit SimHash, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        part = [digest(joined[s:e], SEED) for s, e in
                zip(starts[at:at + _SHINGLES_AT_ONCE], ends[at:at + _SHINGLES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8), bitorder="little")
        votes += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    value = np.packbits(votes * 2 > len(starts), bitorder="little").view("<i8")
    return int(value[0])


def covering_masks(radius: int) -> list[int]:
    """The masks of all tables, as signed integers."""
    vectors = range(1, 1 << (radius + 1))
    masks = []
    for v in vectors:
        kept = [(1 + i % len(vectors)) & v for i in range(BITS)]
        mask = sum(1 << i for i, product in enumerate(kept) if product.bit_count() & 1)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by distances up to the radius."""
    rest, links = prints.view(np.uint64), []
    while rest.size > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and rest.size:
            x = reached.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                links.extend((x, y) for y in found)
                reached.extend(found)
    return [(int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))) for a, b in links]


def _bucket_links(keys: list[str], radius: int, most: int | None):
    """Links inside buckets, from rows sorted by bucket; rows of a bucket with
    more than ``most`` fingerprints are passed on with their key."""
    schema = arrow_schema(f"a bigint, b bigint, large boolean, {', '.join(f'{k} bigint' for k in keys)}")

    def rows(links=(), passed=None, key=()):
        if passed is None:
            a, b = ([x[i] for x in links] for i in (0, 1))
            extra = [pa.nulls(len(a), pa.int64()) for _ in keys]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                               pa.array([False] * len(a)), *extra], schema=schema)
        n = len(passed)
        return pa.RecordBatch.from_arrays(
            [pa.array(passed, pa.int64()), pa.nulls(n, pa.int64()), pa.array([True] * n),
             *[pa.array(np.full(n, k), pa.int64()) for k in key]], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, large = None, np.empty(0, np.int64), False
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in keys]
            prints = batch.column("fp").to_numpy()
            if not len(prints):
                continue
            changes = np.zeros(len(prints), dtype=bool)
            for c in columns:
                changes[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(changes).tolist()]
            out = []
            for s, e in zip(starts, [*starts[1:], len(prints)]):
                here = tuple(int(c[s]) for c in columns)
                if here != key:
                    if held.size > 1 and not large:
                        out.extend(spanning_links(np.unique(held), radius))
                    key, held, large = here, prints[s:e], False
                elif not large:
                    held = np.concatenate([held, prints[s:e]])
                else:
                    held = prints[s:e]
                if most is not None and (large or held.size > most):
                    yield rows(passed=held, key=key)
                    held, large = held[:0], True
            if out:
                yield rows(out)
        if held.size > 1 and not large:
            yield rows(spanning_links(np.unique(held), radius))

    return run, f"a bigint, b bigint, large boolean, {', '.join(f'{k} bigint' for k in keys)}"


def near_links(prints: DataFrame, radius: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints within the radius.

    ``prints`` has one row per distinct fingerprint ``fp``.
    """
    tables = F.array(*[F.struct(F.lit(t).cast("bigint").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for t, m in enumerate(covering_masks(radius))])
    hashed = prints.select("fp", F.explode(tables).alias("_")).select("_.t", "_.key", "fp")
    run, schema = _bucket_links(["t", "key"], radius, bucket_rows)
    dealt = hashed.repartition("t", "key").sortWithinPartitions("t", "key")
    first = stored(dealt.mapInArrow(run, schema), "simhash-buckets")
    links = first.filter(~F.col("large")).select("a", "b")
    large = first.filter("large").select("t", "key", F.col("a").alias("fp"))
    if large.isEmpty():
        return links
    # Blocks of half the limit; each two blocks of a bucket meet in one task.
    blocks = F.ceil(F.count(F.lit(1)) * 2 / F.lit(bucket_rows)).alias("n")
    sized = large.join(large.groupBy("t", "key").agg(blocks), ["t", "key"])
    own = F.pmod(F.xxhash64("fp"), F.col("n"))
    pairs = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    pairs = pairs.select("t", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    run, schema = _bucket_links(["t", "key", "p", "q"], radius, None)
    met = pairs.repartition("t", "key", "p", "q").sortWithinPartitions("t", "key", "p", "q").mapInArrow(run, schema)
    return links.unionByName(met.select("a", "b"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                radius: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprint and component of every row.

    The text is lower-cased (A-Z) and split at ASCII white space; shingles of
    ``shingle_words`` words, repeats included, are hashed by XXH64. A shorter
    text is one shingle; a null text or one without words has fingerprint zero
    and is linked like any other. Fingerprints link at ``radius`` or fewer
    differing bits. Returns the id, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id that can be reached. Null ids never give
    a component its name unless it has no other. Repeated rows are kept, other
    columns are not read; an empty table gives an empty result.
    """
    return _groups(docs, id_col, text_col, shingle_words, radius, bucket_rows).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, radius: int,
            bucket_rows: int) -> DataFrame:
    key_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, row_mark(text_col), text_col)
    facts = stored(map_rows(rows, f"id {key_type}, mark bigint, fp bigint", ["id", "mark", "fp"],
                            lambda: lambda key, mark, text: (key, mark, fingerprint(text, shingle_words))), "simhash-prints")
    prints = stored(facts.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    links = near_links(prints.select("fp"), radius, bucket_rows)
    parts = connected_components(links)
    named = prints.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = named.join(names, "component").select("fp", "component_id")
    return facts.join(by_print, "fp")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                        radius: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with their own columns."""
    groups = _groups(docs, id_col, text_col, shingle_words, radius, bucket_rows)
    verdicts = groups.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"),
                             F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    return kept_rows(docs, verdicts, id_col, text_col)
