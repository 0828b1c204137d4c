"""Spelling variants: words one edit apart, by Gram matrices of letter counts.

One inserted, deleted or replaced letter changes the letter counts of a word by a
squared distance of at most two, and its length by at most one. The words are
dealt into blocks of one length and of the same numbers of letters in each of a
few groups of letters; an edit moves a word to its own block or to one where one
group has a letter less or two groups differ by one, so only such blocks meet.
Two blocks meet as one product of their count matrices, which gives all squared
distances; pairs at most two apart are then verified letter by letter.

The rows of a block are held in one task, at most ``BLOCK_ROWS`` of them; those of
its neighbours stream past. A larger block is cut, and its parts meet, too.

Blocks, the pairs that meet and the roots are joined by sorting, at any size: Spark
takes an exploded table to be as large as the one before, and a table of few distinct
values to be as large as its compressed files, and would send either through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, stored

LETTERS = "A-Za-zÀ-ÿ"
BY_FREQUENCY = "etaoinsrhldcumfpgwybvkxjqz"
GROUPS = 8
BLOCK_ROWS = 2048  # words held at once; fewer if they are long
BLOCK_POINTS = 1 << 21  # code points held at once
_SYMBOLS = 26 + 64


def letter_groups(groups: int = GROUPS) -> list[str]:
    """The letters by frequency, dealt forth and back; the accented ones, in order, after them."""
    letters = BY_FREQUENCY + "".join(map(chr, range(0xC0, 0x100)))
    out = [""] * groups
    for i, letter in enumerate(letters):
        turn, at = divmod(i, groups)
        out[at if turn % 2 == 0 else groups - 1 - at] += letter
    return out


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = 7, least_n: int = 2,
             delete_every: int | None = None) -> DataFrame:
    """Distinct words and their numbers of occurrences: ``word``, ``n``.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), with A-Z in
    lower case. With ``delete_every``, an occurrence whose hash (of id and word)
    it divides loses one letter. Words count with ``least_points`` code points from ``least_n`` occurrences on.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]{{{least_points},}})"))
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.explode(runs).alias("_run")).select(
        "_id", F.translate("_run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("word"))
    if delete_every:
        h = F.crc32(F.concat(F.coalesce("_id", F.lit("")), F.lit(":"), "word").cast("binary"))
        at = F.pmod(h, F.length("word").cast("bigint")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.withColumn("word", F.when(h % delete_every == 0, cut).otherwise(F.col("word")))
        rows = rows.filter(F.length("word") >= least_points)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _letter_matrix(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points (padded with zeros), lengths and letter counts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.zeros((len(words), width), np.uint32)
    points[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    symbol = np.where(points >= 0xC0, points - 0xC0 + 26, points - ord("a")).astype(np.int64)
    flat = (np.arange(len(words))[:, None] * _SYMBOLS + symbol)[points > 0]
    counts = np.bincount(flat, minlength=len(words) * _SYMBOLS).reshape(len(words), _SYMBOLS)
    return points, lengths, counts.astype(np.float32)


def _one_edit(a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Which pairs of padded words are exactly one edit apart; the first is never longer."""
    differs = a != b
    same_length = a_len == b_len
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])
    # After a letter less, the rest is equal one place on.
    later = (a[:, :-1] != b[:, 1:]) & (np.arange(a.shape[1] - 1) >= first[:, None])
    return np.where(same_length, differs.sum(axis=1) == 1, (b_len == a_len + 1) & ~later.any(axis=1))


def near_in_block(held: list[str], other: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in ``held``, place in ``other``) one edit apart; without ``other``, pairs within ``held``.

    Words of ``other`` are as long as those of ``held`` or one letter longer.
    """
    width = max(map(len, held)) + 1
    a, a_len, a_counts = _letter_matrix(held, width)
    b, b_len, b_counts = (a, a_len, a_counts) if other is None else _letter_matrix(other, width)
    used = np.flatnonzero(a_counts.any(axis=0) | b_counts.any(axis=0))
    a_counts, b_counts = a_counts[:, used], b_counts[:, used]
    # Counts are small whole numbers, so products in single precision are exact; longer words need double.
    if width > 2000:
        a_counts, b_counts = a_counts.astype(np.float64), b_counts.astype(np.float64)
    gram = a_counts @ b_counts.T
    gram *= -2
    gram += (a_counts * a_counts).sum(axis=1)[:, None]
    gram += (b_counts * b_counts).sum(axis=1)[None, :]
    i, j = np.nonzero(gram <= 2)
    if other is None:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return i, j
    good = np.zeros(len(i), dtype=bool)
    step = max(1, BLOCK_POINTS // width)
    for s in range(0, len(i), step):
        x, y = i[s:s + step], j[s:s + step]
        good[s:s + step] = _one_edit(a[x], a_len[x], b[y], b_len[y])
    return i[good], j[good]


def near_pairs(words: DataFrame, groups: int = GROUPS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of words exactly one edit apart, in both directions: ``word``, ``other``, ``other_n``.

    ``words`` must be stored; it has ``word`` and ``n`` and is read three times.
    """
    numbers = [(F.length("word") - F.length(F.translate("word", letters, ""))).cast("int") for letters in letter_groups(groups)]
    # The word's own letters say which block it is in: the length and the numbers of letters by group.
    keyed = words.select("word", "n", F.array(*numbers).alias("key"))
    points = F.aggregate("key", F.lit(0), lambda a, x: a + x)
    rows_held = F.least(F.lit(block_rows), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_POINTS) / points).cast("int")))
    blocks = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).select(
        "key", F.monotonically_increasing_id().alias("block"), F.ceil(F.col("rows") / rows_held).cast("int").alias("parts"))
    blocks = stored(blocks, "variant-blocks")
    # Blocks that meet: a word with one letter less, or with one of an earlier group replaced by one of a later group.
    moves = [[-int(k == i) for k in range(groups)] for i in range(groups)]
    moves += [[int(k == j) - int(k == i) for k in range(groups)] for i in range(groups) for j in range(i + 1, groups)]
    shift = F.array(*[F.array(*map(F.lit, m)) for m in moves])
    reached = blocks.select("block", F.explode(F.transform(shift, lambda m: F.zip_with("key", m, lambda x, y: x + y))).alias("key"))
    meet = reached.hint("merge").join(blocks.select("key", F.col("block").alias("to"), F.col("parts").alias("to_parts")).hint("merge"), "key").select(
        "block", "to", "to_parts")
    meet = stored(meet, "variant-meet")

    placed = keyed.join(blocks.hint("merge"), "key").select(
        "word", "n", "block", "parts", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"))
    placed = stored(placed, "variant-words")
    own = placed.select(F.col("block").alias("to"), "part", F.lit(0).alias("kind"), "word", "n")
    # Parts of one block meet once: a word goes to the parts before its own.
    inside = placed.filter("part > 0").select(
        F.col("block").alias("to"), F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("part"), F.lit(1).alias("kind"), "word", "n")
    across = placed.select("word", "n", "block").join(meet.hint("merge"), "block").select(
        "to", F.explode(F.sequence(F.lit(0), F.col("to_parts") - 1)).alias("part"), F.lit(1).alias("kind"), "word", "n")
    dealt = own.unionByName(inside).unionByName(across).repartition("to", "part").sortWithinPartitions("to", "part", "kind")

    schema = "word string, other string, other_n bigint"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, held_n, fresh = None, [], [], False

        def pairs(other: list[str] | None, other_n: list[int]) -> Iterator[pa.RecordBatch]:
            i, j = near_in_block(held, other)
            if len(i):
                b, b_n = (held, held_n) if other is None else (other, other_n)
                i, j = i.tolist(), j.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held[x] for x in i] + [b[y] for y in j]), pa.array([b[y] for y in j] + [held[x] for x in i]),
                     pa.array([b_n[y] for y in j] + [held_n[x] for x in i], pa.int64())], schema=arrow)

        for batch in batches:
            to, part, kind = (batch.column(c).to_numpy() for c in range(3))
            cuts = np.flatnonzero((np.diff(to) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(to)]):
                if s == e:
                    continue
                words_here, n_here = batch.column(3).slice(s, e - s).to_pylist(), batch.column(4).slice(s, e - s).to_pylist()
                if kind[s] == 0:
                    if (to[s], part[s]) != key:
                        if fresh and len(held) > 1:
                            yield from pairs(None, [])
                        key, held, held_n, fresh = (to[s], part[s]), [], [], True
                    held += words_here
                    held_n += n_here
                    continue
                if fresh and len(held) > 1:
                    yield from pairs(None, [])
                fresh = False
                if (to[s], part[s]) != key:  # this part of a block is empty
                    continue
                step = max(1, min(block_rows, BLOCK_POINTS // len(words_here[0])))
                for at in range(0, e - s, step):
                    yield from pairs(words_here[at:at + step], n_here[at:at + step])
        if fresh and len(held) > 1:
            yield from pairs(None, [])

    return dealt.mapInArrow(run, schema)


def roots(forms: DataFrame) -> DataFrame:
    """The last word that is reached from each word by following ``form``: ``word``, ``root``.

    ``forms`` must be stored, and each form more frequent than its word, so there are no
    circles. Every round doubles the steps; the loop ends when no word moves.
    """
    steps = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(steps.join(after.hint("merge"), "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "variant-roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = 7, least_n: int = 2,
                      times: int = 10, delete_every: int | None = None, groups: int = GROUPS,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Words with the more frequent word that each is probably a variant of.

    Words are as in ``words_of``. Two words are near if exactly one inserted,
    deleted or replaced code point makes one of the other. A word's ``form`` is its
    near word with the largest ``n`` (ties: the smallest in code-point order) if that
    is at least ``times`` its own, else null; ``root`` is where following the forms ends.
    Also ``n``, ``n_near`` (0 if none) and ``form_n``. A null text has no words, a null
    id counts as empty; repeated rows count; other columns are not read; an
    empty table gives an empty result. All words take part.
    """
    words = stored(words_of(docs, id_col, text_col, least_points, least_n, delete_every), "variant-vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words, groups, block_rows).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    fits = -F.col("_best.less") >= F.col("n") * times
    forms = stored(words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("_best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, -F.col("_best.less")).alias("form_n")), "variant-forms")
    return forms.join(roots(forms).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
