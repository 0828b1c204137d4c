"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a bounded sample of labelled texts train the trees on the driver.
Trees are grown level by level from histograms of binned statistics, and are
kept as flat arrays (statistic, threshold, children, value), so that tasks score
a batch of texts with a few numpy steps per level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import ROWS_AT_ONCE, arrow_schema

SAMPLE_ROWS = 20_000  # labelled rows that train the trees, at most
STATISTICS = ("log_chars", "log_words", "word_length", "lower", "upper", "other_letters", "digits", "space",
              "stops", "symbols", "other_signs", "distinct_words", "top_word", "same_as_before", "words_no_letter",
              "words_end_in_sign", "distinct_lines", "line_length", "sign_entropy", "distinct_pairs")
_LOWER, _UPPER, _LETTER, _DIGIT, _SPACE, _STOP, _SYMBOL, _OTHER = range(8)
_kinds: np.ndarray | None = None


def _kind(c: str) -> int:
    if c.isalpha():
        return _LOWER if c.islower() else _UPPER if c.isupper() else _LETTER
    if c.isdigit():
        return _DIGIT
    if c.isspace():
        return _SPACE
    if c in ".,;:'\"?()-":
        return _STOP
    return _SYMBOL if c.isascii() else _OTHER


def _kind_table() -> np.ndarray:
    global _kinds
    if _kinds is None:
        _kinds = np.fromiter((_kind(chr(i)) for i in range(0x110000)), dtype=np.uint8, count=0x110000)
    return _kinds


def statistics(text: str | None) -> list[float]:
    """The numbers of one text; a null or empty text has zeros."""
    text = text or ""
    if not text:
        return [0.0] * len(STATISTICS)
    signs = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kinds = np.bincount(_kind_table()[signs], minlength=8) / len(signs)
    words = text.split()
    n = max(len(words), 1)
    seen = Counter(words)
    lines = text.split("\n")
    used = np.bincount(signs & 0x3FF)
    used = used[used > 0] / len(signs)
    return [
        float(np.log1p(len(signs))), float(np.log1p(len(words))), sum(map(len, words)) / n,
        *(float(kinds[k]) for k in (_LOWER, _UPPER, _LETTER, _DIGIT, _SPACE, _STOP, _SYMBOL, _OTHER)),
        len(seen) / n, (seen.most_common(1)[0][1] if seen else 0) / n, sum(map(eq, words, words[1:])) / n,
        sum(m for w, m in seen.items() if not any(map(str.isalpha, w))) / n,
        sum(m for w, m in seen.items() if not w[-1].isalnum()) / n,
        len(set(lines)) / len(lines), len(signs) / len(lines), float(-(used * np.log(used)).sum()),
        len(set(zip(words, words[1:]))) / n,
    ]


class Trees:
    """Boosted trees in flat arrays; node 0 of each tree is its root, a leaf is its own child."""

    def __init__(self, base: float):
        self.base = base
        self.feature = np.empty(0, np.int64)
        self.threshold = np.empty(0)
        self.left = np.empty(0, np.int64)
        self.right = np.empty(0, np.int64)
        self.value = np.empty(0)
        self.roots: list[int] = []
        self.depth = 0

    def add(self, nodes: list[tuple[int, float, int, int, float]], depth: int) -> None:
        at = len(self.feature)
        feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
        self.feature = np.concatenate([self.feature, feature.astype(np.int64)])
        self.threshold = np.concatenate([self.threshold, threshold.astype(float)])
        self.left = np.concatenate([self.left, left.astype(np.int64) + at])
        self.right = np.concatenate([self.right, right.astype(np.int64) + at])
        self.value = np.concatenate([self.value, value.astype(float)])
        self.roots.append(at)
        self.depth = max(self.depth, depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        if self.roots and len(x):
            node = np.tile(np.array(self.roots), (len(x), 1))
            row = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                goes_left = x[row, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
          least_rows: int = 10, shrink: float = 1.0) -> Trees:
    """Trees for the log-odds of label 1, by second-order boosting."""
    if not len(y):
        return Trees(0.0)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(base / (1 - base))))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        nodes, leaf_of = _grow(binned, edges, p - y, p * (1 - p), depth, bins, rate, least_rows, shrink)
        if len(nodes) == 1:
            break
        model.add(nodes, depth)
        margin += np.array([n[4] for n in nodes])[leaf_of]
    return model


def _grow(binned, edges, gradient, curvature, depth, bins, rate, least_rows, shrink):
    """One tree: its nodes, and the leaf of every row."""
    columns = binned.shape[1]
    node_of = np.zeros(len(gradient), np.int64)
    nodes = [_leaf(0, gradient.sum(), curvature.sum(), rate, shrink)]
    level = [0]
    for _ in range(depth):
        local = np.full(len(nodes), -1)
        local[level] = np.arange(len(level))
        slot = local[node_of]
        inside = slot >= 0
        size = len(level) * bins
        best = [(1e-6, 0, 0)] * len(level)
        for f in range(columns):
            cell = slot[inside] * bins + binned[inside, f]
            g, h, n = (np.bincount(cell, w, size).reshape(-1, bins).cumsum(axis=1)
                       for w in (gradient[inside], curvature[inside], np.ones(inside.sum())))
            total_g, total_h, total_n = g[:, -1:], h[:, -1:], n[:, -1:]
            gain = (g ** 2 / (h + shrink) + (total_g - g) ** 2 / (total_h - h + shrink) - total_g ** 2 / (total_h + shrink))
            gain[(n < least_rows) | (total_n - n < least_rows)] = -np.inf
            gain[:, len(edges[f]):] = -np.inf
            at = gain.argmax(axis=1)
            for i, b in enumerate(at):
                if gain[i, b] > best[i][0]:
                    best[i] = (gain[i, b], f, int(b))
        following = []
        for i, node in enumerate(level):
            gain, f, b = best[i]
            if gain <= 1e-6:
                continue
            rows = np.flatnonzero(node_of == node)
            goes_left = binned[rows, f] <= b
            children = []
            for side in (goes_left, ~goes_left):
                child = len(nodes)
                own = rows[side]
                nodes.append(_leaf(child, gradient[own].sum(), curvature[own].sum(), rate, shrink))
                node_of[own] = child
                children.append(child)
                following.append(child)
            nodes[node] = (f, float(edges[f][b]), *children, 0.0)
        level = following
        if not level:
            break
    return nodes, node_of


def _leaf(at: int, g: float, h: float, rate: float, shrink: float) -> tuple[int, float, int, int, float]:
    return 0, np.inf, at, at, float(-rate * g / (h + shrink))


def sample_statistics(docs: DataFrame, labels: DataFrame, sample_rows: int, id_col: str, text_col: str,
                      label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``sample_rows`` labelled rows, the ones with the smallest hashes."""
    labelled = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), (F.col(label_col).cast("double") > 0).cast("double").alias("_label"))
    order = F.xxhash64("_id")
    chosen = labelled.orderBy(order, "_id", "_label").limit(sample_rows)
    # sample_rows ids and labels: bounded by the parameter
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    numbers = _with_statistics(rows.select(F.col("_id").cast("string"), "_label", "_text"), "_id string, _label double")
    found = numbers.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows).toPandas()
    if found.empty:
        return np.empty((0, len(STATISTICS))), np.empty(0)
    return np.stack(found["statistics"].to_numpy()).astype(float), found["_label"].to_numpy()


def _with_statistics(rows: DataFrame, kept: str) -> DataFrame:
    """The columns of ``rows`` but the last, a text, with its ``statistics``."""
    schema = f"{kept}, statistics array<double>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [statistics(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(numbers, pa.list_(pa.float64()))], names=arrow.names)

    return rows.mapInArrow(run, schema)


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", threshold: float = 0.3,
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Score of every row of ``docs``, learned from labels whose row is not held out.

    ``held_out`` is an expression over the id. Returns the id, ``held_out``,
    ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from the
    threshold on). Only the text enters a score; null counts as empty. Null
    labels and ids teach nothing, several labels of one id all count; without
    any label every score is 0.5. Ids are only passed on, and other columns do
    not matter. Training sees at most ``sample_rows`` labelled rows.
    """
    x, y = sample_statistics(docs, labels.filter(~held_out), sample_rows, id_col, text_col, label_col)
    model = train(x, y)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    key_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {key_type}, held_out boolean, score double, predicted int"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                x = np.array([statistics(t) for t in batch.column(2).to_pylist()])
                scores = shared.value.score(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                     pa.array((scores >= threshold).astype(np.int32), pa.int32())], schema=arrow)

    return docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col)).mapInArrow(run, schema)
