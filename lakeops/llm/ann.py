"""Nearest neighbours by stable projections and kd-trees.

A Gaussian (2-stable) projection to a few dimensions keeps distances on average:
the squared projected distance over the squared true one follows a chi-square
law with as many degrees of freedom as there are dimensions. A kd-tree over the
projections gives the candidates in order of projected distance, and each is
verified by its true distance. The search stops when the test holds: a point
nearer than the k-th best found so far would, with the wanted probability, have
been projected nearer than what comes next.

Equal vectors are one point that keeps its smallest ids, so a vector shared by a
third of the rows is no larger than another. Points are dealt into blocks by their place:
the upper levels of the kd-tree are split on a bounded sample of the projections,
and a block's own tree is built in one task. A query first searches the block that it
lies in or near; then the same test decides which of the other blocks, by the boxes around their points, it is sent to.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, stored

BLOCK_ROWS = 8192  # points of one tree, about
MOST_BLOCKS = 16_384  # of one vector length; beyond, blocks get larger. Their boxes go to all tasks.
SAMPLE_ROWS = 65_536  # projections on which blocks are split, about; all points are indexed
LEAF_ROWS = 32
DIMENSIONS = 8  # of the projection; even
CONFIDENCE = 0.97  # of the stopping test
SEED = 42


def chi_square_below(x: float, freedom: int) -> float:
    """Chi-square distribution function, for even degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for j in range(1, freedom // 2):
        term *= half / j
        total += term
    return 1.0 - exp(-half) * total


def directions(length: int, dimensions: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, length]).standard_normal((length, dimensions))


def projected(vectors: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Projections of the vectors, brought to length one."""
    return (vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))) @ onto


def box_gaps(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distance of a place to boxes."""
    gaps = np.maximum(np.maximum(low - at, at - high), 0.0)
    return (gaps * gaps).sum(axis=1)


def passes(gap: float | np.ndarray, reach: float, dimensions: int, confidence: float) -> bool:
    """Whether what is projected ``gap`` away (squared) need not be looked at, the k-th best being ``reach`` away (squared)."""
    if reach <= 0.0:
        return gap > 0
    return bool(chi_square_below(gap / reach, dimensions) >= confidence)


def split_places(places: np.ndarray, blocks: int) -> list[tuple[int, float, int, int]]:
    """Upper levels of a kd-tree: (axis, border, left, right) per node; a negative child is block ``-1 - child``."""
    nodes: list[tuple[int, float, int, int]] = []
    n_blocks = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal n_blocks
        if wanted > 1 and len(rows) > 1:
            points = places[rows]
            axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            order = rows[np.argsort(points[:, axis], kind="stable")]
            left = wanted // 2
            cut = min(max(1, len(order) * left // wanted), len(order) - 1)
            border = float(places[order[cut], axis])
            here = len(nodes)
            nodes.append((axis, border, 0, 0))
            nodes[here] = (axis, border, grow(order[:cut], left), grow(order[cut:], wanted - left))
            return here
        n_blocks += 1
        return -n_blocks

    if grow(np.arange(len(places)), blocks) < 0:
        return []
    return nodes


def block_of(nodes: list[tuple[int, float, int, int]], places: np.ndarray) -> np.ndarray:
    """The block of each place."""
    out = np.zeros(len(places), dtype=np.int64)
    open_nodes = [(0, np.arange(len(places)))] if nodes else []
    while open_nodes:
        node, rows = open_nodes.pop()
        axis, border, left, right = nodes[node]
        below = places[rows, axis] < border
        for child, part in ((left, rows[below]), (right, rows[~below])):
            if child < 0:
                out[part] = -1 - child
            elif len(part):
                open_nodes.append((child, part))
    return out


class Tree:
    """kd-tree over the projections of some vectors."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.vectors = vectors.astype(float)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.dimensions = dimensions
        self.directions = directions(vectors.shape[1], dimensions, seed)
        places = projected(self.vectors, self.directions)
        leaves, open_nodes = [], [np.arange(len(ids))]
        while open_nodes:
            rows = open_nodes.pop()
            if len(rows) <= LEAF_ROWS:
                leaves.append(rows)
                continue
            points = places[rows]
            axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            order = np.argsort(points[:, axis], kind="stable")
            half = len(rows) // 2
            open_nodes += [rows[order[half:]], rows[order[:half]]]
        order = np.concatenate(leaves)
        self.ids = [ids[i] for i in order]
        self.vectors, self.norms, self.places = self.vectors[order], self.norms[order], places[order]
        self.ends = np.cumsum([len(x) for x in leaves])
        self.starts = self.ends - [len(x) for x in leaves]
        self.low = np.stack([self.places[s:e].min(axis=0) for s, e in zip(self.starts, self.ends)])
        self.high = np.stack([self.places[s:e].max(axis=0) for s, e in zip(self.starts, self.ends)])

    def search(self, query: np.ndarray, k: int, confidence: float = CONFIDENCE,
               least: float | None = None) -> tuple[list[tuple[int, float]], int]:
        """Up to ``k`` ids with the largest cosines, ties to smaller ids, and the number of verified points.

        ``least`` is a k-th best cosine that is known already.
        """
        query = query.astype(float)
        norm = np.sqrt((query * query).sum())
        at = (query / norm) @ self.directions
        gaps = box_gaps(self.low, self.high, at)
        leaf_order = np.argsort(gaps, kind="stable")
        done, step, verified = 0, 2, 0
        near, away = np.empty(0, np.int64), np.empty(0)  # points of opened leaves, by projected distance
        rows, scores = np.empty(0, np.int64), np.empty(0)
        reach = np.inf if least is None else max(2.0 - 2.0 * least, 0.0)  # squared distance on the unit sphere
        while True:
            border = gaps[leaf_order[done]] if done < len(leaf_order) else np.inf
            ready = int(np.searchsorted(away, border, side="right"))
            if not ready:
                if done >= len(leaf_order) or np.isfinite(reach) and passes(border, reach, self.dimensions, confidence):
                    break
                opened = leaf_order[done:done + step]
                done, step = done + step, min(step * 2, 32)
                new = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in opened])
                shift = self.places[new] - at
                near, away = np.concatenate([near, new]), np.concatenate([away, (shift * shift).sum(axis=1)])
                order = np.argsort(away, kind="stable")
                near, away = near[order], away[order]
                continue
            if np.isfinite(reach) and passes(away[0], reach, self.dimensions, confidence):
                break
            take = min(ready, 2 * LEAF_ROWS)
            new, near, away = near[:take], near[take:], away[take:]
            verified += take
            cosines = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * norm)
            rows, scores = np.concatenate([rows, new]), np.concatenate([scores, cosines])
            if len(rows) > k:
                keep = scores >= np.partition(scores, -k)[-k]  # ties stay
                rows, scores = rows[keep], scores[keep]
            if len(rows) >= k:
                worst = np.partition(scores, -k)[-k]
                reach = min(reach, max(2.0 - 2.0 * worst, 0.0))
        found = [(-s, i) for r, s in zip(rows.tolist(), scores.tolist()) for i in self.ids[r]]
        return [(i, -s) for s, i in sorted(found)[:k]], verified

    def nearest(self, query: np.ndarray, own: int | None, k: int, confidence: float = CONFIDENCE) -> list[tuple[int, float]]:
        """Up to ``k`` ids other than ``own`` with the largest cosines."""
        found, _ = self.search(query, k + 1, confidence)
        return [(i, s) for i, s in found if i != own][:k]


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite numbers."""
    # x - x is null, NaN or 0: only finite numbers give 0
    odd = F.exists(vector, lambda x: F.coalesce((x - x) != 0, F.lit(True)))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
               vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, dimensions: int = DIMENSIONS,
               confidence: float = CONFIDENCE, with_counts: bool = False) -> DataFrame:
    """The ``k`` nearest rows by cosine of each row for which ``is_query`` holds.

    Returns ``query_id``, ``rank`` (from 1), the id of the neighbour and
    ``score``, the cosine of the original vectors in double precision; ties go to
    the smaller id. ``with_counts`` adds ``n_verified``, the points whose true distance to the query was taken, and
    ``n_points``. A query has fewer rows if there are fewer candidates. Rows
    take no part if the id or vector is null, or the vector is empty, zero or has
    null or non-finite components; vectors are compared with those of the same
    length. Rows that repeat an id count once. All points are indexed; the search
    is approximate, see ``confidence``. Queries with equal vectors search once.
    """
    vector = F.col(vector_col)
    rows = vectors.filter(usable(vector) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), vector.cast("array<double>").alias("v"), is_query.alias("is_query"))
    # Each task forwards the k + 1 smallest ids of a vector at most.
    rank = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    few = rows.select("id", "v").withColumn("_rank", rank).filter(F.col("_rank") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    points = stored(points.withColumn("size", F.size("v")), "ann-points")
    index = _Index(points, block_rows, dimensions, confidence)
    queries = rows.filter("is_query").select("id", "v").distinct()
    asked = stored(queries.groupBy("v").agg(F.min("id").alias("query")).withColumn("size", F.size("v")), "ann-queries")
    found = index.search(asked, k + 1)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    best = found.filter("id IS NOT NULL").select("query", "id", "score").distinct().withColumn(
        "_rank", F.row_number().over(order)).filter(F.col("_rank") <= k + 1)
    # Every query has the result of its vector, without itself.
    own = queries.select(F.col("id").alias("query_id"), "v").join(asked.select("v", "query"), "v").drop("v")
    pairs = own.join(best.drop("_rank"), "query").filter("id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    out = pairs.withColumn("rank", F.row_number().over(final).cast("int")).filter(F.col("rank") <= k)
    result = out.select("query_id", "rank", F.col("id").alias(id_col), "score")
    if not with_counts:
        return result
    counts = own.join(found.groupBy("query").agg(F.sum("n_verified").alias("n_verified")), "query").drop("query")
    return result.join(counts, "query_id").withColumn("n_points", F.lit(points.count()).cast("bigint"))


class _Index:
    """Points in blocks by place, and the boxes around the blocks."""

    def __init__(self, points: DataFrame, block_rows: int, dimensions: int, confidence: float):
        self.dimensions, self.confidence = dimensions, confidence
        sizes = {r["size"]: r["count"] for r in points.groupBy("size").count().collect()}  # one per vector length
        total = sum(sizes.values())
        some = points.filter(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1 << 40)) < int(min(1.0, SAMPLE_ROWS / max(total, 1)) * (1 << 40)))
        self.splits: dict[int, list] = {}
        sample = some.mapInArrow(self._place(), "size int, block int, ids array<bigint>, v array<double>, place array<double>")
        sample = sample.select("size", "place").toArrow()  # a bounded number of rows with a few numbers each
        lengths = sample.column("size").to_numpy()
        for size in np.unique(lengths).tolist():
            if sizes[size] > block_rows:
                places = np.array(sample.filter(pa.array(lengths == size)).column("place").to_pylist())
                self.splits[size] = split_places(places, min(MOST_BLOCKS, ceil(sizes[size] / block_rows)))
        self.points = stored(points.mapInArrow(self._place(), "size int, block int, ids array<bigint>, v array<double>, place array<double>"),
                             "ann-blocks")
        edges = [f(F.col("place")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(dimensions)]
        self.boxes: dict[int, tuple] = {}
        for r in self.points.groupBy("size", "block").agg(*edges).orderBy("size", "block").collect():
            self.boxes.setdefault(r["size"], []).append((r["block"], [r[f"low{i}"] for i in range(dimensions)], [r[f"high{i}"] for i in range(dimensions)]))
        self.boxes = {size: tuple(map(np.array, zip(*held))) for size, held in self.boxes.items()}
        self.n_blocks = sum(len(b[0]) for b in self.boxes.values())

    def _place(self):
        splits, dimensions = self.splits, self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths = batch.column("size").to_numpy()
                for size in np.unique(lengths).tolist():
                    part = batch.filter(pa.array(lengths == size))
                    vectors = part.column("v").flatten().to_numpy().reshape(-1, size)
                    places = projected(vectors, directions(size, dimensions))
                    blocks = block_of(splits.get(size, []), places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), size, np.int32)), pa.array(blocks.astype(np.int32)), part.column("ids"),
                         part.column("v"), pa.array(list(places), pa.list_(pa.float64()))],
                        names=["size", "block", "ids", "v", "place"])

        return run

    def _sent(self, queries: DataFrame, first: bool) -> DataFrame:
        """Queries with the block they go to: the nearest one or, with a k-th best, all others that may hold better points."""
        boxes, dimensions, confidence = self.boxes, self.dimensions, self.confidence
        schema = "size int, block int, query bigint, v array<double>, least double"
        arrow = arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for size, query, v, least in zip(*(batch.column(c).to_pylist() for c in ("size", "query", "v", "least"))):
                    if size not in boxes:
                        continue
                    names, low, high = boxes[size]
                    at = projected(np.array([v]), directions(size, dimensions))[0]
                    gaps = box_gaps(low, high, at)
                    nearest = int(np.argmin(gaps))
                    if first:
                        out.append((size, int(names[nearest]), query, v, None))
                        continue
                    reach = np.inf if least is None else max(2.0 - 2.0 * least, 0.0)
                    for i in range(len(names)):
                        if i != nearest and not (np.isfinite(reach) and passes(gaps[i], reach, dimensions, confidence)):
                            out.append((size, int(names[i]), query, v, least))
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)

        return queries.mapInArrow(run, schema)

    def _searched(self, sent: DataFrame, k: int) -> DataFrame:
        """What the queries find in the blocks they were sent to; a row without an id has the count alone."""
        none = F.lit(None)
        held = self.points.select("size", "block", F.lit(0).alias("kind"), none.cast("bigint").alias("query"), "ids", "v",
                                  none.cast("double").alias("least"))
        asked = sent.select("size", "block", F.lit(1).alias("kind"), "query", none.cast("array<bigint>").alias("ids"), "v", "least")
        # A block's points come first, then the queries that stream past its tree.
        met = held.unionByName(asked).repartition(2 * max(self.n_blocks, 1), "size", "block").sortWithinPartitions("size", "block", "kind")
        schema = "query bigint, id bigint, score double, n_verified bigint"
        arrow = arrow_schema(schema)
        dimensions, confidence = self.dimensions, self.confidence

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, ids, vectors, tree = None, [], [], None
            for batch in batches:
                size, number, kind, own, of, v, least = batch.columns
                flat = v.flatten().to_numpy()
                starts = v.offsets.to_numpy() - v.offsets[0].as_py()
                out = []
                for i, (n, b, q, known) in enumerate(zip(size.to_pylist(), number.to_pylist(), kind.to_pylist(), least.to_pylist())):
                    if (n, b) != key:
                        key, ids, vectors, tree = (n, b), [], [], None
                    one = flat[starts[i]:starts[i + 1]]
                    if q == 0:
                        ids.append(of[i].as_py())
                        vectors.append(one.copy())
                        continue
                    if tree is None and ids:
                        tree = Tree(ids, np.stack(vectors), dimensions)
                        ids, vectors = [], []
                    if tree is not None:
                        me = own[i].as_py()
                        found, verified = tree.search(one, k, confidence, known)
                        out.append((me, None, None, verified))
                        out.extend((me, j, s, 0) for j, s in found)
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)

        return met.mapInArrow(run, schema)

    def search(self, asked: DataFrame, k: int) -> DataFrame:
        """Candidates of all queries, ``k`` from each block they were sent to: ``query``, ``id``, ``score``, ``n_verified``."""
        first = stored(self._searched(self._sent(asked.withColumn("least", F.lit(None).cast("double")), True), k), "ann-first")
        if self.n_blocks <= 1:
            return first
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        ranked = first.filter("id IS NOT NULL").withColumn("_rank", F.row_number().over(order))
        kth = ranked.filter(F.col("_rank") == k).select("query", F.col("score").alias("least"))
        return first.unionByName(self._searched(self._sent(asked.join(kth, "query", "left"), False), k))
