"""Periodic runs of words, found on a Re-Pair grammar.

The word ids of a document are compressed by Re-Pair: pairs of neighbouring
symbols that occur again are replaced by a nonterminal, the most frequent ones
first. A round replaces every pair that is more frequent than the two pairs that
overlap it, so rounds grow with the logarithm of the length; ties are settled by
a mixed code, not by order. When no pair repeats, the sequence that remains is
the start rule.

A run lies in a smallest node of the derivation and crosses the boundary between
the two halves of that node (or two neighbouring symbols of the start rule). So
each nonterminal is looked at once, at the boundary of its first occurrence and
within its own expansion, and each boundary of the start rule within the whole
document. What is found is translated to every place in the derivation, and
intervals that lie in a longer one of the same period are merged into it.

At a boundary, periods come from blocks: a block of q to 1.5 q words inside a
run of smallest period q occurs next exactly q words later, as its period is
primitive. Blocks of 1, 2, 3, 4, 6, 8, 12, ... words get exact names by doubling,
only where they repeat at all. Four blocks at or before a boundary suffice: of a
run of 4 q words, one of them and its next occurrence are inside.

Documents of a batch are compressed together, as symbols of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, as_batch

LEAST_WORDS = 6
LEAST_EXPONENT = 4  # the blocks at a boundary are chosen for this exponent
WORDS_AT_ONCE = 150_000  # of one batch of documents; a longer document is a batch of its own


def planted(words: list, key: int) -> list:
    """The words of a document after the periodic tail that its id asks for."""
    h = crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((n - a) // len(period) + 1))[:n - a]


def _ranks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense names of codes, and how often the code at each place occurs."""
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    return names, counts[names]


def _mixed(names: np.ndarray) -> np.ndarray:
    """A scattered order of names, without ties."""
    x = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Grammar:
    """Re-Pair over the symbols of some documents.

    ``symbols``: word names, different in different documents; ``doc``: the
    document of each word. ``nodes`` has a row per nonterminal: start, boundary and
    end of its first occurrence; ``place_node`` and ``place`` are all its
    occurrences in the derivation, by start. ``boundaries`` are those of the start rules.
    """

    def __init__(self, symbols: np.ndarray, doc: np.ndarray):
        size = len(symbols)
        names, start = symbols.astype(np.int64), np.arange(size)
        next_name = int(names.max()) + 1 if size else 0
        firsts, node_of, places, count = [], [], [], 0
        ends = np.append(np.flatnonzero(np.diff(doc)) + 1, size)
        stop = ends[np.searchsorted(ends, start, side="right")] if size else start  # end of each word's document
        live = np.arange(size)  # symbols of documents in which some pair may repeat
        rest: list[np.ndarray] = []  # starts of the symbols of finished documents
        # The symbols are kept as (name, start); a symbol ends where the next one starts.
        while live.size > 1:
            joined = stop[start[:-1]] == stop[start[1:]]
            codes = names[:-1] * np.int64(next_name) + names[1:]
            codes[~joined] = -1
            pair, often = _ranks(codes)
            often = np.where(joined, often, 0)
            again = often > 1
            same = np.zeros(len(pair), dtype=bool)
            same[1:] = again[1:] & again[:-1] & (pair[1:] == pair[:-1])
            # Place within a stretch of equal pairs: of a a a a, every other pair can be replaced.
            places_in = np.arange(len(pair))
            odd = (places_in - np.maximum.accumulate(np.where(same, 0, places_in))) & 1
            again &= ~_lone_overlap(pair, often, same)
            if not again.any():
                break
            # Order of pairs: occurrences, then the mixed code.
            rank = np.empty(len(pair), dtype=np.int64)
            order = np.lexsort((_mixed(pair), often))
            sorted_pair = pair[order]
            rank[order] = np.cumsum(np.append(0, (sorted_pair[1:] != sorted_pair[:-1]).astype(np.int64)))
            rank[~again] = -1
            even = odd == 0
            over_left, over_right = np.ones(len(pair), dtype=bool), np.ones(len(pair), dtype=bool)
            over_left[1:] = (rank[1:] > rank[:-1]) | same[1:] & even[1:]
            over_right[:-1] = (rank[:-1] > rank[1:]) | same[1:] & even[:-1]
            chosen = np.flatnonzero(again & over_left & over_right)
            # A pair becomes a nonterminal; its places are those replaced now.
            _, first, which = np.unique(pair[chosen], return_index=True, return_inverse=True)
            at = chosen[first]
            end = np.append(start[1:], 0)
            end = np.where(np.append(joined, False), end, stop[start])
            firsts.append(np.stack([start[at], start[at + 1], end[at + 1]], axis=1))
            node_of.append(which + count)
            places.append(start[chosen])
            count += len(at)
            names[chosen] = which + next_name
            next_name += len(at)
            keep = np.ones(len(names), dtype=bool)
            keep[chosen + 1] = False
            names, start = names[keep], start[keep]
            # Documents without a repeated pair are done.
            busy = np.unique(stop[start[np.flatnonzero(_kept(again, keep))]])
            going = np.isin(stop[start], busy)
            if not going.all():
                rest.append(start[~going])
                names, start = names[going], start[going]
                _, names = np.unique(names, return_inverse=True)
                next_name = int(names.max()) + 1 if len(names) else 0
            live = start
        rest.append(start)
        starts = np.concatenate(rest)
        self.nodes = np.concatenate(firsts) if firsts else np.empty((0, 3), np.int64)
        self.place_node = np.concatenate(node_of) if node_of else np.empty(0, np.int64)
        self.place = np.concatenate(places) if places else np.empty(0, np.int64)
        begins = np.append(0, ends[:-1])
        self.boundaries = np.setdiff1d(starts, begins)


def _lone_overlap(pair: np.ndarray, often: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Places of pairs whose two occurrences overlap, as in a a a: nothing to share."""
    lone = np.zeros(len(pair), dtype=bool)
    twice = same & (often == 2)
    lone[twice] = True
    lone[:-1] |= twice[1:]
    return lone


def _kept(again: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Repeated pairs by the symbols that are still there, also next to replaced ones."""
    near = np.append(again, False)
    near[1:] |= again
    return near[keep]


def _next_distance(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For places ``at`` (rising) with ``codes``: place and distance of the next equal code, and which places repeat."""
    order = np.argsort(codes, kind="stable")
    equal = codes[order[1:]] == codes[order[:-1]]
    here, then = order[:-1][equal], order[1:][equal]
    repeats = np.zeros(len(codes), dtype=bool)
    repeats[here] = True
    repeats[then] = True
    return at[here], at[then] - at[here], repeats


def repeated_blocks(symbols: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block length up to 1.5 times ``longest`` periods: the places whose
    block occurs next at a distance of two thirds to all of its length."""
    size = len(symbols)
    name = symbols.astype(np.int64)
    at, length = np.arange(size), 1
    while at.size and length * 2 <= longest * 3:
        for step in (length, length + length // 2) if length > 1 else (1,):
            if step == length:
                codes, places = name[at], at
            else:
                half = step - length
                places = at[at + half < size]
                places = places[name[places + half] >= 0]
                codes = name[places] * np.int64(size + 1) + name[places + half]
            here, distance, repeats = _next_distance(codes, places)
            fits = (distance <= step) & (3 * distance >= 2 * step)
            if fits.any():
                yield step, here[fits], distance[fits]
            if step == length:
                at = places[repeats]
                fresh = np.full(size, -1, np.int64)
                _, fresh[at] = np.unique(codes[repeats], return_inverse=True)
                name = fresh
        following = at[at + length < size]
        following = following[name[following + length] >= 0]
        codes = name[following] * np.int64(size + 1) + name[following + length]
        fresh = np.full(size, -1, np.int64)
        if following.size:
            _, fresh[following] = np.unique(codes, return_inverse=True)
        name, at, length = fresh, following, length * 2


def _reach(symbols: np.ndarray, at: int, shift: int, low: int, high: int) -> tuple[int, int]:
    """The stretch of places i around ``at``, within [low, high), with equal symbols at i and i + shift."""
    def first_difference(a: np.ndarray, b: np.ndarray) -> int:
        done, width = 0, 64
        while done < len(a):
            differs = a[done:done + width] != b[done:done + width]
            if differs.any():
                return done + int(differs.argmax())
            done, width = done + width, width * 4
        return len(a)

    right = first_difference(symbols[at:high - shift], symbols[at + shift:high])
    left = first_difference(symbols[low:at][::-1], symbols[low + shift:at + shift][::-1])
    return at - left, at + right


def find_runs(symbols: np.ndarray, doc: np.ndarray, least_words: int = LEAST_WORDS) -> np.ndarray:
    """All maximal runs: rows of document, start, length and period, in that order.

    ``symbols`` are the word names of all documents, different in different
    ones; ``doc`` is the document of each, rising. Starts count over all words.
    """
    size = len(symbols)
    if not size:
        return np.empty((0, 4), np.int64)
    grammar = Grammar(symbols, doc)
    ends = np.append(np.flatnonzero(np.diff(doc)) + 1, size)
    begins = np.append(0, ends[:-1])
    # What is at a boundary: -1 nothing to look at, -2 the start rule, else a nonterminal.
    node_at = np.full(size + 1, -1, np.int64)
    node_at[grammar.boundaries] = -2
    lengths = grammar.nodes[:, 2] - grammar.nodes[:, 0]
    worth = np.flatnonzero(lengths >= least_words)
    node_at[grammar.nodes[worth, 1]] = worth
    found: list[tuple[int, int, int, int]] = []  # node, start, end, period
    done: dict[tuple[int, int], int] = {}  # by node and period, or start rule of a document and period: end of the last run
    for step, here, distance in repeated_blocks(symbols, int((ends - begins).max()) // LEAST_EXPONENT + 1):
        hits = []
        for j in range(4):
            at = here + 1 + j * step
            fits = at < size
            fits[fits] &= node_at[at[fits]] != -1
            hits.append(np.stack([at[fits], here[fits], distance[fits]], axis=1))
        for boundary, place, period in np.unique(np.concatenate(hits), axis=0).tolist():
            node = int(node_at[boundary])
            if node >= 0:
                low, high = int(grammar.nodes[node, 0]), int(grammar.nodes[node, 2])
                slot = (node, period)
            else:
                which = int(np.searchsorted(ends, boundary, side="right"))
                low, high = int(begins[which]), int(ends[which])
                slot = (-1 - which, period)
            if place < low or place + period >= high or done.get(slot, -1) > boundary:
                continue
            start, end = _reach(symbols, place, period, low, high)
            end += period
            if end - start >= max(least_words, LEAST_EXPONENT * period) and start < boundary < end:
                done[slot] = end
                found.append((node, start, end, period))
    if not found:
        return np.empty((0, 4), np.int64)
    rows = np.unique(np.array(found, dtype=np.int64), axis=0)
    return _merged(_translated(grammar, rows), doc)


def _translated(grammar: Grammar, rows: np.ndarray) -> np.ndarray:
    """Start, end and period at every place in the derivation."""
    own, shared = rows[rows[:, 0] < 0, 1:], rows[rows[:, 0] >= 0]
    if not len(shared):
        return own
    order = np.argsort(grammar.place_node, kind="stable")
    nodes = grammar.place_node[order]
    first = np.searchsorted(nodes, shared[:, 0], side="left")
    count = np.searchsorted(nodes, shared[:, 0], side="right") - first
    row = np.repeat(np.arange(len(shared)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    place = grammar.place[order[first[row] + within]]
    moved = place - grammar.nodes[shared[row, 0], 0]
    out = np.stack([shared[row, 1] + moved, shared[row, 2] + moved, shared[row, 3]], axis=1)
    return np.concatenate([own, out])


def _merged(spans: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Maximal intervals of each document and period: document, start, length, period."""
    spans = np.unique(spans, axis=0)
    spans = spans[np.lexsort((-spans[:, 1], spans[:, 0], spans[:, 2]))]
    out = []
    period, reach = -1, -1
    for start, end, q in spans.tolist():
        if q != period:
            period, reach = q, -1
        if end > reach:  # documents lie one after the other, so an earlier one never reaches into this
            reach = end
            out.append((int(doc[start]), start, end - start, q))
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 4)


def digest(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Number of runs, the best one, and digests of the runs and of the words left."""
    best = (None, None, None, None)
    if runs:
        start, length, period = runs[0]
        for s, n, q in runs[1:]:
            if n * period > length * q:  # runs come by start, then period, so ties keep the first
                start, length, period = s, n, q
        best = (start, length, period, 1000 * length // period)
        kept = np.ones(len(words), dtype=bool)
        for s, n, q in runs:
            kept[s + q:s + n] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


def runs_of(texts: list[list[bytes]], least_words: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    if sizes.sum() == 0:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    words = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    names = words.indices.to_numpy().astype(np.int64)
    _, symbols = np.unique(doc * np.int64(len(words.dictionary)) + names, return_inverse=True)
    for which, start, length, period in find_runs(symbols, doc, least_words).tolist():
        out[which].append((start - int(starts[which]), length, period))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False,
                  with_runs: bool = False) -> DataFrame:
    """Runs of every text: words that repeat with a period.

    Words stand between ASCII white space; a null text has none. A run is a
    stretch of at least 6 words and at least 4 times its smallest period that no
    neighbouring word extends. Returns the id, ``n_runs``; of the run with the greatest
    length over period (ties: smallest start, then period) ``start``, ``length``,
    ``period`` and ``exponent_milli``, null without a run; ``runs_sha256`` of
    all runs and ``collapsed_sha256`` of the words outside of repetitions (a word
    goes if a run holds it after that run's first period). ``with_runs`` adds
    ``runs`` (a list of start, length and period) and ``collapsed``. ``plant``
    first gives every tenth document, by the hash of its id, a periodic tail; a
    null id plants nothing. Repeated rows and other columns do not matter. One pass, no
    shuffle; memory grows with the longest text only.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    extra = ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string" if with_runs else ""
    schema = (f"`{id_col}` {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              f"runs_sha256 string, collapsed_sha256 string{extra}")
    arrow = arrow_schema(schema)
    names = arrow.names

    def rows_of(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        rows = []
        for key, words, runs in zip(keys, texts, runs_of(texts)):
            row = (key, *digest(words, runs))
            if with_runs:
                kept = np.ones(len(words), dtype=bool)
                for s, n, q in runs:
                    kept[s + q:s + n] = False
                row += ([{"start": s, "length": n, "period": q} for s, n, q in runs],
                        b" ".join(w for w, k in zip(words, kept) if k).decode())
            rows.append(row)
        return as_batch(rows, names, arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, total = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, words = key.as_py(), (text.as_py() or "").encode().split()
                if plant and key is not None:
                    words = planted(words, key)
                if texts and total + len(words) > WORDS_AT_ONCE:
                    yield rows_of(keys, texts)
                    keys, texts, total = [], [], 0
                keys.append(key)
                texts.append(words)
                total += len(words)
        if texts:
            yield rows_of(keys, texts)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
