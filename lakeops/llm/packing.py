"""Token ids packed into rows of one length, written as binary files.

Every task packs the documents it reads, in windows of a bounded number of
tokens, so nothing is shuffled. Documents longer than a row are split without
loss into full rows and a rest. Pieces are placed by best fit in order of
decreasing length: a segment tree over the room left in open rows finds the
smallest room that is large enough.

A file (``.npz``) holds one window: ``ids`` (rows x length, padded at the end),
``cu_seqlens`` (for each row the cumulative lengths of its segments, from 0),
``row_starts`` (where a row's cumulative lengths begin) and ``resets`` (the places
in the flat matrix where positions start again from 0).
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.bpe import Tokenizer, read_ranks
from lakeops.llm.common import arrow_schema, file_system, stored
from lakeops.session import work_dir

ROW_TOKENS = 2048
WINDOW_TOKENS = 4 << 20  # packed together; what a task holds in memory
_ODD_RUN = re.compile(r"\S{20000}|\s{20000}")


class Room:
    """Segment tree over room sizes: which sizes some open row has left."""

    def __init__(self, largest: int):
        self.size = 1 << (largest + 1).bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        rows = self.rows.setdefault(room, [])
        rows.append(row)
        node = room + self.size
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A row with the smallest room of at least ``least``, and that room."""
        node = least + self.size
        if not self.any[node]:
            # Up to the first ancestor with something on its right, then down its leftmost path.
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        rows = self.rows[room]
        row = rows.pop()
        if not rows:
            self.any[node] = 0
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = 0
        return row, room


def pack(lengths: list[int], row_tokens: int) -> list[list[tuple[int, int, int]]]:
    """Rows of pieces (document, offset, length) by best fit in decreasing order.

    No piece is longer than a row; the pieces of a document cover it exactly. A
    document without tokens has no piece.
    """
    rows: list[list[tuple[int, int, int]]] = []
    rests = []
    for doc, n in enumerate(lengths):
        full = n - n % row_tokens
        rows.extend([(doc, at, row_tokens)] for at in range(0, full, row_tokens))
        if n > full:
            rests.append((n - full, doc, full))
    rests.sort(key=lambda r: (-r[0], r[1]))
    room = Room(row_tokens)
    for n, doc, at in rests:
        found = room.take(n)
        if found is None:
            row, left = len(rows), row_tokens
            rows.append([])
        else:
            row, left = found
        rows[row].append((doc, at, n))
        if left > n:
            room.add(left - n, row)
    return rows


def matrices(rows: list[list[tuple[int, int, int]]], ids: list[np.ndarray], row_tokens: int, pad: int,
             dtype) -> dict[str, np.ndarray]:
    """The arrays of a file."""
    matrix = np.full((len(rows), row_tokens), pad, dtype=dtype)
    cumulative, starts, resets = [], [], []
    for r, pieces in enumerate(rows):
        starts.append(len(cumulative))
        cumulative.append(0)
        at = 0
        for doc, offset, n in pieces:
            matrix[r, at:at + n] = ids[doc][offset:offset + n]
            resets.append(r * row_tokens + at)
            at += n
            cumulative.append(at)
    return {"ids": matrix, "cu_seqlens": np.array(cumulative, "<i4"), "row_starts": np.array(starts, "<i4"),
            "resets": np.array(resets, "<i8")}


def positions(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Position of every token in its segment; padding counts on from the last segment."""
    flat = np.zeros(arrays["ids"].size, dtype=np.int64)
    resets = arrays["resets"]
    flat[resets] = np.diff(resets, prepend=0)
    where = np.arange(flat.size) - np.cumsum(flat)
    return where.reshape(arrays["ids"].shape)


class Encoder:
    """Ids of a text: the tokenizer library's, or for endless runs without a border the rank queue's."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import tiktoken
        self.tokens, self.pattern, self.own = tokens, pattern, None
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                                      special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if len(text) >= 20000 and _ODD_RUN.search(text):
            self.own = self.own or Tokenizer(self.tokens, self.pattern)
            return np.frombuffer(self.own.encode(text), "<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


def write_packed(docs: DataFrame, folder: str, ranks_path: str, pattern: str, row_tokens: int = ROW_TOKENS,
                 window_tokens: int = WINDOW_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, pack and write all documents below ``folder``, which all executors share.

    Returns one row per packed row: ``file``, ``row``, ``n_tokens`` and
    ``n_segments``, the lists ``doc_ids``, ``offsets`` (of the piece in its
    document) and ``cu_seqlens``, and ``ids_sha256`` of the row without padding.
    Padding is the first id after the vocabulary; ids are 16-bit if that fits,
    else 32-bit, little-endian. A null or empty text has no tokens and appears in
    no row; null and repeated ids are carried as they are; other columns are not
    read. A task that runs again replaces its files by the same ones. An empty
    table writes nothing.
    """
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(tokens)  # a vocabulary file, fixed in size
    pad = len(tokens)
    dtype = "<u2" if pad < 1 << 16 else "<u4"
    key_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"file string, row int, n_tokens int, n_segments int, doc_ids array<{key_type}>, offsets array<bigint>, "
              "cu_seqlens array<int>, ids_sha256 string")
    arrow = arrow_schema(schema)
    files, base = file_system(folder)
    files.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out, path = file_system(folder)
        encode = _encoder(shared, pattern)

        def window(number: int, keys: list, ids: list[np.ndarray]) -> pa.RecordBatch:
            rows = pack([len(x) for x in ids], row_tokens)
            arrays = matrices(rows, ids, row_tokens, pad, dtype)
            name = f"part-{part:06d}-{number:05d}.npz"
            data = io.BytesIO()
            np.savez(data, **arrays)
            draft = f"{path}/.draft-{part}-{number}-{uuid.uuid4().hex}"
            with out.open_output_stream(draft, compression=None) as stream:
                stream.write(data.getbuffer())
            out.move(draft, f"{path}/{name}")
            found = []
            for r, pieces in enumerate(rows):
                ends = np.cumsum([0, *(n for _, _, n in pieces)]).tolist()
                found.append((name, r, ends[-1], len(pieces), [keys[d] for d, _, _ in pieces], [o for _, o, _ in pieces],
                              ends, hashlib.sha256(arrays["ids"][r, :ends[-1]].tobytes()).hexdigest()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), arrow.types)], schema=arrow)

        keys, ids, total, number = [], [], 0, 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = encode(text or "").astype(dtype)
                if not len(own):
                    continue
                keys.append(key)
                ids.append(own)
                total += len(own)
                if total >= window_tokens:
                    yield window(number, keys, ids)
                    keys, ids, total, number = [], [], 0, number + 1
        if ids:
            yield window(number, keys, ids)

    return stored(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema), "packed-rows")


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """The encoder of this Python worker, kept between its tasks."""
    key = (id(shared.value), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value, pattern)
    return _encoders[key]


def read_packed(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of one file."""
    files, base = file_system(folder)
    with files.open_input_stream(f"{base}/{name}") as stream:
        return dict(np.load(io.BytesIO(stream.read())))


def packed(docs: DataFrame, ranks_path: str, pattern: str, **parameters) -> DataFrame:
    """:func:`write_packed` into a new shared folder."""
    return write_packed(docs, work_dir(docs.sparkSession, "packed"), ranks_path, pattern, **parameters)
