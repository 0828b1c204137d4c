"""Byte-level BPE by a rank queue over hierarchical bitmaps.

A pre-token starts as one part per byte. The parts form a doubly linked list;
a pair of neighbours whose joined bytes have a rank waits in the bucket of that
rank. A bitmap marks the buckets in use, a second one the words of the first
that are not zero, so the lowest rank is two find-first-set steps away (ranks
are counted from the last one, which makes the lowest the highest bit). Entries
are never searched for removal: one whose pair has changed since is stale and
skipped when it comes up. Work grows with the length of the pre-token times the
logarithm of a bucket, so that very long pre-tokens are no special case.

Within a bucket positions come out from left to right, as merges of equal rank
must.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from struct import pack

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import map_rows

CACHED_WORDS = 200_000  # entries of one generation of a task's word cache
_CACHED_OTHERS = 30_000  # the same, for signs and for words at the start of a line
# Fixed value: the usual pattern of byte-level vocabularies. Words of texts can be looked up without running it.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SIGNS = ".,;:!?%&*#$\"()|-"  # neither letters, digits, white space nor the apostrophe
_WORD_BITS = 8
_WORD_MASK = (1 << _WORD_BITS) - 1
_BIT = [1 << i for i in range(1 << 12)]  # bits of a word, and of the summary: for up to 2**20 ranks


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """Token ids of one pre-token."""
    n = len(piece)
    keys, last = ranks.keys, ranks.last
    if n < 2:
        return [last - keys[piece]] if n else []
    following = list(range(1, n + 1))  # start of the next part; n ends the list
    before = list(range(-1, n - 1))
    two = ranks.two
    key_at = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]  # of the pair that starts here; -1: none
    key_at.append(-1)
    buckets: dict[int, int | list[int]] = {}  # a place, or a heap of places
    for i, key in enumerate(key_at):
        if key >= 0:
            if key in buckets:
                _push(buckets, key, i)
            else:
                buckets[key] = i
    words, bit = [0] * ranks.words, _BIT
    summary = 0
    for key in buckets:
        words[key >> _WORD_BITS] |= bit[key & _WORD_MASK]
        summary |= bit[key >> _WORD_BITS]
    key_of = keys.get
    while summary:
        word = summary.bit_length() - 1
        bits = words[word]
        first = bits.bit_length() - 1
        key = word << _WORD_BITS | first
        i = buckets[key]
        if type(i) is int:
            del buckets[key]
            words[word] = bits = bits ^ bit[first]
            if not bits:
                summary ^= bit[word]
        else:
            i = _pop(buckets, key)
        if key_at[i] != key:
            continue  # stale
        gone = following[i]
        after = following[gone]
        following[i] = after
        key_at[gone] = -1
        left = before[i]
        if after < n:
            before[after] = i
            key_at[i] = key = key_of(piece[i:following[after]], -1)
            if key >= 0:
                if key in buckets:
                    _push(buckets, key, i)
                else:
                    buckets[key] = i
                    word = key >> _WORD_BITS
                    words[word] |= bit[key & _WORD_MASK]
                    summary |= bit[word]
        else:
            key_at[i] = -1
        if left >= 0:
            key_at[left] = key = key_of(piece[left:after], -1)
            if key >= 0:
                if key in buckets:
                    _push(buckets, key, left)
                else:
                    buckets[key] = left
                    word = key >> _WORD_BITS
                    words[word] |= bit[key & _WORD_MASK]
                    summary |= bit[word]
    ids = []
    i = 0
    while i < n:
        end = following[i]
        ids.append(last - keys[piece[i:end]])
        i = end
    return ids


def _push(buckets: dict, key: int, place: int) -> None:
    """Add a place to a bucket that is in use."""
    held = buckets[key]
    if type(held) is int:
        held = buckets[key] = [held]
    heappush(held, place)


def _pop(buckets: dict, key: int) -> int:
    """The leftmost place of a bucket with several; the last one left is a plain place again."""
    held = buckets[key]
    place = heappop(held)
    if len(held) == 1:
        buckets[key] = held[0]
    return place


class Ranks:
    """The tables of a vocabulary. A key is the last rank less the rank, so that the
    lowest rank is the highest bit, which ``bit_length`` finds at once."""

    def __init__(self, tokens: dict[bytes, int]):
        self.last = max(tokens.values(), default=0)
        self.keys = {token: self.last - rank for token, rank in tokens.items()}
        self.words = (self.last >> _WORD_BITS) + 1
        self.two = [self.keys.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]


class _Words(dict):
    """Word to packed ids, in two generations: a full one becomes the old one,
    so that frequent words stay and memory is bounded."""

    def __init__(self, encode, size: int):
        super().__init__()
        self.encode, self.size, self.old = encode, size, {}

    def __missing__(self, word):
        ids = self.old.get(word)
        if ids is None:
            ids, keep = self.encode(word)
            if not keep:
                return ids
        if len(word) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Tokenizer:
    """Encoder and decoder for one rank file and pre-token pattern.

    ``encode`` returns the ids packed as little-endian unsigned 32-bit integers.
    Tasks make their own from the token list, which is all that is sent.
    """

    def __init__(self, tokens: list[bytes], pattern: str, cached: int = CACHED_WORDS):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.tables = Ranks(self.ranks)
        # White space by the Unicode property, without the four separators that Python adds.
        self.pieces = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}"))
        self.by_word = pattern == WORD_PATTERN
        others = min(cached, _CACHED_OTHERS)
        self.piece_ids = _Words(lambda piece: (self._piece(piece), True), others)
        self.bare = _Words(lambda word: (self._word(word), True), others)
        self.spaced = _Words(self._spaced, cached)
        # For decoding: all tokens in one array, and where each begins.
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.newline = self._piece("\n")

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        ids = [rank] if rank is not None else merge(data, self.tables)
        return pack("<%dI" % len(ids), *ids)

    def _word(self, word: str) -> bytes:
        of = self.piece_ids
        return b"".join([of[p] for p in self.pieces.findall(word)])

    def _spaced(self, word: str) -> tuple[bytes, bool]:
        """A word and the space before it, and whether to keep the result.

        Letters are one match, signs after them another; these two are put
        together anew each time."""
        if word.isalpha():
            return self._piece(" " + word), True
        letters = word.rstrip(_SIGNS)
        if len(letters) < len(word) and letters.isalpha():
            return self.spaced[letters] + self.piece_ids[word[len(letters):]], False
        return self._word(" " + word), True

    def encode(self, text: str) -> bytes:
        """Packed ids of a text, each match of the pattern merged by itself.

        Where lone spaces and newlines between words are the only white space,
        no match of :data:`WORD_PATTERN` crosses them: a space goes with the word
        after it, a newline stands alone. Words can then be looked up without
        running the pattern.
        """
        if not text:
            return b""
        words = text.split()  # at any white space, and some more
        if not self.by_word or not words or len(" ".join(words)) != len(text) or (
                text.count(" ") + text.count("\n") != len(words) - 1):
            return self._word(text)
        out = []
        for line in text.split("\n"):
            first, *others = line.split(" ")
            if out:
                out.append(self.newline)
            out.append(self.bare[first])
            out.extend(map(self.spaced.__getitem__, others))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids."""
        of = np.frombuffer(ids, dtype="<u4")
        if not len(of):
            return b""
        lengths = self.lengths[of]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[of] - (ends - lengths), lengths)
        places += np.arange(ends[-1])
        return self.flat[places].tobytes()


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False, cached: int = CACHED_WORDS) -> DataFrame:
    """Encode every text and decode its ids again.

    One row per row of ``docs``: the id, ``n_tokens``, ``ids_sha256`` of the ids
    as little-endian unsigned 32-bit integers and ``decoded_sha256`` of the
    decoded bytes; ``with_ids`` adds ``ids`` (array of int). A null text counts
    as empty: no ids, the digests of no bytes. Null and repeated ids are kept as
    they are, other columns are not read. No shuffle; a task holds one Arrow
    batch and its word cache, of ``cached`` words in each of two generations.
    """
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(tokens)  # a vocabulary file, fixed in size

    def make():
        tokenizer = _of_worker(shared, pattern, cached)

        def one(key, text):
            ids = tokenizer.encode(text or "")
            digests = (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                       hashlib.sha256(tokenizer.decode(ids)).hexdigest())
            return (key, *digests, np.frombuffer(ids, dtype="<u4").tolist()) if with_ids else (key, *digests)
        return one

    key_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {key_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        schema, names = schema + ", ids array<bigint>", [*names, "ids"]
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, names, make)


_tokenizers: dict[tuple[int, str], Tokenizer] = {}


def _of_worker(shared, pattern: str, cached: int) -> Tokenizer:
    """The tokenizer of this Python worker, kept between its tasks."""
    key = (id(shared.value), pattern, cached)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = Tokenizer(shared.value, pattern, cached)
    return _tokenizers[key]
