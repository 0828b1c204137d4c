import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm.bpe import Ranks, Tokenizer, encode_decode, merge, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENS = read_ranks(PATH)
RANKS = {t: i for i, t in enumerate(TOKENS)}
OURS = Tokenizer(TOKENS, public_tokenizers.PATTERN, cached=50)
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(OURS.encode(text), "<u4").tolist()


def test_ranks_file():
    for line in open(PATH, "rb"):
        token, rank = line.split()
        assert TOKENS[int(rank)] == base64.b64decode(token)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sté. a")), max_size=60))
def test_same_ids_as_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert OURS.decode(OURS.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 20_000, "é" * 10_000, "=" * 5_000 + "x" * 5_000, "thethe" * 3_000])
def test_very_long_pre_tokens(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def brute(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == 1 << 40:
            break
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=12), st.data())
def test_any_ranks(piece, data):
    """Ranks need not grow with the merges: a later merge may free a lower one."""
    piece = bytes(b % 3 for b in piece)
    words = data.draw(st.lists(st.binary(min_size=2, max_size=4).map(lambda w: bytes(b % 3 for b in w)), unique=True, max_size=20))
    ranks = {bytes([b]): 50 + b for b in range(256)}
    for i, w in enumerate(words):
        ranks.setdefault(w, i)
    assert merge(piece, Ranks(ranks)) == (brute(piece, ranks) if piece else [])


def test_frame(odd_docs, no_docs):
    rows = encode_decode(odd_docs, PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    assert sorted(r["decoded_sha256"] for r in rows) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    for r in rows:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    assert encode_decode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
