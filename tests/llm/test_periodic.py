import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from lakeops.llm.periodic import Grammar, periodic_runs, planted, runs_of

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def brute(words):
    """Every maximal stretch of every period that has no smaller one."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            piece = words[start:start + length]
            if length >= max(6, 4 * q) and not any(piece[r:] == piece[:-r] for r in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out)


def texts_at_random(seed):
    rng = random.Random(seed)
    for _ in range(60):
        kind = rng.randrange(5)
        letters = [b"%d" % i for i in range(rng.choice([1, 2, 3, 8, 60]))]
        text = [rng.choice(letters) for _ in range(rng.randrange(0, 120))]
        if kind == 1:
            period = [rng.choice(letters) for _ in range(rng.randrange(1, 12))]
            text += period * rng.randrange(3, 9) + period[:rng.randrange(0, len(period))] + text[:10]
        elif kind == 2:  # runs inside the period of a run
            inner = [rng.choice(letters)] * rng.randrange(1, 9) + [b"x", b"y"][:rng.randrange(0, 3)]
            text = text[:7] + (inner * rng.randrange(1, 7) + [b"z"]) * rng.randrange(1, 7) + text[:3]
        elif kind == 3:  # the same run in several places
            run = [rng.choice(letters), b"q"] * 5
            text = run + text[:9] + run + [b"w"] + run + text[:9]
        elif kind == 4:
            text = [b"%d" % i for i in range(30)] * rng.randrange(1, 7)
        yield text


@pytest.mark.parametrize("seed", range(40))
def test_against_all_periods(seed):
    texts = list(texts_at_random(seed))
    for words, found in zip(texts, runs_of(texts)):
        assert found == brute(words), words


def test_all_short_texts_of_two_words():
    texts = [[b"ab"[int(c):int(c) + 1] for c in f"{i:0{n}b}"] for n in range(1, 13) for i in range(2 ** n)]
    for words, found in zip(texts, runs_of(texts)):
        assert found == brute(words)


def test_long_runs_and_fibonacci():
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 3000:
        fib = fib[1], fib[1] + fib[0]
    line = [b"w%d" % i for i in range(37)]
    texts = [fib[1], [b"a"] * 5000, line * 200, (line * 3 + [b"x"]) * 30, [b"w%d" % (i % 1000) for i in range(9000)]]
    found = runs_of(texts)
    assert found[0] == brute(fib[1])
    assert found[1:3] == [[(0, 5000, 1)], [(0, 37 * 200, 37)]]
    assert found[3] == [(0, 112 * 30, 112)]
    assert found[4] == [(0, 9000, 1000)]


def test_grammar_derives_the_text():
    """Places of a nonterminal expand to the same words, and no pair of a start rule repeats apart."""
    rng = np.random.default_rng(3)
    phrase = rng.integers(0, 50, 40)
    symbols = np.concatenate([phrase, rng.integers(0, 50, 30), phrase, phrase[5:30], rng.integers(0, 5, 200)])
    doc = np.zeros(len(symbols), dtype=np.int64)
    g = Grammar(symbols, doc)
    assert len(g.nodes) and len(g.place) > len(g.nodes)
    for node, place in zip(g.place_node, g.place):
        start, middle, end = g.nodes[node]
        assert start < middle < end
        assert (symbols[start:end] == symbols[place:place + end - start]).all()
    starts = np.concatenate([[0], g.boundaries, [len(symbols)]])
    pieces = [tuple(symbols[a:b]) for a, b in zip(starts, starts[1:])]
    pairs = {}
    for i, pair in enumerate(zip(pieces, pieces[1:])):
        pairs.setdefault(pair, []).append(i)
    assert all(len(at) == 1 or len(at) == 2 and at[1] == at[0] + 1 for at in pairs.values())
    # Every boundary is in the start rule or that of one place of one nonterminal.
    inner = [p + g.nodes[n][1] - g.nodes[n][0] for n, p in zip(g.place_node, g.place)]
    assert sorted([*inner, *g.boundaries]) == list(range(1, len(symbols)))


def test_repeated_phrase_takes_few_rounds():
    """New words in rising order do not make a round per word."""
    symbols = np.tile(np.arange(50_000), 2)
    g = Grammar(symbols, np.zeros(len(symbols), dtype=np.int64))
    assert len(g.boundaries) <= 3


def expected(key, text):
    words = planted((text or "").encode().split(), key) if key is not None else (text or "").encode().split()
    runs = brute(words)
    best = (None,) * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    collapsed = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (key, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def test_planted_tail():
    words = [b"%d" % i for i in range(100)]
    changed = [k for k in range(3000) if planted(words, k) != words]
    assert 200 < len(changed) < 320
    for k in changed[:40]:
        from zlib import crc32
        h = crc32(str(k).encode())
        g = h // 10
        a = g % 100
        p = 1 + (100 - a) // (3 + g % 8)
        assert planted(words, k) == [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]


def test_short_texts_of_the_table(small_docs, small_rows):
    short = [r for r in small_rows if len((r["text"] or "").split()) < 700]
    keep = {r["doc_id"] for r in short}
    got = [tuple(r) for r in periodic_runs(small_docs, plant=True).collect()]
    assert len(got) == len(small_rows)
    assert order([r for r in got if r[0] in keep]) == order([expected(r["doc_id"], r["text"]) for r in short])
    assert sum(r[1] > 0 for r in got) > 3


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    got = [tuple(r) for r in periodic_runs(odd_docs, plant=True).collect()]
    assert len(got) == len(rows)
    long = [r for r in got if r[0] == 10]
    assert long[0][1:6] == (1, 0, 60_000, 1, 60_000_000)
    assert order([r for r in got if r[0] != 10]) == order([expected(r["doc_id"], r["text"]) for r in rows if r["doc_id"] != 10])
    empty = periodic_runs(no_docs)
    assert empty.count() == 0 and "runs" not in empty.columns


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "a b a b a b a b a c"), (2, "x"), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in periodic_runs(docs, with_runs=True).collect()}
    assert [tuple(x) for x in got[1][0]] == [(0, 9, 2)] and got[1][1] == "a b c"
    assert got[2] == ([], "x") and got[3] == ([], "")
