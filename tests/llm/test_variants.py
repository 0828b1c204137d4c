import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from lakeops.llm import variants
from lakeops.llm.common import stored
from lakeops.llm.variants import letter_groups, near_in_block, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(rows, delete_every):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if delete_every and h % delete_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def neighbours(words):
    """All near words, by deleting each letter in turn."""
    holes = {}
    assert sum(len(w) > 1000 for w in words) <= 1  # a single long word has no near one
    for w in words:
        for i in range(len(w) if len(w) <= 1000 else 0):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    out = {w: set() for w in words}
    for (a, b), same in holes.items():
        whole = a + b
        for w in same:
            out[w] |= same - {w}
            if whole in out:
                out[w].add(whole)
                out[whole].add(w)
    return out


def expected(rows, delete_every=31):
    n = vocabulary(rows, delete_every)
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(docs, **parameters):
    return sorted(map(tuple, spelling_variants(docs, **parameters).collect()))


def test_groups_hold_every_letter_once():
    letters = "".join(letter_groups())
    assert len(letters) == len(set(letters)) == 26 + 64


@pytest.mark.parametrize("seed", range(5))
def test_blocks_against_all_pairs(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abcé") for _ in range(7)) for _ in range(300)})
    longer = sorted({"".join(rng.choice("abcé") for _ in range(8)) for _ in range(300)})
    i, j = near_in_block(words, None)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(len(words)) for b in range(a + 1, len(words))
                                                   if one_edit(words[a], words[b])]
    i, j = near_in_block(words, longer)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(len(words)) for b in range(len(longer))
                                                   if one_edit(words[a], longer[b])]


def test_very_long_words():
    a = "a" * 50_000
    assert near_in_block([a + "b", a + "c", a + "d"], None)[0].tolist() == [0, 0, 1]
    i, j = near_in_block([a], [a + "z", "z" + a, "b" * 50_001])
    assert np.array_equal(j, [0, 1])


@pytest.mark.parametrize("parameters", [{}, {"groups": 3, "block_rows": 16}, {"groups": 1, "block_rows": 5}])
def test_dense_words(spark, parameters):
    """Few letters, so that nearly all words have near ones, and blocks are cut."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = ["".join(rng.choice("abÉÿ") for _ in range(rng.choice([6, 7, 7, 7, 8, 9]))) for _ in range(120)]
        rows.append((i, " ".join(words * rng.choice([1, 1, 2, 30]))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = expected(rows)
    assert len(want) > 300 and sum(r[1] is not None for r in want) > 30
    assert result(docs, delete_every=31, **parameters) == want


def test_chains_of_forms(spark):
    rows = [(1, " ".join(["abcdefg"] * 20000 + ["abcdefgh"] * 2000 + ["abcdefghi"] * 200 + ["abcdefghij"] * 20 + ["abcdefghijk"] * 2))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = expected(rows, None)
    assert {r[2] for r in want} == {"abcdefg"} and len(want) == 5
    assert result(docs) == want


def test_whole_table(spark, small_docs, small_rows):
    want = expected([(r["doc_id"], r["text"]) for r in small_rows])
    assert sum(r[4] > 0 for r in want) > 20
    assert result(small_docs, delete_every=31) == want


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert result(odd_docs, delete_every=31) == expected(rows)
    twice = odd_docs.unionByName(odd_docs)
    assert result(twice, delete_every=31) == expected(rows * 2)
    assert any(len(r[0]) > 1000 for r in expected(rows * 2))
    assert result(no_docs) == []


def test_no_table_goes_through_the_driver(spark, small_docs, monkeypatch):
    """Exploded blocks look small to Spark, however many rows they are."""
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(variants, "stored", noted)
    plans["result"] = spelling_variants(small_docs, delete_every=31)._jdf.queryExecution().executedPlan().toString()
    assert {"variant-meet", "variant-words", "variant-forms", "variant-roots", "result"} <= set(plans)
    assert all("SortMergeJoin" in plans[name] for name in plans if name not in ("variant-vocabulary", "variant-blocks"))
    assert [name for name, plan in plans.items() if "Broadcast" in plan] == []
