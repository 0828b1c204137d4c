import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lakeops.llm.components import connected_components
from lakeops.llm.simhash import covering_masks, fingerprint, near_groups, near_links, without_near_copies


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=4):
    """Component of each fingerprint, from all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def brute(rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    part = classes(prints)
    first = {}
    for r, p in zip(rows, prints):
        if r["doc_id"] is not None:
            first[part[p]] = min(first.get(part[p], r["doc_id"]), r["doc_id"])
    return sorted([(r["doc_id"], f"{p:016x}", first.get(part[p])) for r, p in zip(rows, prints)], key=str)


def test_brute_force(small_docs, small_rows, odd_docs, no_docs):
    for docs, rows in ((small_docs, small_rows), (odd_docs, odd_docs.collect())):
        assert sorted((tuple(r) for r in near_groups(docs).collect()), key=str) == brute(rows)
    assert near_groups(no_docs).count() == 0


def test_same_hash_as_spark(spark):
    text = "four words are here"
    ours = fingerprint(text, 4)
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == ours


def test_long_text():
    text = " ".join(str(random.Random(1).random()) for _ in range(40_000))
    assert fingerprint(text, 4) % 2 ** 64 == plain_fingerprint(text)


def test_every_pair_within_the_radius_meets():
    masks = covering_masks(4)
    rng = random.Random(5)
    for n in range(1, 5):
        for _ in range(3000):
            difference = sum(1 << b for b in rng.sample(range(64), n))
            assert any(difference & m == 0 for m in masks)


def near_prints(n, seed):
    rng = random.Random(seed)
    out = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(n):
            out.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    return [p - (1 << 64) if p >> 63 else p for p in out]


def test_large_buckets(spark):
    """Buckets cut into blocks give the same components."""
    prints = near_prints(60, 3)
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    want = classes([p % 2 ** 64 for p in prints])
    for most in (4096, 8):
        links = near_links(frame, 4, bucket_rows=most).collect()
        parent = {p % 2 ** 64: p % 2 ** 64 for p in prints}

        def root(p):
            while parent[p] != p:
                p = parent[p]
            return p
        for a, b in links:
            assert (a % 2 ** 64 ^ b % 2 ** 64).bit_count() <= 4
            parent[root(a % 2 ** 64)] = root(b % 2 ** 64)
        pairs = {(root(p), want[p]) for p in want}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components(spark):
    rng = np.random.default_rng(0)
    chain = [(i, i + 1) for i in range(40)] + [(100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(-5, 7)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    parent = {n: n for link in chain for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in chain:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    linked = {n for a, b in chain if a != b for n in (a, b)}
    assert found == {n: root(n) for n in linked}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(odd_docs, small_docs, small_rows):
    kept = without_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in without_near_copies(small_docs).collect()) == sorted({r[2] for r in brute(small_rows)})
