import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from lakeops.llm.bpe import read_ranks
from lakeops.llm.packing import Encoder, Room, pack, positions, read_packed, write_packed
from lakeops.session import work_dir

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain_best_fit(lengths, size):
    """Rooms looked through one after the other."""
    rooms = []
    for n in sorted((x % size for x in lengths if x % size), reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(size - n)
    return len(rooms) + sum(x // size for x in lengths), sorted(rooms)


def test_best_fit_decreasing():
    rng = random.Random(1)
    for size in (1, 2, 7, 64, 100):
        lengths = [rng.randint(0, 3 * size) for _ in range(200)]
        rows = pack(lengths, size)
        used = [sum(n for _, _, n in r) for r in rows]
        assert (len(rows), sorted(size - u for u in used if u < size)) == (
            plain_best_fit(lengths, size)[0], [r for r in plain_best_fit(lengths, size)[1] if r])
        covered = {}
        for doc, at, n in (p for r in rows for p in r):
            covered.setdefault(doc, []).append((at, n))
        for doc, n in enumerate(lengths):
            at = 0
            for start, length in sorted(covered.get(doc, [])):
                assert start == at and 0 < length <= size
                at += length
            assert at == n


def test_room_search():
    rng, room, left = random.Random(2), Room(50), []
    for step in range(2000):
        if rng.random() < 0.5:
            r = rng.randint(1, 50)
            room.add(r, step)
            left.append(r)
        else:
            least = rng.randint(1, 50)
            found = room.take(least)
            fits = [r for r in left if r >= least]
            assert (found[1] if found else None) == (min(fits) if fits else None)
            if found:
                left.remove(found[1])


def test_lossless_files(spark, small_docs, odd_docs, no_docs):
    tokens = read_ranks(PATH)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                                special_tokens={})
    for docs in (small_docs.repartition(3), odd_docs):
        folder = work_dir(spark, "packed-test")
        found = write_packed(docs, folder, PATH, public_tokenizers.PATTERN, row_tokens=128, window_tokens=20_000).collect()
        files = {r["file"]: read_packed(folder, r["file"]) for r in found}
        pieces = []
        for r in found:
            data = files[r["file"]]
            row = data["ids"][r["row"]]
            cu = r["cu_seqlens"]
            start = data["row_starts"][r["row"]]
            assert data["cu_seqlens"][start:start + len(cu)].tolist() == cu and cu[-1] == r["n_tokens"]
            assert (row[cu[-1]:] == len(tokens)).all() and r["n_segments"] == len(cu) - 1
            assert hashlib.sha256(row[:cu[-1]].tobytes()).hexdigest() == r["ids_sha256"]
            where = positions(data)[r["row"]]
            for doc, offset, s, e in zip(r["doc_ids"], r["offsets"], cu, cu[1:]):
                assert where[s:e].tolist() == list(range(e - s))
                pieces.append((str(doc), offset, row[s:e].tolist()))
        got = {}
        for doc, offset, ids in pieces:
            got.setdefault(doc, []).append((offset, ids))
        want = {}
        for r in docs.collect():
            want.setdefault(str(r["doc_id"]), []).append(library.encode_ordinary(r["text"] or ""))
        for doc, texts in want.items():
            have = sorted(got.get(doc, []))
            assert sum(len(x) for _, x in have) == sum(map(len, texts))
            if len(texts) == 1:
                assert [t for _, x in have for t in x] == texts[0]
    assert write_packed(no_docs, work_dir(spark, "packed-test"), PATH, public_tokenizers.PATTERN).count() == 0


def test_endless_runs():
    encode = Encoder(read_ranks(PATH), public_tokenizers.PATTERN)
    assert encode("ab" * 30_000).tolist() == encode.fast.encode_ordinary("ab" * 30_000)
    assert encode.own is not None and isinstance(encode("x"), np.ndarray)
