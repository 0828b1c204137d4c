import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.line_dedup import Cuckoo, LineIndex, deduplicated_lines
from lakeops.session import work_dir

SPACE = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def expected(rows):
    """One result per row, by a plain pass over all lines; rows of an id are one document."""
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if k not in first or (i is not None and (first[k] is None or i < first[k])):
                first[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return order(out)


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


def test_cuckoo_keeps_all_keys_and_forgets_removed_ones():
    rng = np.random.default_rng(1)
    keys = rng.integers(-2 ** 63, 2 ** 63 - 1, 12_000)
    f = Cuckoo(4096)
    f.add(keys[:7000])
    f.add(keys[7000:])
    assert f.contains(keys).all()
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 200_000)
    assert f.contains(others).mean() < 0.001
    f.remove(keys[:6000])
    assert f.contains(keys[6000:]).all() and f.contains(keys[:6000]).mean() < 0.001
    f = Cuckoo(4096, *f.dump())
    f.remove(keys[6000:])
    assert not f.table.any() and not f.stash


def test_cuckoo_stash_beyond_its_slots():
    keys = np.arange(600)
    f = Cuckoo(64)
    f.add(keys)  # 256 slots
    assert len(f.stash) > 300 and f.contains(keys).all()
    f = Cuckoo(64, *f.dump())
    f.remove(keys[::2])
    assert f.contains(keys[1::2]).all()
    f.remove(keys[1::2])
    assert not f.table.any() and not f.stash


def test_whole_table(small_docs, small_rows):
    got = order(deduplicated_lines(small_docs).collect())
    assert got == expected([(r["doc_id"], r["text"]) for r in small_rows])
    assert sum(r[2] for r in got) > 10
    for batches in (1, 5):
        assert order(deduplicated_lines(small_docs, batches=batches).collect()) == got


def lines_at_random(rng, n):
    pool = [f"{' ' * rng.randrange(3)}A shared line, number {i}\t" for i in range(12)] + ["short", "", "  ", "exactly 10", "x" * 9]
    return "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own line {rng.random()}" for _ in range(n))


def test_insertions_and_deletions_in_any_order(spark):
    """After every step the result is that of the remaining documents alone."""
    rng = random.Random(5)
    index = LineIndex(spark, work_dir(spark, "lines-test"), shards=3)
    live = {}
    steps = [("in", range(40, 60)), ("in", range(0, 10)), ("out", [0, 1, 45, 999]), ("in", range(60, 160)), ("out", range(2, 10)),
             ("in", [0, 1]), ("out", range(40, 160)), ("in", range(40, 44))]
    for kind, ids in steps:
        if kind == "in":
            new = {i: lines_at_random(rng, rng.randrange(0, 12)) for i in ids}
            live |= new
            index.insert(spark.createDataFrame(list(new.items()), "doc_id bigint, text string"))
        else:
            for i in ids:
                live.pop(i, None)
            index.delete(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"))
        docs = spark.createDataFrame(list(live.items()), "doc_id bigint, text string")
        assert order(index.deduplicate(docs).collect()) == expected(live.items())
        # The filters know the keys that have lines, and the counts are exact.
        refs = {(r["h1"], r["h2"]): r["refs"] for r in index.refs().collect()}
        counted = index.postings().select(F.explode("lines").alias("_")).groupBy("_.h1", "_.h2").count()
        assert refs == {(r["h1"], r["h2"]): r["count"] for r in counted.collect()}
        held = {r["shard"]: (r["n"], Cuckoo(r["buckets"], r["table"], r["stash"])) for r in index.filters().collect()}
        assert sum(n for n, _ in held.values()) == len(refs)
        assert sum(int((c.table > 0).sum()) + len(c.stash) for _, c in held.values()) == len(refs)
        assert all(held[h1 % 3][1].contains(np.array([h1])).all() for h1, _ in refs)
    # An index that is opened again goes on.
    again = LineIndex(spark, index.path)
    assert again.shards == 3 and again.log == index.log
    assert order(again.deduplicate(docs).collect()) == expected(live.items())


def test_new_keys_are_not_looked_up(spark):
    index = LineIndex(spark, work_dir(spark, "lines-test"), shards=4)
    index.insert(spark.range(300).select(F.col("id").alias("doc_id"), F.format_string("the only line of %d", "id").alias("text")))
    index.insert(spark.range(300, 600).select(
        F.col("id").alias("doc_id"), F.format_string("the only line of %d\nthe only line of %d", F.col("id"), F.col("id") % 7).alias("text")))
    assert 7 <= index.lookups <= 10  # of 307 keys, 7 are old; some may be false positives
    assert index.refs().count() == 600


def test_failed_operation_leaves_nothing(spark):
    index = LineIndex(spark, work_dir(spark, "lines-test"))
    docs = spark.createDataFrame([(1, "a line of some length"), (2, "a line of some length")], "doc_id bigint, text string")
    index.insert(docs)
    broken = docs.withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        index.insert(broken)
    assert LineIndex(spark, index.path).log == index.log
    assert order(index.deduplicate(docs).collect()) == expected([(1, "a line of some length"), (2, "a line of some length")])
    index.insert(docs)
    assert index.refs().collect()[0]["refs"] == 4


def test_hot_line_and_repeats(spark):
    hot = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "The line in a third of all")
                                   .otherwise(F.format_string("line number %d", "id")).alias("text"))
    hot = hot.withColumn("text", F.concat("text", F.lit("\nThe line in a third of all\nshort\n")))
    rows = [(r["doc_id"], r["text"]) for r in hot.collect()]
    assert order(deduplicated_lines(hot).collect()) == expected(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert order(deduplicated_lines(odd_docs).collect()) == expected(rows)
    assert deduplicated_lines(no_docs).count() == 0
    texts = {r["doc_id"]: r["kept_text"] for r in deduplicated_lines(odd_docs.filter("doc_id = 1"), with_text=True).collect()}
    assert texts == {1: "The cat sat on the mat and looked at the dog."}


def test_no_document(spark, no_docs):
    index = LineIndex(spark, work_dir(spark, "lines-test"))
    index.insert(no_docs)
    index.delete(no_docs)
    index.insert(no_docs)
    assert index.refs().count() == index.deduplicate(no_docs).count() == 0
