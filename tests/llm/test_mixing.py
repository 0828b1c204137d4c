import random
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm.mixing import _row_hash, mix, mixed, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, share, cap):
    """Targets by clamping one source after the other."""
    total, free, out = share * sum(sizes), list(range(len(sizes))), {}
    while free:
        level = total / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * level > cap * sizes[i]]
        if not over:
            out |= {i: weights[i] * level for i in free}
            break
        for i in over:
            out[i] = cap * sizes[i]
            total -= out[i]
            free.remove(i)
    return [out[i] for i in range(len(sizes))]


def expected(rows):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_fill([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5, 2)
    return sizes, dict(zip(order, want))


@pytest.mark.parametrize("which", ["small_docs", "odd_docs"])
def test_targets_and_sizes(request, which):
    docs = request.getfixturevalue(which)
    rows = docs.collect()
    sizes, want = expected(rows)
    joined = mix(docs).collect()
    assert len(joined) == len(rows)
    taken = {}
    largest = {}
    source_of = {}
    for r in rows:
        source_of.setdefault((r["doc_id"], len(WORD.findall(r["text"] or ""))), r["source"])
    for r in joined:
        source = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[source] = taken.get(source, 0) + r["taken"]
        largest[source] = max(largest.get(source, 0), r["size"])
    for source, n in taken.items():
        assert abs(n - want[source]) <= largest[source]


def test_reruns_and_partitions_agree(small_docs):
    one = sorted(map(tuple, mix(small_docs).collect()))
    assert one == sorted(map(tuple, mix(small_docs.repartition(7)).collect()))
    assert one != sorted(map(tuple, mix(small_docs, seed=7).collect()))


def test_water_level(spark):
    sizes, weights = [10, 1000, 50, 3, 0, 700], [5.0, 2.0, 1.0, 5.0, 2.0, 1.0]
    for share in (0.5, 1.0, 1.5, 1.9, 2.0):
        frame = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights))],
                                      "source_key int, source_size bigint, weight double")
        got = [r["target"] for r in targets(frame, share, 2.0).orderBy("source_key").collect()]
        assert got == pytest.approx(water_fill(sizes, weights, share, 2.0))
        assert sum(got) == pytest.approx(share * sum(sizes))


def test_many_sources_in_few_jobs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 1, 5, 1000, 10 ** 9]) * rng.randrange(1, 50), float(rng.choice([5, 2, 1, 0.001]))) for i in range(5000)]
    frame = spark.createDataFrame(rows, "source_key int, source_size bigint, weight double").cache()
    tracker = spark.sparkContext.statusTracker()
    for share in (0.3, 1.5, 1.99):
        spark.sparkContext.setJobGroup(f"level-{share}", "level")
        got = [r["target"] for r in targets(frame, share, 2.0).orderBy("source_key").collect()]
        assert len(tracker.getJobIdsForGroup(f"level-{share}")) <= 30
        assert got == pytest.approx(water_fill([r[1] for r in rows], [r[2] for r in rows], share, 2.0))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_repeated_rows_are_taken_one_by_one(spark):
    rows = [(1, "one two three", "a")] * 100 + [(2, "x " * 40, "b"), (3, "y " * 60, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for frame in (docs, docs.repartition(7)):
        got = mix(frame, share=0.9, max_epochs=2.0).collect()
        own = [r for r in got if r["doc_id"] == 1]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3 and own[0]["target"] == pytest.approx(0.9 * 400 * 5 / 7)
        assert mixed(frame, share=0.9, max_epochs=2.0).filter("doc_id = 1").count() == sum(r["taken"] for r in own) // 3


def test_chosen_rows_against_a_sort(spark, small_docs, small_rows):
    """Whole repetitions of all, then the smallest hashes up to the nearest sum."""
    hashes = {r["doc_id"]: r["h"] for r in small_docs.select("doc_id", _row_hash(42, "doc_id", "text").alias("h")).collect()}
    sizes, want = expected(small_rows)
    taken = {}
    for source in sizes:
        own = sorted((hashes[r["doc_id"]], r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in small_rows if r["source"] == source)
        whole = int(want[source] // sizes[source]) if sizes[source] else 0
        need = want[source] - whole * sizes[source]
        for h, doc, size in own:
            extra = 1 if need > 0 and (size <= need or 2 * need >= size) else 0
            taken[doc] = (whole + extra) * size
            need = need - size if need > 0 else 0
    assert {r["doc_id"]: r["taken"] for r in mix(small_docs).collect()} == taken


def test_mixed_rows(odd_docs, small_docs, no_docs):
    for docs in (odd_docs, small_docs):
        rows = mixed(docs)
        assert rows.columns == docs.columns
        times = {}
        for r in mix(docs).collect():
            times[r["doc_id"]] = times.get(r["doc_id"], 0) + r["repeats"]
        got = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {k: n for k, n in times.items() if n}
    assert mix(no_docs).count() == mixed(no_docs).count() == 0
