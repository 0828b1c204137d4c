import hashlib

from pyspark.sql import functions as F

from lakeops.llm.exact_dedup import exact_groups, without_copies

SPACE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r["text"] or "").translate(SPACE), []).append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is not None, r["doc_id"] or 0))["doc_id"]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r["doc_id"], best, len(members), r["doc_id"] == best, sha) for r in members]
    return sorted(out, key=str)


def result(docs, **parameters):
    return sorted((tuple(r) for r in exact_groups(docs, **parameters).collect()), key=str)


def test_brute_force(small_docs, small_rows, odd_docs, no_docs):
    assert result(small_docs) == brute(small_rows)
    assert result(odd_docs) == brute(odd_docs.collect())
    assert result(no_docs) == []


def test_colliding_hashes(small_docs, small_rows, odd_docs):
    """With a hash of two values nearly every group has to be told apart by its bytes."""
    weak = lambda text: F.length(text) % 2
    assert result(small_docs, content_hash=weak) == brute(small_rows)
    assert result(odd_docs, content_hash=weak) == brute(odd_docs.collect())


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text"))
                                    .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    rows = exact_groups(docs.repartition(20)).filter("group_size > 1").collect()
    assert len(rows) == 1000 and {r["keep_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1


def test_rows_that_stay(odd_docs, small_docs, small_rows):
    kept = without_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [(r["text"] or "").translate(SPACE) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(r["text"] or "").translate(SPACE) for r in odd_docs.collect()})
    assert {r["doc_id"] for r in without_copies(small_docs).collect()} == {r[1] for r in brute(small_rows)}


def test_no_python_in_the_plan(small_docs):
    plan = exact_groups(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
