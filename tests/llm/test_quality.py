import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.common import held_out
from lakeops.llm.quality import STATISTICS, Trees, score_quality, statistics, train

SF = "/root/testdata/sf0.01"


def walk(model: Trees, row) -> float:
    """One row through one tree after the other."""
    total = model.base
    for node in model.roots:
        while model.left[node] != node:
            node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_score_like_single_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = train(x, y, trees=20, depth=3)
    scores = model.score(x)
    assert scores == pytest.approx([walk(model, r) for r in x])
    assert ((scores > 0.5) == (y > 0)).mean() > 0.95


def test_training_edge_cases():
    assert train(np.empty((0, 3)), np.empty(0)).score(np.zeros((2, 3))) == pytest.approx([0.5, 0.5])
    same = train(np.zeros((50, 3)), np.ones(50))
    assert (same.score(np.zeros((1, 3))) > 0.9).all()


def test_statistics():
    assert len(statistics("a b")) == len(STATISTICS) == len(statistics(None))
    assert statistics(None) == statistics("") == [0.0] * len(STATISTICS)
    named = dict(zip(STATISTICS, statistics("aa aa B! 7\naa")))
    assert named["distinct_words"] == 3 / 5 and named["top_word"] == 3 / 5 and named["same_as_before"] == 1 / 5
    assert named["words_no_letter"] == 1 / 5 and named["words_end_in_sign"] == 1 / 5


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_quality(docs, labels, held_out("doc_id", 5, 0)).join(labels, "doc_id")
    n, right, base = scored.filter("held_out").agg(
        F.count(F.lit(1)), F.count_if(F.col("predicted") == F.col("quality")), F.avg("quality")).first()
    assert n > 50 and right / n > max(base, 1 - base) + 0.05 and right / n > 0.95


def test_held_out_labels_are_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = held_out("doc_id", 5, 0)
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, score_quality(docs, x, out).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (8, 0, 1), (None, 1, 0), (9, None, None), (77, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = score_quality(odd_docs, labels, held_out("doc_id", 5, 0)).collect()
    assert len(rows) == 16 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert score_quality(no_docs, labels, held_out("doc_id", 5, 0)).count() == 0
    none = score_quality(odd_docs, labels.limit(0), held_out("doc_id", 5, 0)).collect()
    assert {r["score"] for r in none} == {0.5}
