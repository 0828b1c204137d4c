"""Learned labels against a plain naive Bayes, ranked summaries against a dense walk."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.plans import summaries as SM
from lakeops.plans import text_labels as LB


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain_labels(train, texts, smoothing=0.5, bits=LB.BITS):
    """Counts by gram, without hashing; the size of the table enters the smoothing."""
    def grams(text):
        w = words(text)
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    counts, docs = {}, {}
    for text, label in train:
        if label is not None:
            docs[label] = docs.get(label, 0) + 1
            own = counts.setdefault(label, {})
            for g in grams(text):
                own[g] = own.get(g, 0) + 1
    out = []
    for text in texts:
        scores = {x: math.log(docs[x] / sum(docs.values())) + sum(
            math.log(counts[x].get(g, 0) + smoothing) - math.log(sum(counts[x].values()) + smoothing * 2 ** bits) for g in grams(text)) for x in sorted(docs)}
        best = max(scores, key=scores.get)
        out.append((best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())))
    return out


def test_labels_against_plain_naive_bayes(spark):
    train = [("good nice good staff", "pos"), ("nice food, very good", "pos"), ("bad seat", "neg"), ("very bad food; bad", "neg"),
             ("was ok", "mid"), (None, "mid"), ("nothing", None)]
    texts = ["good food", "bad bad seat", "was", "", None, "zzz unknown", "GOOD staff very bad", "ok " * 500]
    model = LB.learn_labels(spark.createDataFrame(train, "t string, l string"), "t", "l")
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: (r["label"], r["probability"]) for r in LB.label_texts(model, rows, "id", "t").collect()}
    for i, (label, p) in enumerate(plain_labels(train, texts)):
        assert got[i][0] == label and got[i][1] == pytest.approx(p, rel=1e-9)


def test_labels_of_nothing(spark):
    none = spark.createDataFrame([], "id int, t string, l string")
    some = spark.createDataFrame([(None, "a b"), (1, None), (1, "c"), (1, "c")], "id int, t string")
    empty = LB.label_texts(LB.learn_labels(none, "t", "l"), some, "id", "t").collect()
    assert sorted(map(str, [(r["id"], r["label"], r["probability"]) for r in empty])) == ["(1, None, None)", "(None, None, None)"]
    model = LB.learn_labels(spark.createDataFrame([("a", "x")], "t string, l string"), "t", "l")
    assert LB.label_texts(model, none, "id", "t").count() == 0
    assert sorted((str(r["id"]), r["label"], r["probability"]) for r in LB.label_texts(model, some, "id", "t").collect()) == [("1", "x", 1.0), ("None", "x", 1.0)]


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = LB.learn_labels(docs.filter(~LB.held_out("doc_id")), "text", "lang")
    found = LB.label_texts(model, docs, "doc_id", "text")
    assert LB.accuracy(found, docs, "doc_id", "lang", LB.held_out("doc_id")) >= 0.98


def test_labels_shuffle_a_row_per_text(spark):
    """The weights of a text are summed where it is read; a key may have several rows."""
    train = spark.createDataFrame([("good nice", "pos"), ("bad seat", "neg")], "t string, l string")
    model = LB.learn_labels(train, "t", "l")
    rows = spark.createDataFrame([(1, "good"), (1, "nice"), (1, "bad"), (None, "bad"), (2, None)], "id int, t string")
    found = LB.label_texts(model, rows, "id", "t")
    got = {r["id"]: (r["label"], r["probability"]) for r in found.collect()}
    # Without pairs, the three rows of key 1 weigh as a text of their words.
    alone = {r["id"]: r["probability"] for r in LB.label_texts(model, spark.createDataFrame([(1, "good"), (2, "nice"), (3, "bad")], "id int, t string"), "id", "t").collect()}
    assert got[1][0] == "pos" and got[None][0] == "neg" and got[2] == ("neg", 0.5)
    assert got[1][1] == pytest.approx(1 / (1 + (1 - alone[1]) / alone[1] * (1 - alone[2]) / alone[2] * alone[3] / (1 - alone[3])), rel=1e-9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def dense_ranks(sentence_list, rounds=SM.ROUNDS, damping=SM.DAMPING):
    """The same walk with a matrix of all links."""
    terms = [sorted(set(words(s))) for s in sentence_list]
    n, df = len(sentence_list), {}
    for t in terms:
        for w in t:
            df[w] = df.get(w, 0) + 1
    weight = {w: math.log1p(n / k) for w, k in df.items()}
    walk = np.zeros((n, n))
    for i, own in enumerate(terms):
        total = sum(weight[w] for w in own)
        for w in own:
            for j, other in enumerate(terms):
                if w in other:
                    walk[i, j] += weight[w] / total / df[w]
    ranks = np.full(n, 1 / n)
    for _ in range(rounds):
        ranks = (1 - damping) / n + damping * ranks @ walk
    return ranks


def test_ranks_against_a_dense_walk(spark):
    rng = np.random.default_rng(2)
    pool = ["seat", "food", "late", "crew", "kind", "cold", "wifi", "price", "again", "never"]
    answers = [(g, ". ".join(" ".join(rng.choice(pool, rng.integers(1, 6))) for _ in range(4))) for g in ("a", "b", None) for _ in range(8)]
    answers += [("a", None), ("a", "..."), ("empty", ""), ("signs", "!? + - ... ==")]
    df = spark.createDataFrame(answers, "g string, t string").withColumnRenamed("g", "kind")
    rows = SM._stored(SM.sentences(df, ["kind"], "t"), "rows")
    got = {}
    for r in SM.sentence_ranks(rows).collect():
        got.setdefault(r["g"], {})[r["sentence"]] = r["rank"]
    for g, ranks in got.items():
        names = sorted(ranks)
        assert [ranks[s] for s in names] == pytest.approx(dense_ranks(names).tolist(), rel=1e-9)
    out = {r["kind"]: r for r in SM.ranked_summaries(df, ["kind"], "t", n=2, sep="|").collect()}
    assert set(out) == {"a", "b", None, "empty", "signs"} and out["empty"]["summary"] == "" and out["empty"]["n_sentences"] == 0
    for kind in ("a", "b", None):
        key = next(g for g in got if (f'"{kind}"' if kind else "null") in g)
        best = sorted(got[key], key=lambda s: (-round(got[key][s], 9), s))[:2]
        assert out[kind]["summary"].split("|") == best and out[kind]["n_sentences"] == len(got[key])


def test_ranks_of_groups_in_many_blocks(spark):
    """The same ranks from any number of blocks; between them go rows of a term, not of its occurrences."""
    df = spark.range(4000).select(F.lit("all").alias("kind"), F.concat(
        F.lit("Seat "), F.col("id") % 40, F.lit(" was cold on day "), F.col("id")).alias("t"))
    rows = SM._stored(SM.sentences(df, ["kind"], "t"), "rows")
    one, many = ({r["id"]: r["rank"] for r in SM.sentence_ranks(rows, block_bytes=size).collect()} for size in (1 << 30, 5_000))
    assert len(one) == 4000 and sum(one.values()) == pytest.approx(1.0)
    assert [many[i] for i in one] == pytest.approx(list(one.values()), rel=1e-9)
    index = rows.select(F.lit(1).cast("bigint").alias("b"), "id", F.lit(4000.0).alias("size"), F.array(F.lit(7).cast("bigint")).alias("terms"))
    known = spark.createDataFrame([(1, 7, 4000.0, 0.0)], "b bigint, term bigint, df double, mass double")
    sent = SM._in_blocks(index, known, SM._masses(True, 0.85), "b bigint, term bigint, df double, mass double").collect()
    assert [(r["b"], r["term"], round(r["mass"], 9)) for r in sent] == [(1, 7, 1.0)]


def test_every_answer_counts_and_a_hot_group(spark):
    """One summary however many answers; the theme of the many is chosen, wherever it stands."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("kind"),
        F.concat(F.lit("Odd opening "), F.col("id"), F.lit(". The seat was broken and crew number "), F.col("id") % 90, F.lit(" knew")).alias("t"))
    out = {r["kind"]: r["summary"] for r in SM.ranked_summaries(df, ["kind"], "t", n=1).collect()}
    assert len(out) == 51 and "seat was broken" in out["hot"]


def test_groups_in_a_task_and_by_the_index_agree(spark):
    """Small groups are ranked in one task, large ones by the index; rows of a group lie anywhere, keys may be null."""
    rng = np.random.default_rng(5)
    pool = ["Seat", "food", "late", "crew", "kind", "Ärger", "wifi", "price", "again", "İstanbul"]
    rows = [(k, k and k % 3, ". ".join(" ".join(rng.choice(pool, rng.integers(1, 6))) for _ in range(int(rng.integers(1, 9)))))
            for k in (None, *range(9)) for _ in range(1 if k in (1, 2) else 400 if k == 3 else 30)]
    rows += [(20, 0, None), (21, 0, ""), (21, 0, "..."), (22, 1, "?! + -")]
    df = spark.createDataFrame(rows, "k int, j int, t string").repartition(7)
    out = {}
    for name, limit in (("tasks", 1 << 30), ("index", -1), ("both", 10_000)):
        out[name] = {tuple(r[:2]): tuple(r[2:]) for r in SM.ranked_summaries(df, ["k", "j"], "t", n=2, sep="|", group_bytes=limit).select("k", "j", "summary", "n_sentences").collect()}
    assert len(out["tasks"]) == 13 and out["tasks"] == out["index"] == out["both"]
    single = df.dropDuplicates(["k"])
    one = {r["k"]: r["summary"] for r in SM.ranked_summaries(single, ["k"], "t", n=1).collect()}
    assert one == {r["k"]: r["summary"] for r in SM.ranked_summaries(single, ["k"], "t", n=1, group_bytes=-1).collect()}


def test_groups_of_one_row_shuffle_no_text(spark):
    df = spark.range(300).select("id", F.concat(F.lit("The seat "), "id", F.lit(" was cold. The crew was kind")).alias("t"))
    plan = SM.ranked_summaries(df, ["id"], "t", n=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
