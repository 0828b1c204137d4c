import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm.common import held_out
from lakeops.llm.langid import GRAM_BITS, Model, gram_counts, identify, in_known_language, learn

SYLLABLES = {"aa": ["ba", "bo", "ri", "ta", "lo"], "bb": ["sch", "ung", "ein", "ver", "keit"], "cc": ["qui", "eau", "oux", "ment", "le"]}


def words(lang, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(words(lang, 60, rng), lang) for lang in SYLLABLES for _ in range(30)] + [("noise", None)]
    return learn(spark.createDataFrame(rows, "text string, lang string"))


def test_proportions_of_a_mixture(model):
    rng = random.Random(2)
    text = words("aa", 140, rng) + " " + words("bb", 60, rng)
    shares = {model.languages[i]: s for i, s in model.mixture(*gram_counts(text)).items()}
    letters = {lang: 0 for lang in SYLLABLES}
    parts = text.split(" ")
    letters["aa"], letters["bb"] = (sum(len(w) + 1 for w in p) for p in (parts[:140], parts[140:]))
    want = letters["aa"] / (letters["aa"] + letters["bb"])
    assert set(shares) == {"aa", "bb"}
    assert shares["aa"] == pytest.approx(want, abs=0.03)
    lang, score = model.predict(text)
    assert lang == "aa" and score == pytest.approx(shares["aa"])


def test_one_language_stays_one(model):
    rng = random.Random(3)
    for lang in SYLLABLES:
        for n in (1, 5, 200):
            found, score = model.predict(words(lang, n, rng))
            assert found == lang
            if n > 1:
                assert score == 1.0


def test_grams():
    grams, counts = gram_counts("Ab, ab")
    assert sorted(counts) == [1, 2, 2]  # " ab" and "ab " twice, and one across the border
    assert all(len(x) == 0 for t in (None, "", "12 !?", "　\x85") for x in gram_counts(t))
    assert Model([], np.empty((0, 1 << GRAM_BITS))).predict("abc") == ("und", 0.0)


def test_held_out_accuracy(small_docs):
    out = held_out("doc_id", 4, 2)
    found = identify(small_docs, ~out, out).join(small_docs.select("doc_id", "lang"), "doc_id")
    n, right = found.filter("held_out").agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 20 and right / n >= 0.98


def test_language_column_and_ids_are_no_input(small_docs):
    out = held_out("doc_id", 4, 2)
    one = {r["doc_id"]: r["lang_pred"] for r in identify(small_docs, ~out, out).filter("held_out").collect()}
    blind = small_docs.withColumn("lang", F.when(~out, F.col("lang"))).withColumn("source", F.lit("none"))
    assert one == {r["doc_id"]: r["lang_pred"] for r in identify(blind, ~out, out).filter("held_out").collect()}


def test_odd_rows(odd_docs, no_docs):
    rows = identify(odd_docs, F.lit(True), F.lit(False)).collect()
    assert len(rows) == 16 and {r["lang_pred"] for r in rows} <= {"en", "fr", "de", "und"}
    for r in rows:
        assert 0.0 <= r["score"] <= 1.0
    unknown = sorted(str(r["doc_id"]) for r in rows if r["lang_pred"] == "und")
    assert unknown == ["12", "4", "5", "6", "7", "None"]
    assert identify(no_docs, F.lit(True), F.lit(False)).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identify(unlabelled, F.lit(True), F.lit(False)).collect()} == {"und"}


def plain_model(rows):
    """Trigram probabilities by language, from all (text, lang)."""
    sums = {}
    for text, lang in rows:
        if lang is not None:
            own = sums.setdefault(lang, np.zeros(1 << GRAM_BITS))
            grams, counts = gram_counts(text)
            own[grams] += counts
    return {lang: (n + 0.5) / (n.sum() + 0.5 * len(n)) for lang, n in sums.items()}


def plain_decision(model, text):
    """Every set of languages by a long expectation-maximisation; the one with the best penalised likelihood."""
    grams, counts = gram_counts(text)
    if not len(grams) or not model:
        return None, len(grams) > 0
    n, best = counts.sum(), None
    for size in range(1, len(model) + 1):
        for names in combinations(sorted(model), size):
            p = np.stack([model[lang][grams] for lang in names])
            w = np.full(size, 1 / size)
            for _ in range(300 if size > 1 else 0):
                parts = w[:, None] * p
                w = (parts / parts.sum(axis=0)) @ counts / n
            likelihood = np.log(w @ p) @ counts
            value = likelihood - size * max(np.log(n), 1.0)
            if best is None or value > best[0] + 1e-9:
                best = value, names, w, likelihood
    _, names, w, likelihood = best
    if likelihood < -n * np.log(1 << GRAM_BITS) - 0.25 * n - 20:
        return None, False
    return names[int(np.argmax(w))], True


def with_junk(spark, docs):
    """Some rows without a language, some of random letters, some of two languages."""
    rng = random.Random(11)
    rows = docs.collect()
    junk = [(10_000 + i, "".join(rng.choice("bcdfghjklmnpqrstvwxzßøłđ ") for _ in range(rng.choice([40, 400, 3000]))), None, "j", 1) for i in range(20)]
    half = [(20_000 + i, (rows[i]["text"] or "")[:800] + " " + (rows[-1 - i]["text"] or "")[:500], None, "m", 1) for i in range(20)]
    plain = [(r["doc_id"], r["text"], None if k % 4 == 0 else r["lang"], r["source"], r["n_chars"]) for k, r in enumerate(rows)]
    return spark.createDataFrame(plain + junk + half, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stage_against_all_sets_of_languages(spark, small_docs):
    docs = with_junk(spark, small_docs)
    rows = docs.collect()
    model = plain_model([(r["text"], r["lang"]) for r in rows])
    got = {r["doc_id"]: r["lang"] for r in in_known_language(docs, F.lit(True)).collect()}
    want = {}
    for r in rows:
        lang, ok = plain_decision(model, r["text"])
        if ok:
            want[r["doc_id"]] = lang if r["lang"] is None else r["lang"]
    assert got == want
    # The model, not the letters, decides: long junk goes, and rows without a language get theirs.
    assert sum(i >= 10_000 and i < 20_000 for i in got) < 20
    truth = {r["doc_id"]: r["lang"] for r in small_docs.collect()}
    filled = [r["doc_id"] for r in rows if r["lang"] is None and r["doc_id"] < 10_000 and r["doc_id"] in got]
    assert len(filled) > 30 and np.mean([got[i] == truth[i] for i in filled]) >= 0.98


def test_rejected_rows(odd_docs):
    kept = in_known_language(odd_docs, F.lit(True))
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 8, 8, 8, 9, 10, 11]


def test_without_any_language_all_texts_with_letters_stay(odd_docs, no_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    for docs in (unlabelled, odd_docs.withColumn("lang", F.lit(None))):
        kept = in_known_language(docs, F.lit(True)).collect()
        assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 2, 3, 8, 8, 8, 9, 10, 11]
        assert len(kept) == in_known_language(odd_docs, F.lit(True)).count()
    assert in_known_language(odd_docs, F.lit(False)).count() == len(kept)
    assert in_known_language(no_docs, F.lit(True)).count() == 0
