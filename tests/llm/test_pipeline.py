import hashlib

import pytest
import tiktoken

import corpus_pipeline
from lakeops.llm.bpe import read_ranks
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_langid import plain_decision, plain_model
from tests.llm.test_mixing import expected as mix_targets
from tests.llm.test_simhash import brute as near

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, docs, tmp_path):
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        frames.append(docs)
    return frames


@pytest.mark.parametrize("which", ["given", "odd"])
def test_each_stage_against_brute_force(spark, odd_docs, small_docs, tmp_path, which):
    docs = (small_docs if which == "given" else odd_docs).select(*COLUMNS)
    before = docs.collect()
    known, unlike, apart, mixed, tokens = run_stages(spark, docs, tmp_path)
    assert known.columns == unlike.columns == apart.columns == mixed.columns == COLUMNS

    key = lambda r: (str(r["doc_id"]), r["text"])
    rows = sorted(known.collect(), key=key)
    model = plain_model([(r["text"], r["lang"]) for r in before])
    decided = [(r, *plain_decision(model, r["text"])) for r in before]
    want = [(r["doc_id"], r["text"], lang if r["lang"] is None else r["lang"], r["source"], r["n_chars"]) for r, lang, ok in decided if ok]
    assert list(map(tuple, rows)) == sorted(want, key=lambda r: (str(r[0]), r[1]))

    kept = {r[1] for r in exact(rows)}
    left = sorted(unlike.collect(), key=key)
    if which == "given":
        assert [r["doc_id"] for r in left] == [r["doc_id"] for r in rows if r["doc_id"] in kept]
    texts = ["".join((r["text"]).split(" ")) for r in left]
    assert len(set(texts)) == len(texts)

    last = sorted(apart.collect(), key=key)
    if which == "given":
        assert [r["doc_id"] for r in last] == sorted({r[2] for r in near(left)}, key=str)

    sizes, want = mix_targets(last)
    taken = {}
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    for source, n in taken.items():
        biggest = max(len(r["text"].split()) for r in last if r["source"] == source)
        assert n <= 2 * sizes[source] and abs(n - want[source]) <= biggest

    library = tiktoken.Encoding("t", pat_str=corpus_pipeline.public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(read_ranks(corpus_pipeline.RANKS))})
    text_of = {}
    for r in mixed.collect():
        text_of.setdefault(r["doc_id"], set()).add((len(library.encode_ordinary(r["text"])), hashlib.sha256(r["text"].encode()).hexdigest()))
    found = tokens.collect()
    assert len(found) == mixed.count()
    assert all((r["n_tokens"], r["decoded_sha256"]) in text_of[r["doc_id"]] for r in found)


def test_run_is_the_stages(spark, small_docs, tmp_path):
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert whole == sorted(map(tuple, run_stages(spark, small_docs, tmp_path)[-1].collect()))


def test_empty_documents(spark, no_docs, tmp_path):
    assert [f.count() for f in run_stages(spark, no_docs.select(*COLUMNS), tmp_path)] == [0] * 5
