"""Exact top-k by inner product against all pairs."""

import numpy as np
import pytest

from lakeops.plans.inner_products import best_k, items_above, top_items


def frame(spark, vectors, ids=None):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(range(len(vectors)) if ids is None else ids, vectors)]
    return spark.createDataFrame(rows, "id bigint, features array<double>")


def brute(users, items, k, ids=None):
    out = {}
    for u, row in enumerate(users):
        scores = [(-float(row @ v), int(i)) for i, v in zip(range(len(items)) if ids is None else ids, items)]
        out[u] = [i for _, i in sorted(scores)[:k]]
    return out


def result(users, items, k, **parameters):
    rows = top_items(users, items, k, **parameters).collect()
    for r in rows:
        scores = [x["score"] for x in r["found"]]
        assert scores == sorted(scores, reverse=True)
    return {r["id"]: [x["item"] for x in r["found"]] for r in rows}, {r["id"]: r["n_scored"] for r in rows}


@pytest.mark.parametrize("parameters", [{}, {"block_rows": 16, "slab_bytes": 5000}, {"block_rows": 7, "slab_bytes": 1}])
def test_all_users_against_all_pairs(spark, parameters):
    rng = np.random.default_rng(1)
    users = rng.normal(size=(200, 6)) * rng.lognormal(0, 1, (200, 1))
    items = rng.normal(size=(700, 6)) * rng.lognormal(0, 1, (700, 1))
    got, scored = result(frame(spark, users), frame(spark, items), 5, **parameters)
    assert got == brute(users, items, 5)
    if parameters:  # far fewer than all pairs
        assert sum(scored.values()) < 0.3 * 200 * 700


def test_ties_repeated_items_and_negative_scores(spark):
    items = np.array([[1.0, 0], [1, 0], [0, 1], [-1, 0], [1, 0], [0, 0]])
    ids = [9, 3, 4, 5, 6, 7]
    users = np.array([[1.0, 0], [0, -1], [0, 0], [-2, 0]])
    got, _ = result(frame(spark, users), frame(spark, items, ids), 3, block_rows=2, slab_bytes=1)
    assert got == brute(users, items, 3, ids)
    assert got[0] == [3, 6, 9] and got[2] == [3, 4, 5]


def test_few_items_nulls_and_empty(spark):
    users, items = frame(spark, np.eye(2)), frame(spark, np.ones((2, 2)))
    nothing = frame(spark, np.empty((0, 2)))
    assert result(users, items, 10)[0] == {0: [0, 1], 1: [0, 1]}
    assert result(users, nothing, 3)[0] == {0: [], 1: []}
    assert result(nothing, items, 3)[0] == {}
    odd = users.unionByName(spark.createDataFrame([(None, [1.0, 1.0]), (7, None)], users.schema))
    assert result(odd, items.unionByName(odd.filter("id IS NULL OR id = 7")), 1)[0] == {0: [0], 1: [0]}


def test_best_k():
    scores, ids = np.array([[1.0, 5, 3, 3, 3], [5, 4, 3, 2, 1]]), np.array([[1, 2, 9, 4, 7], [1, 2, 3, 4, 5]])
    got, which = best_k(scores, ids, 3)
    assert [sorted(x) for x in which.tolist()] == [[2, 4, 7], [1, 2, 3]] and got.sum() == 11 + 12


@pytest.mark.parametrize("slab_bytes", [1 << 20, 1])
def test_items_above_a_limit_against_all_pairs(spark, slab_bytes):
    """Counted by slabs, with items of one norm, listed items left out and negative limits."""
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(60, 4)), rng.normal(size=(500, 4))
    items /= np.sqrt((items ** 2).sum(axis=1))[:, None]  # a join on classes of norms has a single key here
    scores = users @ items.T
    limits = np.quantile(scores, 0.99, axis=1)
    limits[:5] = -1e9
    listed = [np.argsort(-s)[:3].tolist() for s in scores]
    rows = [(u, users[u].tolist(), float(limits[u]), listed[u]) for u in range(60)]
    asked = spark.createDataFrame(rows, "id bigint, features array<double>, limit double, listed array<bigint>")
    got = {r["id"]: r["n_above"] for r in items_above(asked, frame(spark, items), slab_bytes=slab_bytes, users_per_task=20).collect()}
    want = {u: int((scores[u] > limits[u]).sum()) - int((scores[u][listed[u]] > limits[u]).sum()) for u in range(60)}
    assert got == {u: n for u, n in want.items() if n} and got[0] == 497


def test_bought_items_that_may_beat_the_list(spark):
    """No pair that scores above the last entry is lost by the bound on norms; most of the others are."""
    from types import SimpleNamespace

    from lakeops.queries.recommendations import _dot, _last_entries, _reaching

    rng = np.random.default_rng(5)
    u, i = rng.normal(size=(40, 4)).astype(np.float32), (rng.normal(size=(60, 4)) * rng.gamma(1.0, size=(60, 1))).astype(np.float32)
    u[3], u[4] = 0, -np.abs(u[4])
    model = SimpleNamespace(userFactors=spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(u)], "id int, features array<float>"),
                            itemFactors=spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(i)], "id int, features array<float>"))
    scores = u.astype(float) @ i.astype(float).T
    lists = [(n, [(int(at), float(scores[n, at])) for at in np.argsort(-scores[n])[2 if n % 2 else 0:][:5]]) for n in range(40)]
    last = _last_entries(spark.createDataFrame(lists, "user_id int, recommendations array<struct<item_id:int,rating:float>>"))
    pairs = spark.createDataFrame([(a, b) for a in range(40) for b in range(60)], "user_id int, item_id int")
    got = {(r["user_id"], r["item_id"]): r["score"] for r in _dot(model, _reaching(model, pairs, last)).collect()}
    for a in range(40):
        least = np.float32(min(s for _, s in lists[a][1]))
        above = {(a, b) for b in range(60) if scores[a, b] > float(least) + 1e-4}
        assert above <= set(got) and len(above) >= (4 if a % 2 and a != 3 else 0)
    assert all(abs(scores[k] - s) < 1e-9 for k, s in got.items())
    assert len(got) < 40 * 60 / 2


def test_users_that_are_done_are_stored_without_features(spark, monkeypatch):
    from lakeops.plans import inner_products

    stored, kept = [], inner_products._stored
    monkeypatch.setattr(inner_products, "_stored", lambda df, name: stored.append((name, kept(df, name))) or stored[-1][1])
    users = spark.createDataFrame([(n, [1.0, n / 9]) for n in range(9)], "id int, features array<double>")
    items = spark.createDataFrame([(n, [2.0 ** -n, 0.0]) for n in range(200)], "id int, features array<double>")
    found = inner_products.top_items(users, items, 2, block_rows=4, slab_bytes=400).collect()
    assert all([f["item"] for f in r["found"]] == [0, 1] for r in found) and len(found) == 9
    passed = [df for name, df in stored if name == "top-items"]
    assert passed and all(df.filter("open = (features IS NULL)").isEmpty() for df in passed)


def test_numbering_all_rows_shuffles_them_once(spark):
    from lakeops.operators.numbering import number_rows

    rows = spark.createDataFrame(spark.sparkContext.parallelize([(i, i * 7 % 1000) for i in range(1000)]), "id bigint, v bigint")  # of unknown size
    numbered = number_rows(rows, [], ["v"], "n")
    assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert numbered.filter("n <> v + 1").isEmpty() and numbered.count() == 1000
