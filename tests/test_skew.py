"""Hot keys, ties and nulls: both plans of each operator against brute force."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators.aggregates import collect_parts, concat_group
from lakeops.operators.joins import asof_join, assign_round_robin, attach_members, latest_stock_join, same_day_join
from lakeops.operators.numbering import following_pairs, largest_group, number_rows, surrogate_key
from lakeops.operators.windows import rank_best, repeat_purchase
from lakeops.plans.orders import gold_order_details, gold_orders
from lakeops.plans.table_functions import summarize_inquiries
from lakeops.streaming.sessions import label_sessions, sessionize

PLANS = pytest.mark.parametrize("max_rows", [10**9, 0], ids=["window", "split"])


def hot_rows(n=3000, seed=1):
    """Rows of which a third belong to one key; some keys are null."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if i % 3 == 0 else rnd.choice([None, *range(20)])
        rows.append((i, key, rnd.randrange(40), rnd.choice("abc")))
    return rows


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id bigint, k int, t int, v string").repartition(6).cache()


def test_largest_group(hot):
    sizes = defaultdict(int)
    for _, k, _, _ in hot_rows():
        sizes[k] += 1
    assert largest_group(hot, ["k"]) == max(sizes.values())


@PLANS
def test_number_rows(hot, max_rows):
    got = {r["id"]: r["n"] for r in number_rows(hot, ["k"], ["t", "id"], "n", max_rows).collect()}
    groups = defaultdict(list)
    for i, k, t, _ in hot_rows():
        groups[k].append((t, i))
    want = {i: n + 1 for g in groups.values() for n, (_, i) in enumerate(sorted(g))}
    assert got == want


def test_surrogate_key_is_dense_and_ordered(hot):
    got = sorted((r["n"], r["t"], r["id"]) for r in surrogate_key(hot, ["t", "id"], "n").collect())
    assert [g[0] for g in got] == list(range(1, len(got) + 1))
    assert [g[1:] for g in got] == sorted((t, i) for i, _, t, _ in hot_rows())


@PLANS
def test_following_pairs(hot, max_rows):
    got = {(r["source"], r["target"]): r["weight"]
           for r in following_pairs(hot, ["k"], ["t", "id"], "v", max_rows).collect()}
    groups, want = defaultdict(list), defaultdict(int)
    for i, k, t, v in hot_rows():
        groups[k].append((t, i, v))
    for g in groups.values():
        g.sort()
        for a, b in zip(g, g[1:]):
            want[a[2], b[2]] += 1
    assert got == dict(want)


@PLANS
def test_repeat_purchase(hot, max_rows):
    """Null users and dates are kept; a null date is no predecessor."""
    day0 = date(2024, 1, 1)
    lines = hot.withColumn("d", F.when(F.col("t") > 0, F.date_add(F.lit(day0), F.col("t"))))
    got = {r["id"]: (r["is_repeat_purchase"], r["days_since_last_purchase"])
           for r in repeat_purchase(lines, ["k", "v"], "d", ["id"], max_rows).collect()}
    groups, want = defaultdict(list), {}
    for i, k, t, v in hot_rows():
        groups[k, v].append((t, i))
    for g in groups.values():
        g.sort()
        for n, (t, i) in enumerate(g):
            before = g[n - 1][0] if n else 0
            want[i] = (before > 0, t - before if before else None)
    assert got == want


@PLANS
def test_asof_join(spark, hot, max_rows):
    day0 = date(2024, 1, 1)
    left = hot.select("id", "k", F.date_add(F.lit(day0), F.col("t")).alias("d"))
    rnd = random.Random(5)
    stock = [(rnd.choice([7, 7, 7, *range(10)]), day0 + timedelta(days=rnd.randrange(40)), rnd.randrange(100)) for _ in range(400)]
    right = spark.createDataFrame(stock, "k int, sd date, q int")
    got = {r["id"]: (r["sd"], r["q"])
           for r in asof_join(left, right, ["k"], "d", "sd", ["q"], ["q"], max_rows).collect()}
    want = {}
    for i, k, t, _ in hot_rows():
        past = [(sd, q) for kk, sd, q in stock if kk == k and sd <= day0 + timedelta(days=t)]
        want[i] = max(past) if past else (None, None)
    assert got == want


def test_asof_join_null_keys_match(spark):
    left = spark.createDataFrame([(1, None, date(2024, 1, 5))], "id int, k int, d date")
    right = spark.createDataFrame([(None, date(2024, 1, 2), 4)], "k int, sd date, q int")
    for limit in (10**9, 0):
        assert asof_join(left, right, ["k"], "d", "sd", ["q"], [], limit).first()["q"] == 4


def test_latest_stock_is_dropped_when_later(spark):
    left = spark.createDataFrame([(1, 1, date(2024, 1, 5)), (2, 1, date(2024, 1, 9))], "id int, k int, d date")
    right = spark.createDataFrame([(1, date(2024, 1, 2), 4), (1, date(2024, 1, 8), 6)], "k int, sd date, q int")
    got = {r["id"]: r["q"] for r in latest_stock_join(left, right, ["k"], "d", "sd", ["q"]).collect()}
    assert got == {1: None, 2: 6}


def test_latest_stock_null_keys_match_and_the_right_side_is_shuffled_once(spark):
    day = date(2024, 1, 2)
    left = spark.createDataFrame([(1, 1, None, day), (2, 1, "", day), (3, None, "a", day), (4, 0, "a", day)], "id int, k int, s string, d date")
    right = spark.createDataFrame([(1, None, day, 4), (1, "", day, 5), (0, "a", day, 6)], "k int, s string, sd date, q int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = latest_stock_join(left, right, ["k", "s"], "d", "sd", ["q"])
        assert {r["id"]: r["q"] for r in joined.collect()} == {1: 4, 2: 5, 3: None, 4: 6}
        fresh = latest_stock_join(left, right, ["k", "s"], "d", "sd", ["q"])
        assert fresh._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # left and right
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("max_bytes", [1 << 30, 2000], ids=["whole", "parts"])
def test_collect_parts_keeps_every_member(hot, max_bytes):
    parts = collect_parts(hot, ["k"], F.struct("t", "v"), ["id"], max_bytes).collect()
    got, want = defaultdict(list), defaultdict(list)
    for r in parts:
        got[r["k"]] += [tuple(x) for x in r["items"]]
        assert [tuple(x) for x in r["items"]] == sorted(tuple(x) for x in r["items"])
    for _, k, t, v in hot_rows():
        want[k].append((t, v))
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}
    hot_parts = [r for r in parts if r["k"] == 7]
    assert len(hot_parts) == 1 if max_bytes > 2000 else len(hot_parts) > 10


@pytest.mark.parametrize("max_bytes", [1 << 30, 100], ids=["whole", "parts"])
def test_order_totals_at_any_list_size(spark, max_bytes):
    lines = spark.createDataFrame([(1, n, n, 1.0, 2.0, "c", 9) for n in range(40)] + [(None, 50, 1, 3.0, 4.0, "c", 9)],
                                  "order_id int, order_item_id int, item_id int, quantity double, subtotal double, category_name string, user_id int")
    lines = lines.withColumn("unit_price", F.lit(2.0))
    totals = {r["order_id"]: (r["order_quantity"], r["order_amount"]) for r in gold_orders(lines, ["user_id"]).collect()}
    assert totals == {1: (40.0, 80.0), None: (3.0, 4.0)}
    parts = gold_order_details(lines, max_bytes)
    back = parts.select("order_id", F.explode("order_details").alias("d")).groupBy("order_id").agg(F.sum("d.quantity").alias("q"))
    assert {r["order_id"]: r["q"] for r in back.collect()} == {1: 40.0, None: 3.0}
    assert parts.filter("order_id = 1").count() > 1 if max_bytes == 100 else parts.count() == 2


def test_summaries_keep_the_null_category(spark):
    survey = spark.createDataFrame([("a", "x one. more", 1.0), ("a", "y two", 3.0), (None, "z", 5.0)],
                                   "survey_category string, response_content string, positive_score double")
    for max_bytes in (1 << 20, 1):
        got = {r["survey_category"]: (r["positive_score"], r["n_responses"]) for r in summarize_inquiries(survey, max_bytes=max_bytes).collect()}
        assert got == {"a": (2.0, 2), None: (5.0, 1)}
    assert {r["survey_category"]: r["summary"] for r in summarize_inquiries(survey).collect()} == {"a": "x one", None: "z"}


def test_events_without_user_or_time_keep_a_session(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, None, at), (2, None, at + timedelta(hours=2)), (3, 5, None), (4, 5, at)], "id int, u int, ts timestamp")
    got = {r["id"]: r["session_no"] for r in label_sessions(df, "u", "ts").collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}


def test_concat_group_joins_sorted_text(spark):
    df = spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 2, None)], "id int, k int, s string")
    got = {r["k"]: r["text"] for r in concat_group(df, ["k"], "s", ["id"]).collect()}
    assert got == {1: "a b", 2: ""}


def test_round_robin(spark, hot):
    texts = spark.createDataFrame([(7, 1, "x"), (7, 2, "y"), (3, 3, "z")], "k int, no int, s string")
    left = hot.filter("k IS NOT NULL")
    got = {r["id"]: r["s"] for r in assign_round_robin(left, texts, "k", ["id"], ["no"], "s").collect()}
    pool, seen, want = {7: ["x", "y"], 3: ["z"]}, defaultdict(int), {}
    for i, k, _, _ in hot_rows():
        if k is not None:
            want[i] = pool[k][seen[k] % len(pool[k])] if k in pool else None
            seen[k] += 1
    assert got == want


def test_attach_members(spark, hot):
    members = spark.createDataFrame([(7, 30), (7, 10), (7, 20), (2, 5)], "k int, m int")
    got = {r["id"]: r["picked"] for r in attach_members(hot.filter("k IS NOT NULL"), members, "k", "m", F.col("id")).collect()}
    pool = {7: [10, 20, 30], 2: [5]}
    assert got == {i: (pool[k][i % len(pool[k])] if k in pool else None) for i, k, _, _ in hot_rows() if k is not None}


def test_same_day_join_does_not_multiply(spark):
    orders = spark.createDataFrame([(1, 9, date(2024, 1, 1)), (2, 9, date(2024, 1, 2))], "id int, u int, d date")
    logs = spark.createDataFrame([(9, date(2024, 1, 1), n, f"e{n}") for n in range(5)], "lu int, ld date, n int, e string")
    got = {r["id"]: (r["e"], r["n_logs"]) for r in same_day_join(orders, logs, "u", "d", "lu", "ld", ["n"], ["e"]).collect()}
    assert got == {1: ("e4", 5), 2: (None, 0)}


def test_same_day_join_with_attributes_of_the_user(spark):
    # Users: 9 has logs and attributes (two rows of them), 8 logs only, 7 attributes only, 6 neither; one order has no user, one no day.
    orders = spark.createDataFrame(
        [(1, 9, date(2024, 1, 1), "EC"), (2, 9, date(2024, 1, 2), "EC"), (3, 8, date(2024, 1, 1), "EC"), (4, 7, date(2024, 1, 1), "EC"),
         (5, 6, date(2024, 1, 1), "EC"), (6, None, date(2024, 1, 1), "EC"), (7, 8, None, "EC"), (8, 8, date(2024, 1, 1), "POS"), (9, 8, date(2024, 1, 1), None)],
        "id int, u int, d date, c string")
    days = [date(2024, 1, 1), date(2024, 1, 3), None]
    logs = spark.createDataFrame([(u, d, n, f"e{n}") for u in (9, 8, None) for d in days for n in range(3)], "lu int, ld date, n int, e string")
    users = spark.createDataFrame([(9, "x"), (9, "y"), (7, "z"), (None, "no one")], "u int, name string")
    args = ("u", "d", "lu", "ld", ["n"], ["e"], F.col("c") == "EC")
    want = same_day_join(orders, logs, *args).join(users, "u", "left").select("id", "u", "d", "c", "e", "n_logs", "name")
    got = same_day_join(orders, logs, *args, users)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 11


@pytest.mark.parametrize("strict", [False, True])
def test_sessions_against_loop(spark, strict):
    rnd = random.Random(3)
    start = datetime(2024, 1, 1)
    events = []
    for u in (1, 1, 1, 2, 3):
        at = start
        for _ in range(80):
            at += timedelta(seconds=rnd.choice([1, 60, 600, 1799, 1800, 1801, 4000]))
            events.append((len(events), u, at))
    df = spark.createDataFrame(events, "id int, u int, ts timestamp")
    want, labels = [], {}
    for u in (1, 2, 3):
        mine = sorted((ts, i) for i, uu, ts in events if uu == u)
        no = 0
        for n, (ts, i) in enumerate(mine):
            gap = (ts - mine[n - 1][0]).total_seconds() if n else None
            if gap is None or (gap > 1800 if strict else gap >= 1800):
                no += 1
                want.append([u, no, ts, ts, 0])
            want[-1][3], want[-1][4] = ts, want[-1][4] + 1
            labels[i] = no
    got = sorted([r["u"], r["session_no"], r["session_start"], r["session_end"], r["n_events"]]
                 for r in sessionize(df, "u", "ts", strict=strict).collect())
    assert got == sorted(want)
    assert {r["id"]: r["session_no"] for r in label_sessions(df, "u", "ts", strict=strict).collect()} == labels


def test_ties_of_a_hot_group(hot):
    got = {r["id"] for r in rank_best(hot, ["k"], "t", descending=True).collect()}
    best = defaultdict(int)
    for _, k, t, _ in hot_rows():
        best[k] = max(best[k], t)
    assert got == {i for i, k, t, _ in hot_rows() if t == best[k]}
