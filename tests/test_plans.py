"""Forecasts, text models, features and cleansing on small fixtures."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.functions import dates as D
from lakeops.operators import text as X
from lakeops.operators.clean import cast_to_schema, clean_names
from lakeops.operators.windows import latest_per_key, rank_best
from lakeops.plans import customers as CU
from lakeops.plans import demand as DM
from lakeops.plans import features as FT
from lakeops.plans import recommend as RC
from lakeops.plans import table_functions as TF
from lakeops.queries import QUERIES
from lakeops.session import work_dir


def seasonal(n, start=date(2020, 1, 1)):
    rng = np.random.default_rng(0)
    out = []
    for i in range(n):
        level = (50 + 0.02 * i) * (1 + 0.4 * np.sin(2 * np.pi * i / 7)) * (1 + 0.2 * np.sin(2 * np.pi * i / 365.25))
        out.append((1, start + timedelta(days=i), int(max(0, level + rng.normal(0, 2)))))
    return out


def test_forecast_beats_the_mean(spark):
    days = seasonal(900)
    df = spark.createDataFrame(days[:810], "k int, ds date, y bigint")
    out = {r["ds"]: r for r in DM.forecast(df, ["k"]).collect()}
    assert len(out) == 900
    actual = np.array([y for _, _, y in days[810:]], dtype=float)
    pred = np.array([out[d]["yhat"] for _, d, _ in days[810:]])
    mean = np.mean([y for _, _, y in days[:810]])
    assert np.abs(actual - pred).mean() < 0.5 * np.abs(actual - mean).mean()
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in out.values())
    assert sum(r["y"] is None for r in out.values()) == 90


@pytest.mark.parametrize("values", [[5], [3, 3, 3, 3], [0, 0, 0], [1, 2, 3, 4, 5, 6, 7, 8]])
def test_forecast_of_short_series(spark, values):
    rows = [(1, date(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)]
    out = DM.forecast(spark.createDataFrame(rows, "k int, ds date, y bigint"), ["k"], horizon=10).collect()
    assert len(out) == len(values) + 10
    assert all(r["yhat"] >= 0 and np.isfinite(r["yhat"]) for r in out)


def test_forecast_of_empty_series_and_sums_of_days(spark):
    rows = [("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 1), 2), ("b", date(2024, 1, 1), None)]
    out = DM.forecast(spark.createDataFrame(rows, "k string, ds date, y bigint"), ["k"], horizon=2).collect()
    assert [r["y"] for r in out if r["y"] is not None] == [3.0]
    empty = [r for r in out if r["k"] == "b"]
    assert len(empty) == 3 and all(r["yhat"] is None and r["yhat_upper"] is None for r in empty)


def test_band_of_any_level(spark):
    df = spark.createDataFrame(seasonal(60), "k int, ds date, y bigint")
    width = {}
    for level in (0.5, 0.85, 0.95, 0.999):
        r = DM.forecast(df, ["k"], horizon=1, level=level).orderBy(F.col("ds").desc()).first()
        width[level] = r["yhat_upper"] - r["yhat_lower"]
    assert sorted(width, key=width.get) == sorted(width) and len(set(width.values())) == 4
    with pytest.raises(ValueError):
        DM.fit_series(np.arange(3.0), np.ones(3), 1, 1.5)


def test_forecast_metrics_skip_zero_and_null(spark):
    df = spark.createDataFrame([(1, 10.0, 8.0), (1, 0.0, 1.0), (1, None, 5.0), (1, 20.0, 25.0)], "k int, y double, yhat double")
    r = DM.forecast_metrics(df, ["k"], "y", "yhat").first()
    assert r["mae"] == pytest.approx(8 / 3) and r["mse"] == pytest.approx(10.0) and r["rmse"] == pytest.approx(10 ** 0.5)
    assert r["mape"] == pytest.approx(22.5) and r["mdape"] == pytest.approx(22.5)


def test_text_model_errors_become_null(spark):
    def scorer():
        def score(batch):
            if any(s == "bad" for s in batch):
                raise RuntimeError("service down")
            return [s + "!" for s in batch]
        return score
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id int, s string").coalesce(1)
    assert {r["id"]: r["result"] for r in X.map_text(df, "s", scorer).collect()} == {1: "a!", 2: None, 3: "c!"}


def test_scorers_get_few_texts_at_once(spark):
    """However long the texts, a call gets a bounded number of bytes; nulls and the longest text alone pass as well."""
    def scorer():
        return lambda batch: [str(sum(len(s or "") for s in batch)) if len(batch) > 1 else "0" for _ in batch]
    df = spark.range(90).coalesce(1).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("x"), F.when(F.col("id") == 5, 6 << 20).otherwise(1 << 18))).alias("s"))
    got = [int(r["result"]) for r in X.map_text(df, "s", scorer).select("result").collect()]
    assert len(got) == 90 and 0 < max(got) <= X.BYTES_AT_ONCE

    def rated():
        return lambda batch: [("1 star", 1.0 if sum(map(len, batch)) <= X.BYTES_AT_ONCE else 0.0) for _ in batch]
    rows = X.sentiment(df.filter("id > 7"), "s", rated).select("positive_score").collect()
    assert len(rows) == 82 and all(r["positive_score"] == 1.0 for r in rows)


def test_a_bad_row_costs_few_calls():
    calls = []

    def scorer(batch):
        calls.append(len(batch))
        if "bad" in batch:
            raise RuntimeError("service down")
        return [s + "!" for s in batch]
    values = ["a"] * 500 + ["bad"] + ["b"] * 523
    assert X._safe_call(scorer, values, 0) == ["a!"] * 500 + [None] + ["b!"] * 523
    assert len(calls) <= 2 * 11


def test_sentiment_of_failed_row_is_null(spark):
    def scorer():
        return lambda batch: [("4 stars", 0.5) if s else 1 / 0 for s in batch]
    df = spark.createDataFrame([(1, "fine"), (2, "")], "id int, s string")
    assert {r["id"]: r["positive_score"] for r in X.sentiment(df, "s", scorer).collect()} == {1: 2.0, 2: None}


def test_process_in_batches_restarts(spark):
    out = work_dir(spark, "batches")
    docs = spark.range(25).select(F.col("id"), F.lit("x").alias("s"))

    def work(df):
        return df.select("batch_id", "id")

    X.process_in_batches(docs.filter("id < 6"), "id", 10, work, out)  # a batch that will grow
    assert X.process_in_batches(docs, "id", 10, work, out).count() == 25
    assert X.process_in_batches(docs, "id", 10, work, out).count() == 25


def test_process_in_batches_writes_no_file_per_batch(spark):
    out = work_dir(spark, "many-batches")
    docs = spark.range(400).coalesce(2)
    for part in (docs.filter("id % 3 = 0"), docs):
        got = X.process_in_batches(part, "id", 2, lambda df: df.select("batch_id", "id"), out)
    assert sorted((r["id"], r["batch_id"]) for r in got.collect()) == [(i, i // 2) for i in range(400)]
    assert len(got.inputFiles()) <= 4


def test_group_texts_fills_ratings(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, "c", 2), (4, "d", None)], "n int, s string, r int")
    got = sorted(tuple(r) for r in X.group_texts(df, ["n"], "s", ["r"]).collect())
    assert got == [(1, "a", "b", "c", 5), (2, "d", None, None, 3)]


def test_prompt_template_in_any_order(spark):
    df = spark.createDataFrame([(1, "{topic} stays text")], "id int, s string")
    out = {r["prompt"] for r in X.prompts(df, "s", ["food"], ["good", "bad"], "{polarity}/{topic}: {text}.").collect()}
    assert out == {"good/food: {topic} stays text.", "bad/food: {topic} stays text."}


def test_dirty_sensor_rows(spark):
    # The dirty readings of the sensor sample.
    data = [("DEV001", "23.5", "65.2", "active"), ("DEV002", "", "70.1", "inactive"), ("DEV003", "25.8", " ", "active"),
            ("DEV004", "N/A", "68.9", "error"), ("DEV006", "26.3", "71.2", "")]
    df = spark.createDataFrame(data, "id string, temperature string, humidity string, status string")
    got = df.select("id", C.clean_numeric("temperature").alias("t"), C.clean_numeric("humidity").alias("h"),
                    C.clean_text("status").alias("s")).collect()
    assert [tuple(r) for r in got] == [("DEV001", 23.5, 65.2, "active"), ("DEV002", None, 70.1, "inactive"),
                                       ("DEV003", 25.8, None, "active"), ("DEV004", None, 68.9, "error"),
                                       ("DEV006", 26.3, 71.2, None)]


def test_unreadable_values_are_null(spark):
    df = spark.createDataFrame([("1/2/24 3:04", "19th July 2023", "July 2023", "0.7"), ("x", "July", "2023", "high"),
                                (None, None, None, "7")], "a string, b string, c string, d string")
    got = [tuple(str(x) if x is not None else None for x in r) for r in df.select(
        D.loose_timestamp("a").alias("a"), D.ordinal_date("b").alias("b"), D.month_text("c").alias("c"), C.to_score("d").alias("d")).collect()]
    assert got == [("2024-01-02 03:04:00", "2023-07-19", "2023-07", "0.7"), (None, None, None, None), (None, None, None, "1.0")]


def test_clean_names_and_schema(spark):
    df = spark.createDataFrame([("1", "x")], ["a (b c)", "n"])
    assert clean_names(df).columns == ["a-bc", "n"]
    assert tuple(cast_to_schema(df.toDF("a", "n"), "a int, n int").first()) == (1, None)


def test_segments_keep_the_gap_and_nulls(spark):
    df = spark.createDataFrame([(1,), (4,), (5,), (51,), (None,)], "n int")
    assert [r[0] for r in df.select(CU.frequency_segment("n")).collect()] == ["01_1回", "00_その他", "04_5-10回", "07_50回以上", "00_その他"]
    assert [r[0] for r in df.select(CU.recency_segment("n")).collect()] == ["01_7日以内"] * 3 + ["04_60日以内", "08_それ以上"]


def test_channel_of_missing_dates(spark):
    d = date(2024, 1, 1)
    df = spark.createDataFrame([(1, None, None, None, None), (2, None, d, None, d), (3, d, None, d, None), (4, d, d, d, d)],
                               "u int, first_purchase_date_pos date, first_purchase_date_ec date, "
                               "last_purchase_date_pos date, last_purchase_date_ec date")
    got = {r["u"]: (r["first_purchase_channel"], r["last_purchase_channel"]) for r in CU.channel_of(df).collect()}
    assert got == {1: ("POS", "POS"), 2: ("EC", "EC"), 3: ("POS", "POS"), 4: ("POS", "POS")}


def test_abandoned_cart_lists_in_parts(spark):
    carts = spark.createDataFrame([(1, 10, 0, date(2024, 1, 1)), (2, 10, 1, date(2024, 1, 2))], "cart_id int, user_id int, status int, updated_date date")
    items = spark.createDataFrame([(1, n, 1, 1.0, n % 2) for n in range(40)] + [(2, 99, 1, 1.0, 1)],
                                  "cart_id int, cart_item_id int, quantity int, unit_price double, item_status int")
    one = CU.abandoned_carts(carts, items).first()
    assert (one["last_cart_id"], one["abandoned_cart_available_item_count"], one["abandoned_cart_item_count"]) == (2, 20, 40)
    parts = CU.abandoned_cart_lists(carts, items, max_bytes=500)
    ids = parts.select(F.explode(F.from_json("abandoned_cart_item_list", "array<struct<item_id:int>>")).alias("x")).select("x.item_id")
    assert parts.count() > 1 and sorted(r[0] for r in ids.collect()) == list(range(40))
    nothing_left = CU.abandoned_cart_lists(carts.withColumn("status", F.lit(1)), items).collect()
    assert [tuple(r) for r in nothing_left] == [(10, 0, "[]")]


def test_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], "k int, t int, v string")
    assert [r["v"] for r in latest_per_key(df, ["k"], ["t"], ["v"]).collect()] == ["b"]
    assert {r["v"] for r in rank_best(df, ["k"], "t", descending=True).collect()} == {"a", "b"}


def test_rerank_splits_by_preference(spark):
    recs = spark.createDataFrame([(u, i, float(i)) for u in (1, 2, 3) for i in range(10)], "u int, i int, rating double")
    items = spark.createDataFrame([(i, "film" if i % 2 else "music") for i in range(10)], "i int, cat string")
    prefs = spark.createDataFrame([(1, "film"), (2, "news")], "u int, preference string")
    booked = spark.createDataFrame([(1, "b1"), (2, "b2"), (3, "b3")], "u int, booking string")
    out = RC.rerank(recs, booked, prefs, items, "u", "i", "cat", "film", n=3).collect()
    assert sorted((r["u"], r["i"]) for r in out) == [(1, 5), (1, 7), (1, 9), (2, 4), (2, 6), (2, 8)]


def test_inventory_report_needs_the_best_seller(spark):
    sales = spark.createDataFrame([(1, 10, 5.0), (1, 11, 9.0)], "store_id int, product_id int, sales_value double")
    products = spark.createDataFrame([(10, "a"), (11, "b")], "product_id int, name string")
    assert TF.store_product_inventory(sales, products, 1, 10).count() == 0
    assert TF.store_product_inventory(sales, products, 1, 11).count() == 1
    assert TF.store_product_inventory(sales, products, 1, 10, any_rank=True).first()["total_sales"] == 5.0


def test_split_and_rebalance(spark):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    parts = {(r["split"], r["y"]): r["count"] for r in FT.split(df, "id", {"train": 0.6, "val": 0.2, "test": 0.2}).groupBy("split", "y").count().collect()}
    for y, n in ((0, 3600), (1, 400)):
        assert abs(parts["train", y] / n - 0.6) < 0.08
    counts = {r["y"]: r["count"] for r in FT.rebalance(df, "y", "id").groupBy("y").count().collect()}
    assert counts[1] == 800 and abs(counts[0] - 2400) < 200


def test_one_hot_refuses_many_values(spark):
    with pytest.raises(ValueError, match="more than"):
        FT.distinct_values(spark.range(50).select(F.col("id").cast("string").alias("c")), ["c"], limit=10)


def test_one_hot_long_has_every_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") != 7, F.concat(F.lit("v"), "id")).alias("c"), (F.col("id") % 2).alias("d"))
    rows = {tuple(r) for r in FT.one_hot_long(df, "id", ["c", "d"]).collect()}
    assert rows == {(i, "c", f"v{i}") for i in range(3000) if i != 7} | {(i, "d", str(i % 2)) for i in range(3000)}
    few = df.filter("id < 20")
    wide = FT.one_hot(few, FT.distinct_values(few, ["c"])).collect()
    ones = {(r["id"], "c", n[2:]) for r in wide for n, v in r.asDict().items() if n.startswith("c_") and v == 1}
    assert ones == {r for r in rows if r[0] < 20 and r[1] == "c"}


def test_account_window_quirk(spark):
    tx = spark.createDataFrame([(1, 5, date(2024, 1, 20), 10.0), (1, 6, date(2023, 11, 20), 20.0), (1, None, date(2023, 3, 1), 5.0)],
                               "payer int, payee int, d date, amt double")
    r = FT.window_features(tx, "payer", "payee", "d", "amt", "2024-01-31").first()
    assert (r["sent_txn_cnt_12m"], r["sent_party_cnt_12m"], r["sent_txn_amt_12m"]) == (3, 2, 35.0)
    assert (r["sent_txn_cnt_3m"], r["sent_party_cnt_3m"]) == (2, 2)
    old = FT.window_features(tx, "payer", "payee", "d", "amt", "2024-01-31", count_other=False).first()
    assert old["sent_party_cnt_12m"] == 1


def test_dense_ids_for_als(spark):
    big = spark.createDataFrame([("u%03d" % (i % 7), 10**12 + i % 5, 1.0) for i in range(60)], "u string, i bigint, rating double")
    indexed = RC.dense_ids(RC.dense_ids(big, "u", "uid"), "i", "iid")
    assert sorted(r[0] for r in indexed.select("uid").distinct().collect()) == list(range(1, 8))
    model = RC.train_als(indexed.select("uid", "iid", "rating"), "uid", "iid", rank=2, max_iter=1)
    flat = RC.flatten_recs(RC.recommend(model, 3), "uid")
    assert flat.groupBy("uid").count().filter("count = 3").count() == 7


def test_better_items_left_out_are_counted(spark):
    """A better item counts even if its user has never taken it; every user has a row."""
    from lakeops.queries.recommendations import _better_left_out

    ratings = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(12) if (u + i) % 3 == 0], "user_id int, item_id int, rating double")
    model = RC.train_als(ratings, "user_id", "item_id", rank=2, max_iter=2, seed=1)
    recs = RC.recommend(model, 5)
    assert {tuple(r) for r in _better_left_out(model, recs).collect()} == {(u, 5, 0) for u in range(9)}
    full = RC.recommend(model, 12).collect()
    worst = [(r["user_id"], r["recommendations"][-1:]) for r in full]
    want = {(r["user_id"], 1, sum(x["rating"] > r["recommendations"][-1]["rating"] + 1e-4 for x in r["recommendations"])) for r in full}
    assert {tuple(r) for r in _better_left_out(model, spark.createDataFrame(worst, recs.schema)).collect()} == want
    assert any(n for _, _, n in want)
    registered = QUERIES["rc4_top_items_of_all_users"](spark, "/root/testdata/sf0.001").select("user_id")
    buyers = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").join(
        spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), F.col("o_orderkey") == F.col("l_orderkey"))
    assert {r[0] for r in registered.collect()} == {r[0] for r in buyers.select("o_custkey").distinct().collect()}


def test_ratings_of_a_model_are_computed_once(spark):
    """What training and later checks read is a written table, not the join of lines and orders again."""
    from lakeops.queries.recommendations import _model
    from lakeops.queries.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    ratings, _ = _model(t)
    assert "Join" not in ratings._jdf.queryExecution().executedPlan().toString()
    assert ratings.count() == t.lines.select("user_id", "item_id").distinct().count()


def test_blocks_of_the_training_follow_the_ratings(spark):
    """A task of the training holds a block, so there are more blocks, not larger ones, where there are more ratings."""
    assert RC.als_blocks(0) == RC.als_blocks(10 * RC.RATINGS_PER_BLOCK) == 10  # as many as Spark takes by itself
    for n in (100_000_000, 216_000_000, 2_160_000_000):
        blocks = RC.als_blocks(n)
        assert n / blocks <= RC.RATINGS_PER_BLOCK < 1.3 * n / blocks and all(blocks % d for d in range(2, blocks))
    ratings = spark.createDataFrame([(3 * u, 2 * i, 1.0) for u in range(40) for i in range(40) if (u + i) % 2], "user_id int, item_id int, rating double")
    model = RC.train_als(ratings, "user_id", "item_id", rank=2, per_block=50)
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == 17  # 800 ratings, 16 blocks or more
    everything = model.userFactors.selectExpr("id AS user_id").crossJoin(model.itemFactors.selectExpr("id AS item_id"))
    scores = {(r["user_id"], r["item_id"]): r["prediction"] for r in RC.score_pairs(model, everything).collect()}
    taken = {(r["user_id"], r["item_id"]) for r in ratings.collect()}
    assert len(scores) == 1600 and min(scores[p] for p in taken) > max(scores[p] for p in scores if p not in taken)


def test_pairs_are_scored_right_with_more_blocks(spark, monkeypatch):
    """Training of the registered queries takes its blocks from the number of ratings; factors and scores are whole with any."""
    asked = []
    monkeypatch.setattr(RC, "als_blocks", lambda n, per_block: asked.append(n) or 17)
    out = QUERIES["rc12_scored_pairs"](spark, "/root/testdata/sf0.001")
    pairs = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").join(
        spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey").distinct()
    want = {(u, i, True) for u, i in pairs.collect()}
    assert {tuple(r) for r in out.collect()} == want and asked == [len(want)]
