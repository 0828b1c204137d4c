"""2.16 feature engineering and models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.operators.aggregates import distribution
from lakeops.operators.joins import hashed_join, min_group, role_join
from lakeops.operators.sampling import exact_split
from lakeops.plans import features as FT
from lakeops.plans.shapley import explain
from lakeops.queries.registry import AS_OF, query
from lakeops.queries.sql import money
from lakeops.session import work_dir
from lakeops.sources.writers import append_table


def _window_sql(key, other, prefix):
    parts = []
    for m in (12, 6, 3):
        hit = f"CAST(datetime AS DATE) >= CAST(DATE '{AS_OF}' - INTERVAL {m} MONTH AS DATE)"
        amt = f"CAST(sum(CASE WHEN {hit} THEN CAST(txn_amt AS DECIMAL(18,2)) END) AS DOUBLE)"
        n = f"count(CASE WHEN {hit} THEN 1 END)"
        parts.append(f"nullif(count(DISTINCT CASE WHEN {hit} THEN {other} END), 0) AS {prefix}_party_cnt_{m}m, nullif({n}, 0) AS {prefix}_txn_cnt_{m}m, "
                     f"{amt} AS {prefix}_txn_amt_{m}m, {amt} / nullif({n}, 0) AS {prefix}_amt_avg_{m}m")
    first = f"CAST(datetime AS DATE) >= CAST(DATE '{AS_OF}' - INTERVAL 12 MONTH AS DATE)"
    return f"SELECT {key} AS cust_id, {', '.join(parts)} FROM {{transfers}} WHERE {first} GROUP BY {key}"


_SENT = _window_sql("payer_cust_id", "payee_cust_id", "sent")
_RCVD = _window_sql("payee_cust_id", "payer_cust_id", "rcvd")
_BOTH = f"""SELECT c_custkey AS cust_id, s.* EXCLUDE (cust_id), r.* EXCLUDE (cust_id) FROM customer
    LEFT JOIN ({_SENT}) s ON c_custkey = s.cust_id LEFT JOIN ({_RCVD}) r ON c_custkey = r.cust_id"""


def _sent(t):
    return FT.window_features(t.transfers, "payer_cust_id", "payee_cust_id", "datetime", "txn_amt", AS_OF, prefix="sent")


def _rcvd(t):
    return FT.window_features(t.transfers, "payee_cust_id", "payer_cust_id", "datetime", "txn_amt", AS_OF, prefix="rcvd")


def _both(t):
    base = t.customer.select(F.col("c_custkey").alias("cust_id"))
    return FT.feature_table(base, [_sent(t), _rcvd(t)], "cust_id")


@query("ml1_transfer_features", _BOTH)
def ml1(t):
    return _both(t)


_ACCOUNTS = """SELECT o_orderkey AS id, o_custkey AS cust_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' ELSE 'JPY' END AS currency,
    o_totalprice AS balance FROM orders"""
_ACC_FEATURES = f"""SELECT a.cust_id, num_accs, avg_balance, balance_usd
    FROM (SELECT cust_id, count(*) AS num_accs, {money('balance')} / count(balance) AS avg_balance FROM ({_ACCOUNTS}) GROUP BY ALL) a
    LEFT JOIN (SELECT cust_id, {money('balance')} AS balance_usd FROM ({_ACCOUNTS}) WHERE currency = 'USD' GROUP BY ALL) u ON a.cust_id = u.cust_id"""


def _account_features(t):
    accounts = t.orders.select(F.col("o_custkey").alias("cust_id"), F.col("o_totalprice").alias("balance"),
                               F.when(F.col("o_orderpriority") == "1-URGENT", "USD").otherwise("JPY").alias("currency"))
    return FT.account_features(accounts)


@query("ml2_account_features", _ACC_FEATURES)
def ml2(t):
    return _account_features(t)


@query("ml3_customer_gold", f"""
    SELECT c_custkey AS cust_id, c_mktsegment, n_name, CAST(1950 + c_custkey % 50 AS INTEGER) AS birth_year, a.* EXCLUDE (cust_id)
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN ({_ACC_FEATURES}) a ON c_custkey = a.cust_id""")
def ml3(t):
    dob = F.make_date((F.col("c_custkey") % 50 + 1950).cast("int"), F.lit(6), F.lit(15))
    silver = t.customer.withColumn("dob", dob).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    silver = silver.select(F.col("c_custkey").alias("cust_id"), "c_mktsegment", "n_name", F.year("dob").alias("birth_year"))
    return FT.feature_table(silver, [_account_features(t)], "cust_id")


_TOTALS = ", ".join(f"""coalesce(sent_{k}_{m}m + rcvd_{k}_{m}m, 0) AS tot_{k}_{m}m""" for m in (12, 6, 3) for k in ("txn_cnt", "txn_amt"))
_RATIOS = ", ".join(f"""coalesce(CASE WHEN sent_txn_amt_12m + rcvd_txn_amt_12m = 0 THEN 0 ELSE (sent_txn_amt_{m}m + rcvd_txn_amt_{m}m)
    / (sent_txn_amt_12m + rcvd_txn_amt_12m) END, 0) AS ratio_txn_amt_{m}m_12m""" for m in (6, 3))


@query("ml4_ratio_features", f"SELECT cust_id, {_TOTALS}, {_RATIOS} FROM ({_BOTH})")
def ml4(t):
    out = FT.ratio_features(_both(t))
    return out.select("cust_id", *[c for c in out.columns if c.startswith(("tot_", "ratio_"))])


@query("ml5_feature_table", f"""
    SELECT c_custkey AS cust_id, c_mktsegment, a.* EXCLUDE (cust_id), s.sent_txn_cnt_12m
    FROM customer LEFT JOIN ({_ACC_FEATURES}) a ON c_custkey = a.cust_id LEFT JOIN ({_SENT}) s ON c_custkey = s.cust_id""")
def ml5(t):
    base = t.customer.select(F.col("c_custkey").alias("cust_id"), "c_mktsegment")
    return FT.feature_table(base, [_account_features(t), _sent(t).select("cust_id", "sent_txn_cnt_12m")], "cust_id")


@query("ml6_label", f"""
    SELECT a.cust_id, num_accs, CAST(CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END AS INTEGER) AS defaulted
    FROM customer JOIN ({_ACC_FEATURES}) a ON c_custkey = a.cust_id""")
def ml6(t):
    labels = FT.label(t.customer, "c_acctbal > 6000", "defaulted").select(F.col("c_custkey").alias("cust_id"), "defaulted")
    return labels.join(_account_features(t).select("cust_id", "num_accs"), "cust_id")


@query("ml7_oversampled_minority", """
    SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1""")
def ml7_over(t):
    return FT.oversample(t.labels, "toxic")


_U = "('0x' || substr(md5(concat_ws('#', doc_id, '42')), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query("ml7_rebalanced", f"""
    SELECT doc_id, toxic FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic = 1
    UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic = 0 AND {_U} <
      least(1.0::DOUBLE, (SELECT count(*) FROM labels WHERE toxic = 1) * 6.0::DOUBLE / (SELECT count(*) FROM labels WHERE toxic = 0))""")
def ml7(t):
    return FT.rebalance(t.labels, "toxic", "doc_id").select("doc_id", "toxic")


def _place(seed):
    return f"('0x' || substr(md5(concat_ws('#', doc_id, '{seed}')), 1, 15))::BIGINT"


@query("ml7_rebalanced_exactly", f"""
    SELECT doc_id, toxic FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, toxic FROM labels WHERE toxic = 1
    UNION ALL SELECT doc_id, toxic FROM (SELECT *, row_number() OVER (ORDER BY {_place(42)}) AS rn FROM labels WHERE toxic = 0)
    WHERE rn <= 6 * (SELECT count(*) FROM labels WHERE toxic = 1)""")
def ml7_exact(t):
    return FT.rebalance_exactly(t.labels, "toxic", ["doc_id"]).select("doc_id", "toxic")


@query("ml9_exact_split", f"""
    SELECT doc_id, quality, CASE WHEN rn <= floor(n * 0.6::DOUBLE + 0.5) THEN 'train' WHEN rn <= floor(n * 0.8::DOUBLE + 0.5) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_place(0)}) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def ml9_exact(t):
    return exact_split(t.labels, ["doc_id"], {"train": 0.6, "val": 0.2, "test": 0.2}, ["quality"]).select("doc_id", "quality", "split")


@query("ml8_one_hot", """
    SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS c_mktsegment_AUTOMOBILE,
           CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS c_mktsegment_BUILDING, CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS c_mktsegment_FURNITURE,
           CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS c_mktsegment_HOUSEHOLD, CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS c_mktsegment_MACHINERY,
           CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS INTEGER) AS churn FROM customer""")
def ml8(t):
    df = t.customer.select("c_custkey", "c_mktsegment", FT.yes_no(F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No")).alias("churn"))
    return FT.one_hot(df, FT.distinct_values(df, ["c_mktsegment"]))


@query("ml9_impute_and_scale", """
    WITH d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS a, CAST(quality AS DOUBLE) AS b FROM documents LEFT JOIN labels USING (doc_id)),
    s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, sqrt(var_pop(b) * count(b) / count(*)) AS sb FROM d)
    SELECT doc_id, round((a - ma) / sa, 8) AS a_scaled, round((coalesce(b, mb) - mb) / sb, 8) AS b_scaled FROM d, s""")
def ml9(t):
    d = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.col("n_chars").cast("double").alias("a"), F.col("quality").cast("double").alias("b"))
    out = FT.scale_columns(d, ["a", "b"])
    return out.select("doc_id", F.round("a_scaled", 8).alias("a_scaled"), F.round("b_scaled", 8).alias("b_scaled"))


_SPLIT_U = "('0x' || substr(md5(concat_ws('#', doc_id, '0')), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query("ml9_split", f"""
    SELECT doc_id, quality, CASE WHEN {_SPLIT_U} < 0.6::DOUBLE THEN 'train' WHEN {_SPLIT_U} < 0.8::DOUBLE THEN 'val' ELSE 'test' END AS split
    FROM labels""")
def ml9_split(t):
    return FT.split(t.labels, "doc_id", {"train": 0.6, "val": 0.2, "test": 0.2}).select("doc_id", "quality", "split")


def _churn(t):
    spend = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), C.money_sum("o_totalprice").alias("spent"),
                                              F.max("o_totalprice").alias("largest"))
    rows = t.customer.join(spend, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_acctbal", "n_orders", "spent", "largest")
    return FT.label(rows, "spent / n_orders > 260000")


def _metrics(scored):
    """F1 weighted by class, from the confusion matrix, and the accuracies of the model and of the larger class."""
    n = {(r["label"], r["prediction"]): r["n"] for r in FT.confusion_matrix(scored, "label", "prediction").collect()}
    total, f1, per_class = sum(n.values()), 0.0, {}
    for c in {k[0] for k in n}:
        actual = sum(v for k, v in n.items() if k[0] == c)
        guessed = sum(v for k, v in n.items() if k[1] == c)
        per_class[c] = actual
        f1 += actual * 2 * n.get((c, float(c)), 0) / max(actual + guessed, 1)
    right = sum(v for (label, guess), v in n.items() if label == guess)
    return f1 / total, right / total, max(per_class.values()) / total


@query("ml10_classifier", """
    SELECT count(*) > 0 AS has_rows, TRUE AS f1_agrees, TRUE AS ranks_better_than_chance, TRUE AS at_least_the_larger_class FROM customer""")
def ml10(t):
    rows = FT.split(_churn(t), "c_custkey", {"train": 0.8, "test": 0.2})
    model = FT.train_classifier(rows.filter("split = 'train'"), "label", ["c_acctbal", "n_orders", "largest"])
    scored = model.transform(rows.filter("split = 'test'"))
    told, (f1, right, larger) = FT.evaluate(scored, "label"), _metrics(scored)
    return scored.agg((F.count(F.lit(1)) > 0).alias("has_rows"), F.lit(abs(told["f1"] - f1) < 1e-6).alias("f1_agrees"),
                      F.lit(told["roc_auc"] > 0.5 and 0 < told["pr_auc"] <= 1).alias("ranks_better_than_chance"),
                      F.lit(right > larger - 0.1).alias("at_least_the_larger_class"))


_CHURN_ROWS = """(SELECT count(*) AS n FROM customer JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey)"""
_NUMERIC = ["c_acctbal", "n_orders", "largest"]


def _searched(t):
    parts = exact_split(_churn(t), ["c_custkey"], {"train": 0.6, "val": 0.2, "test": 0.2}, ["label"])
    space = {"maxDepth": [2, 4], "maxIter": [2, 6], "stepSize": [0.05, 0.3]}
    model, trials = FT.search_classifier(parts.filter("split = 'train'"), parts.filter("split = 'val'"), ["c_custkey"], "label",
                                         _NUMERIC, space, n_trials=8, least_rows=50, factor=2)
    return parts, model, trials


@query("ml10_search_trials", """
    SELECT CAST(unnest(generate_series(0, 7)) AS INTEGER) AS trial, TRUE AS params_named, TRUE AS scored, TRUE AS halved""")
def ml10_search(t):
    # Every trial is in the first rung; each rung keeps the better ones, and one wins.
    _, _, trials = _searched(t)
    rungs = trials.groupBy("rung").agg(F.count_if("kept").alias("kept"), F.min(F.when(F.col("kept"), F.col("score"))).alias("least"),
                                       F.max(F.when(~F.col("kept"), F.col("score"))).alias("best_out")).orderBy("rung").collect()
    counts = [r["n"] for r in trials.groupBy("rung").agg(F.count(F.lit(1)).alias("n")).orderBy("rung").collect()]
    halved = (counts[1:] == [r["kept"] for r in rungs[:-1]] and rungs[-1]["kept"] == 1
              and all(r["best_out"] is None or r["best_out"] <= r["least"] for r in rungs))
    return trials.filter("rung = 0").select("trial", F.col("params").contains("maxDepth").alias("params_named"),
                                            F.col("score").between(0, 1).alias("scored"), F.lit(halved).alias("halved"))


@query("ml10_attributions", """
    SELECT c_custkey, TRUE AS adds_up, CAST(3 AS INTEGER) AS n_features FROM customer
    JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey""")
def ml10_attributions(t):
    # Base value and attributions add up to the margin of the model, for every row.
    parts, model, _ = _searched(t)
    ready = model.stages[0].transform(parts).select("c_custkey", "features")
    told = model.stages[-1].transform(ready).select("c_custkey", "features", vector_to_array("rawPrediction")[1].alias("told"))
    out = explain(model.stages[-1], told)
    total = F.aggregate("attributions", F.lit(0.0), lambda a, x: a + x) + F.col("base_value")
    return out.select("c_custkey", (F.abs(total - F.col("told")) < 1e-9).alias("adds_up"), F.size("attributions").alias("n_features"))


@query("ml10_confusion_matrix", "SELECT toxic, quality, count(*) AS n FROM labels GROUP BY ALL")
def ml10_matrix(t):
    return FT.confusion_matrix(t.labels, "toxic", "quality")


@query("ml11_batch_scoring", """
    SELECT c_custkey, CAST(CASE WHEN spent / n > 260000 THEN 1 ELSE 0 END AS INTEGER) AS label, TRUE AS scored, TRUE AS stamped, TRUE AS model_fits
    FROM customer JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
                        FROM orders GROUP BY ALL) ON c_custkey = o_custkey""")
def ml11(t):
    rows = _churn(t)
    model = FT.train_classifier(rows, "label", ["c_acctbal", "n_orders", "largest"], depths=[3])
    scored = FT.score(model, rows).select("c_custkey", "label", "prediction", "prediction_timestamp")
    table = append_table(scored, work_dir(t.spark, "ml11"))
    _, right, larger = _metrics(table)
    return table.select("c_custkey", "label", F.col("prediction").isin(0.0, 1.0).alias("scored"),
                        F.col("prediction_timestamp").isNotNull().alias("stamped"), F.lit(right > larger).alias("model_fits"))


@query("ml12_chart_data", f"""
    SELECT c_mktsegment, CAST(floor(c_acctbal / 1000) AS BIGINT) AS tenure, {money('c_acctbal')} AS income FROM customer
    WHERE c_acctbal BETWEEN 1000 AND 8000 GROUP BY ALL""")
def ml12(t):
    return t.customer.filter(F.col("c_acctbal").between(1000, 8000)).groupBy(
        "c_mktsegment", F.floor(F.col("c_acctbal") / 1000).alias("tenure")).agg(C.money_sum("c_acctbal").alias("income"))


@query("ml12_label_mix", "SELECT toxic, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share FROM labels GROUP BY ALL")
def ml12_mix(t):
    return distribution(t.labels, "toxic")


@query("ml13_pseudonymised_join", f"""
    SELECT c_mktsegment, count(*) AS n, {money('o_totalprice')} AS amount
    FROM customer JOIN orders ON sha256('s' || CAST(c_custkey AS VARCHAR)) = sha256('s' || CAST(o_custkey AS VARCHAR))
    GROUP BY ALL HAVING count(*) >= 10""")
def ml13(t):
    joined = hashed_join(t.customer.select("c_custkey", "c_mktsegment"), t.orders.select("o_custkey", "o_totalprice"),
                         "c_custkey", "o_custkey", salt="s")
    per = joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), C.money_sum("o_totalprice").alias("amount"))
    return min_group(per, "n", 10)


@query("ml13_pseudonyms", "SELECT sha256('s' || CAST(c_custkey AS VARCHAR)) AS key_sha256, c_mktsegment, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def ml13_keys(t):
    joined = hashed_join(t.customer.select("c_custkey", "c_mktsegment"), t.orders.select("o_custkey"), "c_custkey", "o_custkey", salt="s")
    return joined.groupBy("key_sha256", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("ml1_payer_payee_roles", """
    SELECT payer_cust_id, payee_cust_id, txn_amt, datetime, a.c_mktsegment AS payer_c_mktsegment, b.c_mktsegment AS payee_c_mktsegment
    FROM {transfers} LEFT JOIN customer a ON payer_cust_id = a.c_custkey LEFT JOIN customer b ON payee_cust_id = b.c_custkey""")
def ml1_roles(t):
    return role_join(t.transfers, t.customer.select("c_custkey", "c_mktsegment"), "c_custkey",
                     {"payer": "payer_cust_id", "payee": "payee_cust_id"})
