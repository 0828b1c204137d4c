"""Sketch columns beside the exact answers: every estimate must lie within its stated bound."""

from pyspark.sql import functions as F

from lakeops.operators import sketches as K
from lakeops.operators.null_safe import null_safe_join
from lakeops.queries.registry import query


def _within(estimate, exact, of):
    return F.abs(estimate - exact) <= of * K.distinct_error() + 0.5


@query("ag2_merged_distinct_counts", """
    SELECT channel, o_orderstatus, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, TRUE AS users_within,
           count(DISTINCT order_date) AS n_days, TRUE AS days_within FROM {sales} GROUP BY ALL""")
def ag2_merged(t):
    # Sketches per month, merged to channel and status.
    sales = t.sales.withColumns({"month": F.trunc("order_date", "MM"), "day_no": F.unix_date("order_date")})
    mart = K.distinct_mart(sales, ["channel", "o_orderstatus", "month"], {"users": "user_id", "days": "day_no"})
    merged = K.distinct_counts(K.merge_distinct(mart, ["channel", "o_orderstatus"], ["users", "days"]), ["users", "days"])
    exact = t.sales.groupBy("channel", "o_orderstatus").agg(
        F.count_distinct("user_id").alias("n_users"), F.count_distinct("order_date").alias("n_days"))
    both = null_safe_join(exact, merged, ["channel", "o_orderstatus"])
    return both.select("channel", "o_orderstatus", "n_rows", "n_users", _within(F.col("users"), F.col("n_users"), F.col("n_users")).alias("users_within"),
                       "n_days", _within(F.col("days"), F.col("n_days"), F.col("n_days")).alias("days_within"))


@query("ag2_sketched_set_operations", """
    WITH ec AS (SELECT DISTINCT user_id FROM {sales} WHERE channel = 'EC'), pos AS (SELECT DISTINCT user_id FROM {sales} WHERE channel = 'POS')
    SELECT (SELECT count(*) FROM (SELECT * FROM ec UNION SELECT * FROM pos)) AS either, (SELECT count(*) FROM ec JOIN pos USING (user_id)) AS both,
           (SELECT count(*) FROM ec ANTI JOIN pos USING (user_id)) AS first_only, TRUE AS within""")
def ag2_sets(t):
    mart = K.distinct_mart(t.sales, ["channel"], {"users": "user_id"})
    one = mart.agg(F.max(F.when(F.col("channel") == "EC", F.col("users"))).alias("ec"), F.max(F.when(F.col("channel") == "POS", F.col("users"))).alias("pos"))
    told = one.select(*[c.alias(f"_{n}") for n, c in K.set_counts(F.col("ec"), F.col("pos")).items()]).first()
    per = t.sales.groupBy("user_id").agg(F.max((F.col("channel") == "EC").cast("int")).alias("e"), F.max((F.col("channel") == "POS").cast("int")).alias("p"))
    exact = per.agg(F.count(F.lit(1)).alias("either"), F.count_if(F.expr("e = 1 AND p = 1")).alias("both"), F.count_if(F.expr("e = 1 AND p = 0")).alias("first_only"))
    within = F.lit(True)
    for n in ("either", "both", "first_only"):
        within = within & _within(F.lit(told[f"_{n}"]), F.col(n), F.col("either"))
    return exact.withColumn("within", within)


@query("tf6_product_sketches", """
    SELECT stock_code, CAST(sum(quantity) AS BIGINT) AS quantity, count(DISTINCT customer_id) AS n_customers, count(DISTINCT order_no) AS n_orders,
           TRUE AS within FROM {retail} GROUP BY stock_code""")
def tf6_sketches(t):
    # Both distinct counts of every product in one pass, without a row copy per count.
    retail = t.retail
    per = retail.groupBy("stock_code").agg(F.sum("quantity").alias("quantity"), F.theta_sketch_agg("customer_id", K.LG_K).alias("c"),
                                           F.theta_sketch_agg("order_no", K.LG_K).alias("o"))
    told = K.distinct_counts(per, ["c", "o"])
    exact = retail.groupBy("stock_code").agg(F.count_distinct("customer_id").alias("n_customers"), F.count_distinct("order_no").alias("n_orders"))
    return exact.join(told, "stock_code").select(
        "stock_code", "quantity", "n_customers", "n_orders",
        (_within(F.col("c"), F.col("n_customers"), F.col("n_customers")) & _within(F.col("o"), F.col("n_orders"), F.col("n_orders"))).alias("within"))


_SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)


@query("dq5_merged_quantiles", """
    SELECT channel, count(*) AS n, CAST(5 AS INTEGER) AS n_quantiles, TRUE AS within FROM {sales} GROUP BY channel""")
def dq5_quantiles(t):
    # Sketches per month, merged per channel; the share of rows up to each value must be the one asked for.
    sales = t.sales.withColumn("month", F.trunc("order_date", "MM"))
    mart = K.quantile_mart(sales, ["channel", "month"], {"amount": "total_amount"})
    merged = K.merge_quantiles(mart, ["channel"], ["amount"])
    told = merged.select("channel", K.quantiles(F.col("amount"), _SHARES).alias("q"))
    below = [F.sum((F.col("total_amount") < F.col("q")[i]).cast("int")) / F.count(F.lit(1)) for i in range(len(_SHARES))]
    upto = [F.sum((F.col("total_amount") <= F.col("q")[i]).cast("int")) / F.count(F.lit(1)) for i in range(len(_SHARES))]
    within = F.lit(True)
    for share, b, u in zip(_SHARES, below, upto):
        within = within & (b <= share + K.rank_error()) & (u >= share - K.rank_error())
    return t.sales.join(told, "channel").groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("n_quantiles"), within.alias("within"))


@query("dq6_merged_frequent_items", """
    SELECT store_id, count(*) AS n_rows, TRUE AS within FROM {line_facts} GROUP BY store_id""")
def dq6_frequent(t):
    # Counters per store and year, merged per store; the counts of the ten most frequent items are within the bound.
    lines = t.line_facts.withColumn("year", F.year("ship_date"))
    merged = K.merge_frequent(K.frequent_mart(lines, ["store_id", "year"], "item_id"), ["store_id"])
    told = K.frequent_values(merged, 10)
    exact = lines.groupBy("store_id", F.col("item_id").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return told.join(exact, ["store_id", "item"], "left").groupBy("store_id", "n_rows").agg(
        F.every(F.abs(F.col("count") - F.coalesce("n", F.lit(0))) <= F.col("n_rows") * K.count_error()).alias("within"))
