"""2.4 aggregations."""

from pyspark.sql import functions as F

from lakeops.functions.columns import money_sum
from lakeops.operators import aggregates as A
from lakeops.operators.windows import latest_per_key
from lakeops.plans.demand import weekday_profile
from lakeops.plans.orders import rollup_cart, rollup_header
from lakeops.queries.registry import query
from lakeops.queries.sql import money, money_if


@query("ag1_group_totals", f"""
    SELECT l_returnflag, l_linestatus, {money('l_extendedprice')} AS sum_price, sum(l_quantity) AS sum_qty,
           count(*) AS n, {money('l_extendedprice')} / count(*) AS avg_price, min(l_quantity) AS min_qty,
           max(l_quantity) AS max_qty
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def ag1(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        money_sum("l_extendedprice").alias("sum_price"), F.sum("l_quantity").alias("sum_qty"),
        F.count(F.lit(1)).alias("n"), (money_sum("l_extendedprice") / F.count(F.lit(1))).alias("avg_price"),
        F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"))


@query("ag2_distinct_counts", """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders,
           count(DISTINCT l_shipdate) AS n_days FROM lineitem GROUP BY l_suppkey""")
def ag2(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("n_parts"), F.count_distinct("l_orderkey").alias("n_orders"),
        F.count_distinct("l_shipdate").alias("n_days"))


@query("ag3_conditional_aggregates", f"""
    SELECT user_id, {money_if("channel = 'EC'", 'total_amount')} AS ec_amount,
           count(DISTINCT CASE WHEN channel = 'POS' THEN order_id END) AS pos_orders,
           min(CASE WHEN channel = 'EC' THEN order_date END) AS first_ec,
           max(CASE WHEN channel = 'POS' THEN order_date END) AS last_pos
    FROM {{sales}} GROUP BY user_id""")
def ag3(t):
    ec, pos = F.col("channel") == "EC", F.col("channel") == "POS"
    return A.cond_agg(t.sales, ["user_id"], {
        "ec_amount": money_sum("total_amount", ec),
        "pos_orders": F.count_distinct(F.when(pos, F.col("order_id"))),
        "first_ec": F.min(F.when(ec, F.col("order_date"))), "last_pos": F.max(F.when(pos, F.col("order_date")))})


@query("ag4_group_by_expression", f"""
    SELECT CAST(year(order_date) AS VARCHAR) AS year, {money('total_amount')} AS amount, count(*) AS n
    FROM {{sales}} GROUP BY 1""")
def ag4(t):
    return t.spark.sql(
        "SELECT CAST(year(order_date) AS STRING) AS year, "
        "sum(CAST(rint(total_amount * 100) AS BIGINT)) / 100.0D AS amount, count(*) AS n FROM {s} GROUP BY 1", s=t.sales)


@query("ag5_group_by_all", """
    SELECT o_orderstatus, channel, count(*) AS n, max(order_date) AS last_date FROM {sales} GROUP BY ALL""")
def ag5(t):
    return t.spark.sql("SELECT o_orderstatus, channel, count(*) AS n, max(order_date) AS last_date FROM {s} GROUP BY ALL",
                       s=t.sales)


@query("ag6_duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def ag6(t):
    return A.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("ag7_weekday_profile", """
    SELECT CAST(year(ds) AS INTEGER) AS year, CAST(dayofweek(ds) AS INTEGER) AS weekday,
           CAST(sum(s) AS DOUBLE) / count(*) AS sales
    FROM (SELECT ds, sum(y) AS s FROM {demand} GROUP BY ds) GROUP BY ALL""")
def ag7(t):
    return weekday_profile(t.demand)


@query("ag8_collect_lists", """
    SELECT order_id, CAST(0 AS BIGINT) AS part, array_to_string(list_sort(list(item_id)), ',') AS item_ids FROM {line_facts} GROUP BY order_id""")
def ag8(t):
    lists = A.collect_parts(t.line_facts, ["order_id"], F.col("item_id"), ["order_item_id", "subtotal"], name="item_ids")
    return lists.withColumn("item_ids", F.array_join(F.col("item_ids").cast("array<string>"), ","))


@query("ag9_group_text", """
    SELECT conv_id, CAST(0 AS BIGINT) AS part, array_to_string(list_sort(list(text)), ' ') AS text
    FROM conversations GROUP BY conv_id""")
def ag9(t):
    return A.concat_group(t.conversations, ["conv_id"], "text", ["conv_id", "turn"])


@query("ag10_share_of_rows", """
    SELECT event_type, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events) AS share
    FROM events GROUP BY event_type""")
def ag10(t):
    return A.distribution(t.events, "event_type")


@query("ag11_rates", """
    SELECT CAST(sum((o_orderstatus = 'F')::INT) AS DOUBLE) / count(*) AS finished,
           CAST(sum((o_totalprice > 100000)::INT) AS DOUBLE) / count(*) AS large FROM orders""")
def ag11(t):
    return A.rates(t.orders, {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100000})


@query("ag12_header_from_lines", f"""
    SELECT order_id, user_id, {money('subtotal')} AS total_amount, min(ship_date) AS order_datetime,
           max(ship_date) AS updated_at FROM {{lines}} GROUP BY order_id, user_id""")
def ag12(t):
    return rollup_header(t.lines.withColumn("order_datetime", F.col("ship_date")))


@query("ag13_cart_from_items", f"""
    SELECT order_id AS cart_id, {money('subtotal')} AS total_amount, count(item_id) AS item_count,
           min(user_id) AS user_id, min(ship_date) AS created_at, max(ship_date) AS updated_at
    FROM {{lines}} GROUP BY order_id""")
def ag13(t):
    return rollup_cart(t.lines.withColumnsRenamed({"order_id": "cart_id", "ship_date": "added_at"}))


@query("ag14_bounds", """
    SELECT min(doc_id) AS min_value, max(doc_id) AS max_value, count(*) AS n_rows FROM documents""")
def ag14(t):
    return A.bounds(t.documents, "doc_id")


@query("ag15_dedup", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def ag15(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return latest_per_key(t.lineitem.select(*cols), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                          ["l_partkey", "l_suppkey"]).drop("l_shipdate")


@query("ag16_accuracy_alert", """
    SELECT count(*) AS n, CAST(sum((quality = 1 - toxic)::INT) AS BIGINT) AS n_right,
           CAST(sum((quality = 1 - toxic)::INT) AS DOUBLE) / count(*) AS accuracy,
           CAST(sum((quality = 1 - toxic)::INT) AS DOUBLE) / count(*) < 0.8 AS alert FROM labels""")
def ag16(t):
    return A.accuracy_alert(t.labels.withColumn("pred", 1 - F.col("toxic")), "pred", "quality")


@query("ag17_count_histogram", """
    SELECT occurrences, count(*) AS n_keys
    FROM (SELECT user_id, count(*) AS occurrences FROM events GROUP BY user_id) GROUP BY occurrences""")
def ag17(t):
    return A.count_histogram(t.events, "user_id")
