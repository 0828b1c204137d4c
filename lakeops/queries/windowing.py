"""2.5 window functions."""

from pyspark.sql import functions as F

from lakeops.functions.columns import money_sum
from lakeops.operators import windows as W
from lakeops.operators.aggregates import distribution
from lakeops.operators.numbering import number_rows, surrogate_key
from lakeops.queries.registry import query
from lakeops.queries.sql import money

_LATEST = """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@query("wn1_latest_per_key", _LATEST)
def wn1(t):
    newest = W.latest_per_key(t.orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")


@query("wn2_latest_stock_row", """
    SELECT store_id, item_id, inventory_date, stock_quantity FROM {inventory}
    QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY inventory_date DESC, stock_quantity DESC) = 1""")
def wn2(t):
    newest = W.latest_per_key(t.inventory, ["store_id", "item_id"], ["inventory_date"], ["stock_quantity"])
    return newest


@query("wn3_top_n_per_group", """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                               l_partkey) <= 6""")
def wn3(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return W.top_n(lines, ["l_suppkey"], [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"], 6)


@query("wn4_rank_best", """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(1 AS INTEGER) AS rnk FROM lineitem
    QUALIFY rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) = 1""")
def wn4(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return W.rank_best(lines, ["l_suppkey"], "l_quantity", descending=True)


@query("wn5_ranked_totals", f"""
    SELECT * FROM (SELECT user_id, total, CAST(row_number() OVER (ORDER BY total DESC, user_id) AS INTEGER) AS row_num
                   FROM (SELECT user_id, {money('total_amount')} AS total FROM {{sales}} GROUP BY user_id))
    WHERE row_num <= 10""")
def wn5(t):
    totals = t.sales.groupBy("user_id").agg(money_sum("total_amount").alias("total"))
    return W.ranked_totals(totals, [F.col("total").desc(), F.col("user_id")], 10)


@query("wn6_rolling_week", """
    SELECT ds, machine_id, item, y,
           CAST(sum(y) OVER w AS DOUBLE) / count(y) OVER w AS avg_7, max(y) OVER w AS max_7
    FROM {demand}
    WINDOW w AS (PARTITION BY machine_id, item ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def wn6(t):
    return W.rolling(t.demand, ["machine_id", "item"], "ds", {"avg_7": F.avg("y"), "max_7": F.max("y")}, 7)


@query("wn7_cumulative_share", """
    SELECT o_orderpriority, n, share, sum(share) OVER (ORDER BY o_orderpriority ROWS UNBOUNDED PRECEDING)
           AS cumulative_share
    FROM (SELECT o_orderpriority, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders) AS share
          FROM orders GROUP BY o_orderpriority)""")
def wn7(t):
    return W.cumulative_share(distribution(t.orders, "o_orderpriority"), "o_orderpriority", "share")


@query("wn8_repeat_purchase", """
    SELECT order_item_id, subtotal, user_id, item_id, order_date, p IS NOT NULL AS is_repeat_purchase,
           CAST(date_diff('day', p, order_date) AS INTEGER) AS days_since_last_purchase
    FROM (SELECT *, lag(order_date) OVER (PARTITION BY user_id, item_id ORDER BY order_date, order_item_id, subtotal) AS p
          FROM {lines})""")
def wn8(t):
    lines = t.lines.select("order_item_id", "subtotal", "user_id", "item_id", "order_date")
    return W.repeat_purchase(lines, ["user_id", "item_id"], "order_date", ["order_item_id", "subtotal"])


@query("wn9_count_over_all", """
    SELECT source, count(*) AS n_docs, (SELECT count(*) FROM documents) AS n_all FROM documents GROUP BY source""")
def wn9(t):
    n_all = t.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("n_all", n_all)


@query("wn10_surrogate_key", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders""")
def wn10(t):
    return surrogate_key(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("wn11_event_order", """
    SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_order
    FROM events""")
def wn11(t):
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    return number_rows(events, ["user_id"], ["ts", "event_id"], "event_order").drop("ts")
