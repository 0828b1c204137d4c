"""2.3 joins."""

from pyspark.sql import functions as F

from lakeops.operators import joins as J
from lakeops.operators.aggregates import share_of_total
from lakeops.operators.numbering import following_pairs
from lakeops.queries.registry import query, with_stores
from lakeops.queries.sql import money
from lakeops.streaming.ingest import enrich_stream


@query("jn1_inner_multi", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, p_type FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderstatus = 'F'""")
def jn1(t):
    o = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return (t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "p_type"))


@query("jn2_two_table_condition", """
    SELECT c_custkey, o_orderkey, s_suppkey FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON l_orderkey = o_orderkey
    JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey""")
def jn2(t):
    bought = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    return (t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.supplier, (F.col("s_suppkey") == F.col("l_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
            .select("c_custkey", "o_orderkey", "s_suppkey"))


@query("jn3_left_star", """
    SELECT order_item_id, l.store_id, l.item_id, store_name, store_area, category_name, subtotal
    FROM {line_facts} l LEFT JOIN {stores} s ON l.store_id = s.store_id LEFT JOIN {items} i ON l.item_id = i.item_id""")
def jn3(t):
    facts = t.line_facts.select("order_item_id", "store_id", "item_id", "subtotal")
    # The dimension's own tables one after the other: their sizes are known, so no fact has to be shuffled.
    supplier = t.supplier.select("s_suppkey", F.col("s_name").alias("store_name"), "s_nationkey")
    nation, region = t.nation.select("n_nationkey", "n_regionkey"), t.region.select("r_regionkey", F.col("r_name").alias("store_area"))
    wide = J.denormalise(facts, [(supplier, "store_id", "s_suppkey"), (nation, "s_nationkey", "n_nationkey"),
                                 (region, "n_regionkey", "r_regionkey"), (t.items.select("item_id", "category_name"), "item_id", "item_id")])
    return wide.drop("s_nationkey", "n_regionkey")


@query("jn4_role_join", """
    SELECT payer_cust_id, payee_cust_id, txn_amt, datetime, a.c_name AS payer_c_name, b.c_name AS payee_c_name
    FROM {transfers} x LEFT JOIN customer a ON x.payer_cust_id = a.c_custkey
    LEFT JOIN customer b ON x.payee_cust_id = b.c_custkey""")
def jn4(t):
    return J.role_join(t.transfers, t.customer.select("c_custkey", "c_name"), "c_custkey",
                       {"payer": "payer_cust_id", "payee": "payee_cust_id"})


@query("jn5_filter_in_on", """
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'""")
def jn5(t):
    return t.customer.join(t.orders, (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_orderpriority") == "1-URGENT"),
                           "left").select("c_custkey", "o_orderkey", "o_totalprice")


@query("jn6_null_safe_join", """
    WITH a AS (SELECT order_id, CASE WHEN channel = 'POS' THEN o_orderstatus END AS k FROM {sales}),
         b AS (SELECT k, count(*) AS n FROM a GROUP BY k)
    SELECT order_id, a.k AS k, n FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def jn6(t):
    a = t.sales.select("order_id", F.when(F.col("channel") == "POS", F.col("o_orderstatus")).alias("k"))
    b = a.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return J.null_safe_join(a, b, ["k"])


@query("jn7_asof_join", """
    SELECT l.order_item_id, l.store_id, l.item_id, l.order_date, r.inventory_date, r.stock_quantity
    FROM {lines} l ASOF LEFT JOIN (
      SELECT * FROM {inventory}
      QUALIFY row_number() OVER (PARTITION BY store_id, item_id, inventory_date ORDER BY stock_quantity DESC) = 1) r
    ON l.store_id = r.store_id AND l.item_id = r.item_id AND l.order_date >= r.inventory_date""")
def jn7(t):
    left = t.lines.select("order_item_id", "store_id", "item_id", "order_date")
    return J.asof_join(left, t.inventory, ["store_id", "item_id"], "order_date", "inventory_date",
                       ["stock_quantity"], ["stock_quantity"])


_EVENT_ORDERS = """SELECT event_id AS order_id, user_id, CAST(ts AS DATE) AS order_date,
    CASE WHEN value > 10 THEN 'EC' ELSE 'POS' END AS channel FROM events WHERE event_type = 'purchase'"""


@query("jn8_same_day_log", f"""
    WITH o AS ({_EVENT_ORDERS}), l AS (
      SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, (ts, event_id)) AS event_type,
             count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY ALL)
    SELECT o.order_id, o.user_id, o.order_date, o.channel, l.event_type, coalesce(l.n, 0) AS n_logs
    FROM o LEFT JOIN l ON o.user_id = l.user_id AND o.order_date = l.d AND o.channel = 'EC'""")
def jn8(t):
    e = t.events
    orders = e.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), "user_id", F.to_date("ts").alias("order_date"),
        F.when(F.col("value") > 10, "EC").otherwise("POS").alias("channel"))
    logs = e.filter("event_type <> 'purchase'").select(
        F.col("user_id").alias("log_user"), F.to_date("ts").alias("log_date"), "ts", "event_id", "event_type")
    return J.same_day_join(orders, logs, "user_id", "order_date", "log_user", "log_date", ["ts", "event_id"],
                           ["event_type"], F.col("channel") == "EC")


@query("jn9_event_transitions", """
    SELECT source, target, count(*) AS weight FROM (
      SELECT event_type AS source, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target
      FROM events) WHERE target IS NOT NULL GROUP BY ALL""")
def jn9(t):
    return following_pairs(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
                           "event_type")


@query("jn10_share_of_total", f"""
    SELECT c_mktsegment, amount, amount * 100.0::DOUBLE / sum(amount) OVER () AS share
    FROM (SELECT c_mktsegment, count(*) AS amount FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)""")
def jn10(t):
    per = (t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment")
           .agg(F.count(F.lit(1)).alias("amount")))
    return share_of_total(per, "amount")


@query("jn11_using_key", "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def jn11(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id")


@query("jn12_ratio_in_group", f"""
    SELECT store_area, category_name, total_sales,
           total_sales * 100 / CAST(sum(CAST(total_sales AS DECIMAL(18,2))) OVER (PARTITION BY store_area) AS DOUBLE)
             AS sales_ratio
    FROM (SELECT store_area, category_name, {money('subtotal')} AS total_sales
          FROM {{line_facts}} l JOIN {{stores}} s ON l.store_id = s.store_id JOIN {{items}} i ON l.item_id = i.item_id
          GROUP BY ALL)""")
def jn12(t):
    facts = with_stores(t, t.line_facts, "store_area").join(t.items, "item_id")
    return J.ratio_within_group(facts, "store_area", "category_name", "subtotal")


@query("jn13_log_enrichment", """
    SELECT event_id, e.user_id, event_type, c_name, c_mktsegment FROM events e LEFT JOIN customer c ON e.user_id = c_custkey""")
def jn13(t):
    dim = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return enrich_stream(t.events.select("event_id", "user_id", "event_type"), dim, "user_id")


@query("jn14_attribute_join", """
    SELECT s_suppkey, c_custkey FROM supplier LEFT JOIN customer ON replace(s_name, 'Supplier', 'Customer') = c_name""")
def jn14(t):
    return t.supplier.join(t.customer, F.replace("s_name", F.lit("Supplier"), F.lit("Customer")) == F.col("c_name"),
                           "left").select("s_suppkey", "c_custkey")


@query("jn15_zip_rows", """
    WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS pair_no FROM customer),
         b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pair_no FROM part)
    SELECT pair_no, c_custkey, p_partkey FROM a JOIN b USING (pair_no)""")
def jn15(t):
    return J.zip_join(t.customer.select("c_custkey", "c_acctbal"), t.part.select("p_partkey", "p_retailprice"),
                      ["c_acctbal", "c_custkey"], [F.col("p_retailprice").desc(), "p_partkey"]).select(
        "pair_no", "c_custkey", "p_partkey")


@query("jn16_pick_member", """
    WITH m AS (SELECT s_nationkey, list_sort(list(s_suppkey)) AS ids FROM supplier GROUP BY ALL)
    SELECT c_custkey, c_nationkey AS s_nationkey, ids[c_custkey % len(ids) + 1] AS picked
    FROM customer LEFT JOIN m ON c_nationkey = s_nationkey""")
def jn16(t):
    left = t.customer.select("c_custkey", F.col("c_nationkey").alias("s_nationkey"))
    return J.attach_members(left, t.supplier, "s_nationkey", "s_suppkey", F.col("c_custkey"))


@query("jn17_round_robin", """
    WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS no,
                      count(*) OVER (PARTITION BY lang) AS n FROM documents),
         l AS (SELECT c_custkey, g, row_number() OVER (PARTITION BY g ORDER BY c_custkey) AS rn
               FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'en' WHEN 'FURNITURE' THEN 'de'
                                       WHEN 'HOUSEHOLD' THEN 'fr' ELSE 'none' END AS g FROM customer))
    SELECT c_custkey, g AS lang, doc_id FROM l LEFT JOIN r ON g = lang AND (rn - 1) % n + 1 = no""")
def jn17(t):
    g = (F.when(F.col("c_mktsegment") == "MACHINERY", "en").when(F.col("c_mktsegment") == "FURNITURE", "de")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "fr").otherwise("none"))
    return J.assign_round_robin(t.customer.select("c_custkey", g.alias("lang")), t.documents.select("lang", "doc_id"),
                                "lang", ["c_custkey"], ["doc_id"], "doc_id")
