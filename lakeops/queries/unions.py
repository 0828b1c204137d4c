"""2.6 sort, limit and set operations."""

from pyspark.sql import functions as F

from lakeops.operators import sets as S
from lakeops.operators.sampling import exact_sample
from lakeops.queries.registry import query


@query("sl1_order_by", """
    SELECT o_orderpriority, o_orderdate::DATE AS order_date, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey""")
def sl1(t):
    # The unique last key lets the range partitioner split a heavy priority.
    return t.orders.orderBy("o_orderpriority", F.col("o_orderdate").desc(), "o_orderkey").select(
        "o_orderpriority", F.to_date("o_orderdate").alias("order_date"), "o_totalprice", "o_orderkey")


@query("sl2_top_k", """
    SELECT item_id, count(*) AS purchases FROM {line_facts} GROUP BY item_id ORDER BY purchases DESC, item_id LIMIT 10""")
def sl2(t):
    counts = t.line_facts.groupBy("item_id").agg(F.count(F.lit(1)).alias("purchases"))
    return S.top_k(counts, [F.col("purchases").desc(), F.col("item_id")], 10)


_H = "('0x' || substr(md5(concat_ws('#', event_id, '7')), 1, 15))::BIGINT"


@query("sl3_exact_sample", f"""
    SELECT event_id, user_id, value FROM events ORDER BY {_H}, event_id LIMIT 500""")
def sl3_exact(t):
    return exact_sample(t.events, ["event_id"], 500, seed=7).select("event_id", "user_id", "value")


@query("sl3_exact_sample_by_class", f"""
    SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {_H}, event_id) <= 40""")
def sl3_by_class(t):
    return exact_sample(t.events, ["event_id"], 40, ["event_type"], seed=7).select("event_id", "event_type")


@query("sl3_hash_sample", """
    SELECT event_id, user_id, value FROM events
    WHERE ('0x' || substr(md5(concat_ws('#', event_id, '7')), 1, 8))::BIGINT / 4294967296.0 < 0.1""")
def sl3(t):
    return S.hash_sample(t.events, "event_id", 0.1, seed=7).select("event_id", "user_id", "value")


@query("st1_union_tagged", """
    SELECT order_id, user_id, o_orderstatus, NULL::VARCHAR AS o_orderpriority, 'pos' AS source FROM {sales}
    WHERE channel = 'POS'
    UNION ALL SELECT order_id, user_id, NULL, o_orderpriority, 'ec' FROM {sales} WHERE channel = 'EC'""")
def st1(t):
    pos = t.sales.filter("channel = 'POS'").select("order_id", "user_id", "o_orderstatus")
    ec = t.sales.filter("channel = 'EC'").select("order_id", "user_id", "o_orderpriority")
    return S.union_tagged({"pos": pos, "ec": ec})


@query("st2_union_disjoint", """
    SELECT order_id, total_amount FROM {sales} WHERE o_orderstatus = 'F' AND total_amount > 200000
    UNION ALL SELECT order_id, total_amount FROM {sales} WHERE o_orderstatus <> 'F' AND total_amount <= 50000""")
def st2(t):
    s = t.sales
    done = s.filter("o_orderstatus = 'F' AND total_amount > 200000")
    rest = s.filter("o_orderstatus <> 'F' AND total_amount <= 50000")
    return done.unionAll(rest).select("order_id", "total_amount")


@query("st3_union_by_name", """
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::DOUBLE AS price FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_retailprice FROM part""")
def st3(t):
    return S.union_all([
        t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("balance")),
        t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                      F.col("p_retailprice").alias("price"))])


@query("st4_union_positional", """
    SELECT c_custkey AS key, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""")
def st4(t):
    return t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")).union(
        t.supplier.select("s_suppkey", "s_acctbal"))


@query("st5_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def st5(t):
    return t.events.select("user_id", "event_type").distinct()
