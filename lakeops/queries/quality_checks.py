"""2.9 upserts, versions and data quality."""

from pyspark.sql import functions as F

from lakeops.operators import quality as Q
from lakeops.operators.upsert import state_as_of, upsert, upsert_table
from lakeops.plans import profiles as P
from lakeops.plans.orders import stock_profile
from lakeops.queries.registry import AS_OF, query
from lakeops.queries.sql import frequency_group, price_range
from lakeops.session import work_dir
from lakeops.sources.writers import append_table, write_table

_TARGET = """SELECT order_date, user_id, count(*) AS n_orders, CAST(0 AS BIGINT) AS n_late, 'old' AS state
             FROM {sales} WHERE order_date < DATE '1999-01-01' GROUP BY ALL"""
_SOURCE = """SELECT order_date, user_id, count(*) AS n_new FROM {sales}
             WHERE order_date >= DATE '1998-12-01' GROUP BY ALL"""


def _target(t):
    return t.sales.filter("order_date < DATE '1999-01-01'").groupBy("order_date", "user_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.lit(0).cast("bigint").alias("n_late"), F.lit("old").alias("state"))


def _source(t):
    return t.sales.filter("order_date >= DATE '1998-12-01'").groupBy("order_date", "user_id").agg(
        F.count(F.lit(1)).alias("n_new"))


@query("up1_merge_with_map", f"""
    SELECT coalesce(t.order_date, s.order_date) AS order_date, coalesce(t.user_id, s.user_id) AS user_id,
           t.n_orders AS n_orders, CASE WHEN s.n_new IS NOT NULL THEN s.n_new ELSE t.n_late END AS n_late,
           CASE WHEN s.n_new IS NOT NULL THEN 'new' ELSE t.state END AS state
    FROM ({_TARGET}) t FULL JOIN ({_SOURCE}) s ON t.order_date = s.order_date AND t.user_id = s.user_id""")
def up1(t):
    return upsert(_target(t), _source(t), ["order_date", "user_id"], {"n_late": "n_new", "state": F.lit("new")})


@query("up2_merge_all_columns", """
    SELECT order_date, channel, count(*) AS n_orders, 'new' AS state FROM {sales}
    WHERE order_date >= DATE '1998-12-01' GROUP BY ALL
    UNION ALL
    SELECT order_date, channel, CAST(-1 AS BIGINT), 'old' FROM {sales}
    WHERE order_date < DATE '1998-12-01' GROUP BY ALL""")
def up2(t):
    old = t.sales.filter("order_date < DATE '1999-01-01'").groupBy(F.year("order_date").alias("y"), "order_date", "channel").agg(
        F.lit(-1).cast("bigint").alias("n_orders"), F.lit("old").alias("state"))
    new = t.sales.filter("order_date >= DATE '1998-12-01'").groupBy(F.year("order_date").alias("y"), "order_date", "channel").agg(
        F.count(F.lit(1)).alias("n_orders"), F.lit("new").alias("state"))
    path = work_dir(t.spark, "up2")
    write_table(old, path, partition_by=["y"])
    return upsert_table(t.spark, path, new, ["y", "order_date", "channel"], "y").drop("y")


@query("up3_append_history", """
    SELECT channel, count(*) AS n, 1 AS run FROM {sales} GROUP BY ALL
    UNION ALL SELECT channel, count(*), 2 FROM {sales} WHERE o_orderstatus = 'F' GROUP BY ALL""")
def up3(t):
    path = work_dir(t.spark, "up3")
    append_table(t.sales.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("run")), path)
    return append_table(t.sales.filter("o_orderstatus = 'F'").groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"), F.lit(2).alias("run")), path)


@query("up4_state_as_of", """
    SELECT user_id, event_id, event_type, value FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def up4(t):
    log = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return state_as_of(log, ["user_id"], "ts", cut, ["event_id"]).drop("ts")


@query("dq1_unique_key", """
    SELECT user_id, ts::DATE AS d, count(*) AS count FROM events GROUP BY ALL HAVING count(*) > 1""")
def dq1(t):
    return Q.check_unique(t.events.select("user_id", F.to_date("ts").alias("d")), ["user_id", "d"])


@query("dq2_not_null", """
    SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS n_null FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM documents LEFT JOIN labels USING (doc_id)""")
def dq2(t):
    return Q.check_not_null(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), ["doc_id", "quality", "toxic"])


@query("dq3_foreign_key", """
    SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def dq3(t):
    return Q.check_fk(t.documents.select("doc_id", "lang"), t.labels, "doc_id", "doc_id")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("dq4_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
           CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders""" for c in _ORDER_COLUMNS))
def dq4(t):
    return Q.profile(t.orders, exact_distinct=True)


@query("dq5_recency_profile", f"""
    SELECT CAST(days AS INTEGER) AS days_since_last_purchase, count(*) AS n,
           count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share
    FROM (SELECT date_diff('day', max(order_date), DATE '{AS_OF}') AS days FROM {{sales}} GROUP BY user_id) GROUP BY days""")
def dq5_recency(t):
    return P.recency_profile(t.sales, AS_OF)


@query("dq5_frequency_profile", f"""
    WITH g AS (SELECT {frequency_group('n')} AS frequency_group
               FROM (SELECT user_id, count(DISTINCT order_id) AS n FROM {{sales}} GROUP BY user_id)),
         c AS (SELECT frequency_group, count(*) AS member_count FROM g GROUP BY ALL),
         r AS (SELECT *, member_count * 100.0::DOUBLE / sum(member_count) OVER () AS composition_ratio FROM c)
    SELECT *, sum(composition_ratio) OVER (ORDER BY frequency_group ROWS UNBOUNDED PRECEDING) AS cumulative_ratio FROM r""")
def dq5_frequency(t):
    return P.frequency_profile(t.sales)


@query("dq5_monetary_profile", f"""
    SELECT price_range, count(*) AS count, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percentage
    FROM (SELECT {price_range('s')} AS price_range
          FROM (SELECT order_id, sum(CAST(subtotal AS DECIMAL(18,2))) AS s FROM {{lines}} GROUP BY order_id))
    GROUP BY price_range""")
def dq5_monetary(t):
    return P.monetary_profile(t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("subtotal")))


@query("dq6_stock_profile", """
    SELECT 'store ' || store_name AS label, sum(stock_quantity) AS total_quantity
    FROM {inventory} i JOIN {stores} s ON i.store_id = s.store_id GROUP BY store_name
    UNION ALL SELECT 'item ' || item_name, sum(stock_quantity) FROM {inventory} i JOIN {items} p ON i.item_id = p.item_id
    GROUP BY item_name""")
def dq6(t):
    h = t.inventory.withColumnRenamed("stock_quantity", "quantity")
    by_store = stock_profile(h, t.stores, "store_id", "store_name")
    by_item = stock_profile(h, t.items, "item_id", "item_name")
    return by_store.select(F.concat(F.lit("store "), "store_name").alias("label"), "total_quantity").unionByName(
        by_item.select(F.concat(F.lit("item "), "item_name").alias("label"), "total_quantity"))
