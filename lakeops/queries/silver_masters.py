"""2.12 silver masters. Test tables with a few derived columns serve as bronze."""

from pyspark.sql import functions as F

from lakeops.operators.joins import ratio_within_group
from lakeops.plans.silver import age_columns, silver_master
from lakeops.queries.registry import AS_OF, query
from lakeops.queries.sql import money

_BIRTH = "DATE '1930-01-01' + CAST(c_custkey * 37 % 29000 AS INTEGER)"


def _customers(t):
    birth = F.date_add(F.lit("1930-01-01").cast("date"), F.pmod(F.col("c_custkey") * 37, F.lit(29000)).cast("int"))
    return t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), birth.alias("birth_date"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("c_nationkey") != 3, F.col("c_acctbal") > 0).alias("email_permission_flg"),
        F.col("c_mktsegment").alias("status"))


_USERS = f"""SELECT DISTINCT c_custkey AS user_id, c_name AS name, {_BIRTH} AS birth_date,
    CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_nationkey <> 3 AND c_acctbal > 0 THEN 1 ELSE 0 END AS email_permission_flg,
    CAST(floor(date_diff('day', {_BIRTH}, DATE '{AS_OF}') / 365.25::DOUBLE) AS INTEGER) AS age,
    CAST(floor(date_diff('day', {_BIRTH}, DATE '{AS_OF}') / 365.25::DOUBLE / 5) * 5 AS INTEGER) AS age_group_5,
    CAST(floor(date_diff('day', {_BIRTH}, DATE '{AS_OF}') / 365.25::DOUBLE / 10) * 10 AS INTEGER) AS age_group_10 FROM customer"""


def _silver_users(t):
    return silver_master(_customers(t), ["user_id", "name", "birth_date", "gender"], flags=["email_permission_flg"],
                         more=age_columns("birth_date", AS_OF), distinct=True)


@query("c13_silver_users", _USERS)
def users(t):
    return _silver_users(t)


@query("c13_silver_items", "SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category_name, p_retailprice AS price FROM part")
def items(t):
    return silver_master(t.items, ["item_id", "item_name", "category_name", "price"])


@query("c13_silver_stores", """
    SELECT s_suppkey AS store_id, s_name AS store_name, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS status FROM supplier""")
def stores(t):
    bronze = t.supplier.select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
                               F.when(F.col("s_acctbal") > 0, "ACTIVE").otherwise("CLOSED").alias("status"))
    return silver_master(bronze, ["store_id", "store_name"], codes={"status": {"ACTIVE": 1}})


@query("c13_silver_staff", """
    SELECT c_custkey AS staff_id, c_nationkey AS store_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS status FROM customer""")
def staff(t):
    bronze = t.customer.select(F.col("c_custkey").alias("staff_id"), F.col("c_nationkey").alias("store_id"),
                               F.col("c_mktsegment").alias("status"))
    return silver_master(bronze, ["staff_id", "store_id"], codes={"status": {"BUILDING": 1}})


@query("c13_silver_inventory", """
    SELECT l_orderkey AS related_order_id, l_partkey AS item_id, l_suppkey AS store_id, l_quantity AS quantity,
           CAST(l_shipdate AS DATE) AS inventory_date FROM lineitem""")
def inventory(t):
    bronze = t.lineitem.select(F.col("l_orderkey").alias("related_order_id"), F.col("l_partkey").alias("item_id"),
                               F.col("l_suppkey").alias("store_id"), F.col("l_quantity").alias("quantity"), "l_shipdate")
    return silver_master(bronze, ["related_order_id", "item_id", "store_id", "quantity"], {"inventory_date": "l_shipdate"})


@query("c13_silver_web_logs", "SELECT event_id AS log_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events")
def web_logs(t):
    return silver_master(t.events.withColumnRenamed("event_id", "log_id"), ["log_id", "user_id", "event_type"], {"event_date": "ts"})


@query("c13_silver_app_events", """
    SELECT event_id, user_id, event_type, props AS screen_name, CAST(ts AS DATE) AS event_date, CAST(ts AS DATE) AS created_date
    FROM events""")
def app_events(t):
    return silver_master(t.events.withColumnRenamed("props", "screen_name"), ["event_id", "user_id", "event_type", "screen_name"],
                         {"event_date": "ts", "created_date": "ts"})


@query("c13_silver_cart_items", """
    SELECT l_orderkey AS cart_id, l_linenumber AS cart_item_id, l_partkey AS item_id, l_quantity AS quantity,
           CAST(l_shipdate AS DATE) AS added_date, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS l_linestatus FROM lineitem""")
def cart_items(t):
    bronze = t.lineitem.select(F.col("l_orderkey").alias("cart_id"), F.col("l_linenumber").alias("cart_item_id"),
                               F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("quantity"), "l_shipdate", "l_linestatus")
    return silver_master(bronze, ["cart_id", "cart_item_id", "item_id", "quantity"], {"added_date": "l_shipdate"},
                         codes={"l_linestatus": {"O": 1}})


@query("c13_silver_loyalty", """
    SELECT event_id AS point_id, user_id, value AS point_balance, CAST(ts AS DATE) AS earned_date,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type FROM events""")
def loyalty(t):
    bronze = t.events.select(F.col("event_id").alias("point_id"), "user_id", F.col("value").alias("point_balance"), "ts", "event_type")
    return silver_master(bronze, ["point_id", "user_id", "point_balance"], {"earned_date": "ts"},
                         codes={"event_type": {"purchase": 1, "refund": 0}})


def _ratio_sql(key):
    return f"""
    SELECT {key}, category_name, total_sales, total_sales * 100 / CAST(sum(CAST(total_sales AS DECIMAL(18,2)))
             OVER (PARTITION BY {key}) AS DOUBLE) AS sales_ratio
    FROM (SELECT {key}, category_name, {money('subtotal')} AS total_sales
          FROM {{lines}} l JOIN {{items}} i ON l.item_id = i.item_id JOIN ({_USERS}) u ON l.user_id = u.user_id GROUP BY ALL)"""


def _ratio(t, key):
    lines = t.lines.join(t.items, "item_id").join(_silver_users(t), "user_id")
    return ratio_within_group(lines, key, "category_name", "subtotal")


@query("c17_category_ratio_by_gender", _ratio_sql("gender"))
def ratio_by_gender(t):
    return _ratio(t, "gender")


@query("c17_category_ratio_by_age_group", _ratio_sql("age_group_10"))
def ratio_by_age(t):
    return _ratio(t, "age_group_10")
