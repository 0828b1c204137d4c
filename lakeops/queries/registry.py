"""Query registry, lazy table access and the stand-in views.

The test tables stand in for the business tables: ``orders`` for order headers,
``lineitem`` for order lines, ``customer`` for users, ``part`` for items,
``supplier``/``nation``/``region`` for stores and areas, ``events`` for logs and
change streams, ``documents`` for reviews. ``V`` holds the same views as SQL
for the check queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.writers import with_known_size

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


class Tables:
    """The test tables and the stand-in views, each read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        if name in _VIEWS:
            return _VIEWS[name](self)
        raise AttributeError(name)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its check query, with ``{view}`` names
    expanded from :data:`V`."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn
    return register


def expand(sql: str) -> str:
    """Replace ``{view}`` by the view's SQL in parentheses (views may nest)."""
    for _ in range(4):
        for key, text in V.items():
            sql = sql.replace("{" + key + "}", f"({text})")
    return sql


V = {
    # order headers; the channel follows the order priority
    "sales": "SELECT o_orderkey AS order_id, o_custkey AS user_id, "
             "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EC' ELSE 'POS' END AS channel, "
             "o_totalprice AS total_amount, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, "
             "o_orderpriority FROM orders",
    # lines with their order, item and channel; cancelled when returned. The line id
    # repeats now and then in the test data; with the subtotal it is unique.
    "lines": "SELECT l_orderkey * 8 + l_linenumber AS order_item_id, "
             "l_orderkey AS order_id, o_custkey AS user_id, l_suppkey AS store_id, l_partkey AS item_id, "
             "l_quantity AS quantity, l_extendedprice AS subtotal, l_returnflag = 'R' AS cancel_flg, "
             "CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date, "
             "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'EC' ELSE 'POS' END AS channel "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    # the same lines where nothing of the order is needed
    "line_facts": "SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id, "
                  "l_suppkey AS store_id, l_partkey AS item_id, l_quantity AS quantity, "
                  "l_extendedprice AS subtotal, l_returnflag = 'R' AS cancel_flg, "
                  "CAST(l_shipdate AS DATE) AS ship_date FROM lineitem",
    "items": "SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category_name, p_brand AS maker, "
             "p_retailprice AS price FROM part",
    "stores": "SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS store_area, n_name AS prefecture "
              "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "users": "SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment, n_name AS pref, "
             "r_name AS area FROM customer JOIN nation ON c_nationkey = n_nationkey "
             "JOIN region ON n_regionkey = r_regionkey",
    # stock movements
    "inventory": "SELECT l_suppkey AS store_id, l_partkey AS item_id, CAST(l_shipdate AS DATE) AS inventory_date, "
                 "l_quantity AS stock_quantity FROM lineitem",
    # survey answers: one per labelled document
    "survey": "SELECT doc_id AS response_id, doc_id % 100 AS user_id, lang AS survey_category, "
              "text AS response_content, DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS response_date, "
              "CAST(quality AS DOUBLE) AS positive_score FROM documents JOIN labels USING (doc_id)",
    # daily demand per store and category
    "demand": "SELECT CAST(l_shipdate AS DATE) AS ds, l_suppkey AS machine_id, p_type AS item, "
              "CAST(sum(l_quantity) AS BIGINT) AS y FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    # online retail lines
    "retail": "SELECT CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_partkey AS VARCHAR) AS stock_code, "
              "CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_quantity AS BIGINT) AS quantity, "
              "p_retailprice AS unit_price, CAST(o_orderdate AS DATE) AS order_date "
              "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    # transfers: a customer pays a supplier's account
    "transfers": "SELECT o_custkey AS payer_cust_id, l_suppkey AS payee_cust_id, l_extendedprice AS txn_amt, "
                 "o_orderdate AS datetime FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
}


def _channel():
    return F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "EC").otherwise("POS")


def _sales(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), _channel().alias("channel"),
        F.col("o_totalprice").alias("total_amount"), F.to_date("o_orderdate").alias("order_date"), "o_orderstatus",
        "o_orderpriority")


def _line_facts(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("subtotal"),
        (F.col("l_returnflag") == "R").alias("cancel_flg"), F.to_date("l_shipdate").alias("ship_date"))


def _lines(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                             F.to_date("o_orderdate").alias("order_date"), _channel().alias("channel"))
    return _line_facts(t).join(orders, "order_id")


def _items(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
                         F.col("p_type").alias("category_name"), F.col("p_brand").alias("maker"),
                         F.col("p_retailprice").alias("price"))


def _stores(t: Tables) -> DataFrame:
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
                F.col("r_name").alias("store_area"), F.col("n_name").alias("prefecture"))
    )


def with_stores(t: Tables, facts: DataFrame, *cols: str) -> DataFrame:
    """Facts with columns of their store, by joins with tables whose sizes Spark knows: nothing is written, and
    the facts are shuffled only for tables too large to be sent."""
    wide = (
        facts.join(t.supplier, F.col("store_id") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    named = {"store_name": "s_name", "store_area": "r_name", "prefecture": "n_name"}
    return wide.select(*facts.columns, *[F.col(named[c]).alias(c) for c in cols or named])


def _store_dim(t: Tables) -> DataFrame:
    """The stores as a table whose size Spark knows, for joins with the lines."""
    return with_known_size(t.stores)


def _users(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("pref"),
                F.col("r_name").alias("area"))
    )


def _inventory(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("item_id"),
        F.to_date("l_shipdate").alias("inventory_date"), F.col("l_quantity").alias("stock_quantity"))


def _survey(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").alias("response_id"), F.pmod("doc_id", F.lit(100)).alias("user_id"),
        F.col("lang").alias("survey_category"), F.col("text").alias("response_content"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(28)).cast("int")).alias("response_date"),
        F.col("quality").cast("double").alias("positive_score"))


def _demand(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.to_date("l_shipdate").alias("ds"), F.col("l_suppkey").alias("machine_id"),
                 F.col("p_type").alias("item"))
        .agg(F.sum("l_quantity").cast("bigint").alias("y"))
    )


def _retail(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").cast("string").alias("order_no"), F.col("l_partkey").cast("string").alias("stock_code"),
                F.col("o_custkey").cast("string").alias("customer_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
                F.col("p_retailprice").alias("unit_price"), F.to_date("o_orderdate").alias("order_date"))
    )


def _transfers(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("payer_cust_id"), F.col("l_suppkey").alias("payee_cust_id"),
        F.col("l_extendedprice").alias("txn_amt"), F.col("o_orderdate").alias("datetime"))


_VIEWS = {"sales": _sales, "lines": _lines, "line_facts": _line_facts, "items": _items, "stores": _stores, "store_dim": _store_dim, "users": _users,
          "inventory": _inventory, "survey": _survey, "demand": _demand, "retail": _retail,
          "transfers": _transfers}
