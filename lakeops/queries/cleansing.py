"""2.2 projections, filters and cleansing."""

from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.operators import clean as K
from lakeops.operators.quality import expect_or_drop
from lakeops.queries.registry import query

# Order status texts and codes.
STATUS_CODES = {"F": 1, "O": 2}
# Item type to image address.
TYPE_IMAGES = {
    "ECONOMY": "img/01.jpg", "STANDARD": "img/02.jpg", "SMALL": "img/03.jpg", "MEDIUM": "img/04.jpg",
    "LARGE": "img/05.jpg",
}
RULES = {"qty_known": "l_quantity IS NOT NULL", "qty_small": "l_quantity <= 45", "price_ok": "l_extendedprice > 5000"}


@query("prj1_typed_projection", """
    SELECT CAST(o_orderkey AS VARCHAR) AS booking_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS flight_date,
           CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS fare_amount FROM orders""")
def prj1(t):
    return K.project(t.orders, {
        "booking_id": "CAST(o_orderkey AS STRING)", "user_id": "o_custkey", "flight_date": "to_date(o_orderdate)",
        "fare_amount": "CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE)"})


@query("prj2_select_except", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def prj2(t):
    return K.select_except(t.customer, ["c_nationkey", "c_acctbal"])


@query("prj3_derived_columns", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym FROM orders""")
def prj3(t):
    return K.derive(t.orders.select("o_orderkey", "o_orderdate"), [
        ("y", "year(o_orderdate)"), ("m", "month(o_orderdate)"), ("ym", "y * 100 + m")]).drop("o_orderdate")


@query("prj4_lateral_alias", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def prj4(t):
    return t.spark.sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                 l_extendedprice * (1 - l_discount) AS net, net * (1 + l_tax) AS gross
                          FROM {lines}""", lines=t.lineitem)


@query("prj5_flags", """
    SELECT doc_id, coalesce(CAST(toxic = 1 AS INTEGER), 0) AS toxic_flg,
           coalesce(CAST(quality = 1 AS INTEGER), 0) AS quality_flg
    FROM documents LEFT JOIN labels USING (doc_id)""")
def prj5(t):
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", C.flag(F.col("toxic") == 1).alias("toxic_flg"), C.flag(F.col("quality") == 1).alias("quality_flg"))


@query("prj6_status_code", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS status FROM orders""")
def prj6(t):
    return t.orders.select("o_orderkey", C.status_code("o_orderstatus", STATUS_CODES).alias("status"))


@query("prj7_value_mapping", """
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'img/01.jpg' WHEN 'STANDARD' THEN 'img/02.jpg'
      WHEN 'SMALL' THEN 'img/03.jpg' WHEN 'MEDIUM' THEN 'img/04.jpg' WHEN 'LARGE' THEN 'img/05.jpg' ELSE '' END AS img
    FROM part""")
def prj7(t):
    return t.part.select("p_partkey", C.map_values("p_type", TYPE_IMAGES).alias("img"))


@query("prj8_dirty_numbers", """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL WHEN 'view' THEN NULL
                                     ELSE value END AS temperature FROM events""")
def prj8(t):
    raw = (F.when(F.col("event_type") == "error", F.lit(" N/A")).when(F.col("event_type") == "signup", F.lit("  "))
           .when(F.col("event_type") == "view", F.concat(F.lit("x"), F.col("value").cast("string")))
           .otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))))
    return t.events.select("event_id", C.clean_numeric(raw).alias("temperature"))


@query("prj9_clean_names", 'SELECT c_custkey AS "customerid-key", c_acctbal AS accountbalance FROM customer')
def prj9(t):
    return K.clean_names(t.customer.select(F.col("c_custkey").alias("customer id (key)"),
                                           F.col("c_acctbal").alias("account balance")))


@query("prj10_cast_to_schema", """
    SELECT event_id, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS INTEGER) AS k,
           CAST(NULL AS INTEGER) AS event_type, value AS value FROM events""")
def prj10(t):
    raw = t.events.select(F.col("event_id").cast("string").alias("event_id"),
                          F.get_json_object("props", "$.k").alias("k"), "event_type",
                          F.col("value").cast("string").alias("value"))
    return K.cast_to_schema(raw, "event_id bigint, k int, event_type int, value double")


@query("flt1_expect_or_drop", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_quantity IS NOT NULL AND l_quantity <= 45 AND l_extendedprice > 5000""")
def flt1(t):
    return expect_or_drop(t.lineitem, RULES).good.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("flt1_expectation_metrics", """
    SELECT 'qty_known' AS rule, count(*) FILTER (l_quantity IS NOT NULL) AS passed,
           count(*) FILTER (l_quantity IS NULL) AS failed FROM lineitem
    UNION ALL SELECT 'qty_small', count(*) FILTER (l_quantity <= 45), count(*) FILTER (l_quantity > 45) FROM lineitem
    UNION ALL SELECT 'price_ok', count(*) FILTER (l_extendedprice > 5000),
                     count(*) FILTER (l_extendedprice <= 5000) FROM lineitem""")
def flt1_metrics(t):
    return expect_or_drop(t.lineitem, RULES).metrics


@query("flt2_predicates", """
    SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 40 AND p_type IN ('SMALL', 'LARGE')
      AND p_name LIKE '%ring%' AND p_brand IS NOT NULL AND contains(p_name, 'o')""")
def flt2(t):
    return t.part.filter("p_size BETWEEN 10 AND 40 AND p_type IN ('SMALL', 'LARGE') AND p_name LIKE '%ring%' "
                         "AND p_brand IS NOT NULL AND contains(p_name, 'o')").select("p_partkey")


@query("flt3_optional_filter", "SELECT store_id, store_name FROM {stores} WHERE store_area = 'ASIA'")
def flt3(t):
    return K.optional_filter(t.stores, {"store_area": "ASIA", "store_name": None}).select("store_id", "store_name")


@query("flt4_active_only", "SELECT order_item_id, subtotal FROM {line_facts} WHERE NOT cancel_flg")
def flt4(t):
    return K.active_only(t.line_facts, "cancel_flg").select("order_item_id", "subtotal")


@query("flt5_nulls_to_zero", """
    SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""")
def flt5(t):
    return K.fill_zero(t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic"))


@query("flt5_drop_nulls", """
    SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def flt5_drop(t):
    return K.drop_incomplete(t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic"))


@query("flt6_latest_partition", """
    SELECT order_id, user_id, order_date FROM {sales} WHERE order_date = (SELECT max(order_date) FROM {sales})""")
def flt6(t):
    return K.latest_partition(t.sales, "order_date").select("order_id", "user_id", "order_date")


@query("flt7_conditional_update", """
    SELECT event_id, CASE WHEN user_id = 1 THEN 'updated' ELSE event_type END AS event_type,
           CASE WHEN user_id = 1 THEN 0 ELSE value END AS value FROM events""")
def flt7(t):
    return K.update_where(t.events.select("event_id", "user_id", "event_type", "value"), "user_id = 1",
                          {"event_type": F.lit("updated"), "value": F.lit(0.0)}).drop("user_id")


@query("flt8_suspicious_text", "SELECT doc_id, text FROM documents WHERE contains(text, ' th')")
def flt8(t):
    return K.suspicious_text(t.documents, "text", " th").select("doc_id", "text")
