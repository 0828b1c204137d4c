"""Parameterised analytics: DataFrame functions and their SQL twins.

``register_sql_functions`` creates temporary SQL table functions over views, so
that the same reports can be called as ``SELECT * FROM store_sales_ranking(5)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions.columns import cents, money_sum
from lakeops.operators.aggregates import concat_group
from lakeops.operators.clean import optional_filter
from lakeops.operators.null_safe import null_safe_join
from lakeops.operators.text import summarise
from lakeops.operators.windows import latest_per_key, ranked_totals
from lakeops.plans.summaries import ranked_summaries


def store_sales_ranking(items: DataFrame, limit: int = 10) -> DataFrame:
    """Best stores by sales; the store id settles ties."""
    known = items.dropna(subset=["quantity", "subtotal", "user_id"])
    totals = known.groupBy("store_area", "store_name").agg(
        money_sum("subtotal").alias("total_sales"), F.sum("quantity").alias("total_quantity"),
        F.count_distinct("user_id").alias("uq_user_cnt"), F.count("order_item_id").alias("_n"))
    totals = totals.withColumn("avg_purchases_per_user", F.col("_n") / F.col("uq_user_cnt")).drop("_n")
    return ranked_totals(totals, [F.col("total_sales").desc(), F.col("store_name"), F.col("store_area")], limit)


def store_item_sales_ranking(items: DataFrame, area: str | None = None, store: str | None = None,
                             limit: int = 10) -> DataFrame:
    """Best store × item pairs by sales, for all or one area or store."""
    totals = optional_filter(items, {"store_area": area, "store_name": store}).groupBy(
        "store_area", "store_name", "item_id", "item_name", "category_name").agg(
        money_sum("subtotal").alias("total_sales"), F.sum("quantity").alias("total_quantity"))
    return ranked_totals(totals, [F.col("total_sales").desc(), F.col("store_name"), F.col("item_id")], limit)


def store_item_stock(inventory: DataFrame, items: DataFrame, stores: DataFrame, store: str | None = None,
                     item: str | None = None, limit: int = 10) -> DataFrame:
    """Newest stock per store and item with its masters, in name order.

    A store or item filter narrows its master first and thereby the history.
    """
    keyed = inventory.dropna(subset=["store_id", "item_id"])
    store_dim = optional_filter(stores, {"store_name": store})
    item_dim = optional_filter(items, {"item_name": item})
    if store is not None:
        keyed = keyed.join(store_dim.select("store_id"), "store_id", "left_semi")
    if item is not None:
        keyed = keyed.join(item_dim.select("item_id"), "item_id", "left_semi")
    newest = latest_per_key(keyed, ["store_id", "item_id"], ["inventory_date"], ["stock_quantity"])
    named = newest.join(item_dim, "item_id", "left").join(store_dim, "store_id", "left")
    return ranked_totals(named, [F.col("store_name"), F.col("item_name"), F.col("item_id")], limit).drop("row_num")


def store_product_inventory(sales: DataFrame, products: DataFrame, store_id: int, product_id: int | Column,
                            any_rank: bool = False) -> DataFrame:
    """Stock of a product in a store, with its sales there.

    As a rule the row comes back only if the product is the store's best
    seller; ``any_rank`` lifts that.
    """
    totals = sales.filter(F.col("store_id") == store_id).groupBy("store_id", "product_id").agg(
        money_sum("sales_value").alias("total_sales"))
    if any_rank:
        chosen = totals
    else:
        chosen = totals.orderBy(F.col("total_sales").desc(), F.col("product_id")).limit(1)
    return products.filter(F.col("product_id") == product_id).join(chosen, "product_id")


def customer_purchases_summary(retail: DataFrame) -> DataFrame:
    return retail.groupBy("customer_id", "stock_code").agg(
        F.sum("quantity").alias("total_quantity_purchased"), _spend().alias("total_spent"))


def product_sales_summary(retail: DataFrame) -> DataFrame:
    return retail.groupBy("stock_code").agg(
        F.sum("quantity").alias("total_quantity_sold"), _spend().alias("total_revenue"),
        (F.sum(cents("unit_price")) / 100.0 / F.count("unit_price")).alias("avg_unit_price"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("order_no").alias("total_invoices"))


def customer_segment(retail: DataFrame, high: float = 1000, mid: float = 500) -> DataFrame:
    spend = retail.groupBy("customer_id").agg(_spend().alias("total_spent"))
    label = F.when(F.col("total_spent") > high, L.SEGMENT_HIGH).when(
        F.col("total_spent") >= mid, L.SEGMENT_MID).otherwise(L.SEGMENT_LOW)
    return spend.withColumn("customer_segment", label)


def sales_by_time_summary(retail: DataFrame) -> DataFrame:
    return retail.groupBy("order_date", "order_hour").agg(
        F.sum("quantity").alias("total_quantity"), _spend().alias("total_revenue"))


def _spend() -> Column:
    return F.sum(F.col("quantity") * cents("unit_price")) / F.lit(100.0)


def inquiry_texts(survey: DataFrame, max_bytes: int = 32 << 20, sep: str = "\n") -> DataFrame:
    """The distinct answers of a category as one text per part of at most about ``max_bytes``."""
    answers = survey.select("survey_category", "response_content").distinct()
    return concat_group(answers, ["survey_category"], "response_content", ["response_content"], sep, max_bytes,
                        "response_contents")


def summarize_inquiries(survey: DataFrame, make_summary: Callable[[Column], Column] = summarise,
                        max_bytes: int = 32 << 20) -> DataFrame:
    """Per category: mean score, number of answers and a summary of the distinct answers.

    The joined answers are summarised part by part (a category has one part
    unless its answers exceed ``max_bytes``), and the short summaries are joined
    by line. Answers without a category are a category of their own.
    """
    scores = survey.groupBy("survey_category").agg(
        F.avg("positive_score").alias("positive_score"), F.count(F.lit(1)).alias("n_responses"))
    short = inquiry_texts(survey, max_bytes).select(
        "survey_category", F.struct("part", make_summary(F.col("response_contents")).alias("text")).alias("_s"))
    summaries = short.groupBy("survey_category").agg(
        F.array_join(F.sort_array(F.collect_list("_s"))["text"], "\n").alias("summary"))
    return null_safe_join(scores, summaries, ["survey_category"], "left")


def summarize_inquiries_ranked(survey: DataFrame, n: int = 3, sep: str = ". ") -> DataFrame:
    """Per category: mean score, number of answers, and a summary in which every answer takes part, see ``summaries``."""
    scores = survey.groupBy("survey_category").agg(
        F.avg("positive_score").alias("positive_score"), F.count(F.lit(1)).alias("n_responses"))
    return null_safe_join(scores, ranked_summaries(survey, ["survey_category"], "response_content", n, sep), ["survey_category"], "left")


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions over the views ``retail``, ``retail_hours`` (with the
    hour), ``store_items``, ``inventory``, ``stores`` and ``items``."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION transform_date(t STRING) RETURNS TIMESTAMP "
        "RETURN try_to_timestamp(t, 'M/d/yy H:mm')")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_email(email STRING, privileged BOOLEAN) RETURNS STRING "
        "RETURN CASE WHEN privileged THEN email ELSE '***@example.com' END")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION top_stores(limit_rows INT DEFAULT 10)
        RETURNS TABLE (store_area STRING, store_name STRING, total_sales DOUBLE, total_quantity DOUBLE,
                       row_num INT)
        READS SQL DATA
        RETURN
          SELECT store_area, store_name, total_sales, total_quantity, row_num
          FROM (SELECT *, row_number() OVER (ORDER BY total_sales DESC, store_name, store_area) AS row_num
                FROM (SELECT store_area, store_name,
                             sum(CAST(rint(subtotal * 100) AS BIGINT)) / 100.0D AS total_sales,
                             sum(quantity) AS total_quantity
                      FROM store_items GROUP BY store_area, store_name))
          WHERE row_num <= limit_rows""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION top_store_items(
          p_area STRING DEFAULT NULL, p_store STRING DEFAULT NULL, limit_rows INT DEFAULT 10)
        RETURNS TABLE (store_area STRING, store_name STRING, item_id BIGINT, total_sales DOUBLE, row_num INT)
        READS SQL DATA
        RETURN
          SELECT store_area, store_name, item_id, total_sales, row_num
          FROM (SELECT *, row_number() OVER (ORDER BY total_sales DESC, store_name, item_id) AS row_num
                FROM (SELECT store_area, store_name, item_id,
                             sum(CAST(rint(subtotal * 100) AS BIGINT)) / 100.0D AS total_sales
                      FROM store_items
                      WHERE (p_area IS NULL OR store_area = p_area)
                        AND (p_store IS NULL OR store_name = p_store)
                      GROUP BY store_area, store_name, item_id))
          WHERE row_num <= limit_rows""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION spend_segments(high DOUBLE DEFAULT 1000, mid DOUBLE DEFAULT 500)
        RETURNS TABLE (customer_id STRING, total_spent DOUBLE, customer_segment STRING)
        READS SQL DATA
        RETURN
          SELECT customer_id, total_spent,
                 CASE WHEN total_spent > high THEN '%s' WHEN total_spent >= mid THEN '%s' ELSE '%s' END
          FROM (SELECT customer_id, sum(quantity * CAST(rint(unit_price * 100) AS BIGINT)) / 100.0D AS total_spent
                FROM retail GROUP BY customer_id)""" % (L.SEGMENT_HIGH, L.SEGMENT_MID, L.SEGMENT_LOW))
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION daily_sales(p_from DATE DEFAULT NULL, p_to DATE DEFAULT NULL)
        RETURNS TABLE (order_date DATE, total_quantity BIGINT, total_revenue DOUBLE)
        READS SQL DATA
        RETURN
          SELECT order_date, sum(quantity), sum(quantity * CAST(rint(unit_price * 100) AS BIGINT)) / 100.0D
          FROM retail
          WHERE (p_from IS NULL OR order_date >= p_from) AND (p_to IS NULL OR order_date <= p_to)
          GROUP BY order_date""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION store_stock(
          p_store STRING DEFAULT NULL, p_item STRING DEFAULT NULL, limit_rows INT DEFAULT 10)
        RETURNS TABLE (store_name STRING, item_name STRING, item_id BIGINT, inventory_date DATE, stock_quantity DOUBLE)
        READS SQL DATA
        RETURN
          SELECT store_name, item_name, item_id, inventory_date, stock_quantity
          FROM (SELECT *, row_number() OVER (ORDER BY store_name, item_name, item_id) AS at
                FROM (SELECT s.store_name, i.item_name, n.item_id, n.inventory_date, n.stock_quantity,
                             row_number() OVER (PARTITION BY n.store_id, n.item_id
                                                ORDER BY n.inventory_date DESC, n.stock_quantity DESC) AS newest
                      FROM inventory n JOIN stores s ON n.store_id = s.store_id JOIN items i ON n.item_id = i.item_id
                      WHERE (p_store IS NULL OR s.store_name = p_store) AND (p_item IS NULL OR i.item_name = p_item))
                WHERE newest = 1)
          WHERE at <= limit_rows""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_purchases(p_customer STRING DEFAULT NULL)
        RETURNS TABLE (customer_id STRING, stock_code STRING, total_quantity_purchased BIGINT, total_spent DOUBLE)
        READS SQL DATA
        RETURN
          SELECT customer_id, stock_code, sum(quantity), sum(quantity * CAST(rint(unit_price * 100) AS BIGINT)) / 100.0D
          FROM retail WHERE p_customer IS NULL OR customer_id = p_customer GROUP BY customer_id, stock_code""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION product_sales(p_code STRING DEFAULT NULL)
        RETURNS TABLE (stock_code STRING, total_quantity_sold BIGINT, total_revenue DOUBLE, distinct_customers BIGINT)
        READS SQL DATA
        RETURN
          SELECT stock_code, sum(quantity), sum(quantity * CAST(rint(unit_price * 100) AS BIGINT)) / 100.0D,
                 count(DISTINCT customer_id)
          FROM retail WHERE p_code IS NULL OR stock_code = p_code GROUP BY stock_code""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION hourly_sales(p_from DATE DEFAULT NULL, p_to DATE DEFAULT NULL)
        RETURNS TABLE (order_date DATE, order_hour STRING, total_quantity BIGINT, total_revenue DOUBLE)
        READS SQL DATA
        RETURN
          SELECT order_date, order_hour, sum(quantity), sum(quantity * CAST(rint(unit_price * 100) AS BIGINT)) / 100.0D
          FROM retail_hours
          WHERE (p_from IS NULL OR order_date >= p_from) AND (p_to IS NULL OR order_date <= p_to)
          GROUP BY order_date, order_hour""")
