"""2.10 and 2.11: functions for SQL callers and parameterised reports."""

import numpy as np
from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.functions import dates as D
from lakeops.operators import text as X
from lakeops.plans import demand as DM
from lakeops.plans import summaries as SM
from lakeops.plans import table_functions as TF
from lakeops.queries.registry import query, with_stores
from lakeops.queries.sql import money

_STORE_LINES = """SELECT l.*, store_name, store_area, item_name, category_name FROM {lines} l
    JOIN {stores} s ON l.store_id = s.store_id JOIN {items} i ON l.item_id = i.item_id"""


def _store_lines(t):
    return with_stores(t, t.lines).join(t.items, "item_id")


@query("tf1_store_sales_ranking", f"""
    SELECT store_area, store_name, total_sales, total_quantity, uq_user_cnt, avg_purchases_per_user,
           CAST(row_number() OVER (ORDER BY total_sales DESC, store_name, store_area) AS INTEGER) AS row_num
    FROM (SELECT store_area, store_name, {money('subtotal')} AS total_sales, sum(quantity) AS total_quantity,
                 count(DISTINCT user_id) AS uq_user_cnt, count(*) / count(DISTINCT user_id) AS avg_purchases_per_user
          FROM ({_STORE_LINES}) GROUP BY ALL) ORDER BY row_num LIMIT 10""")
def tf1(t):
    return TF.store_sales_ranking(_store_lines(t))


@query("tf2_store_item_ranking", f"""
    SELECT *, CAST(row_number() OVER (ORDER BY total_sales DESC, store_name, item_id) AS INTEGER) AS row_num
    FROM (SELECT store_area, store_name, item_id, item_name, category_name, {money('subtotal')} AS total_sales,
                 sum(quantity) AS total_quantity
          FROM ({_STORE_LINES}) WHERE store_area = 'EUROPE' GROUP BY ALL) ORDER BY row_num LIMIT 10""")
def tf2(t):
    return TF.store_item_sales_ranking(_store_lines(t), area="EUROPE")


@query("tf3_store_item_stock", """
    SELECT n.store_id, n.item_id, inventory_date, stock_quantity, item_name, category_name, price,
           store_name, store_area
    FROM (SELECT * FROM {inventory}
          QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY inventory_date DESC, stock_quantity DESC) = 1) n
    JOIN {items} i ON n.item_id = i.item_id JOIN {stores} s ON n.store_id = s.store_id
    WHERE store_name = 'Supplier#000000003' ORDER BY store_name, item_name, n.item_id LIMIT 10""")
def tf3(t):
    return TF.store_item_stock(t.inventory, t.items.drop("maker"), t.stores.drop("prefecture"), store="Supplier#000000003")


@query("tf4_store_product_inventory", f"""
    WITH s AS (SELECT store_id, item_id, CAST(sum(CAST(subtotal AS DECIMAL(18,2)) * CAST(quantity AS BIGINT)) AS DOUBLE) AS total_sales
               FROM {{lines}} WHERE store_id = 5 GROUP BY ALL),
         p AS (SELECT item_id FROM {{lines}} WHERE store_id = 5 GROUP BY item_id
               ORDER BY sum(CAST(subtotal AS DECIMAL(18,2)) * CAST(quantity AS BIGINT)) DESC, item_id LIMIT 1)
    SELECT s.store_id, i.item_id AS product_id, item_name, category_name, maker, price, total_sales
    FROM s JOIN {{items}} i ON s.item_id = i.item_id WHERE i.item_id = (SELECT item_id FROM p)""")
def tf4(t):
    sales = t.lines.select("store_id", F.col("item_id").alias("product_id"),
                           (F.col("subtotal") * F.col("quantity")).alias("sales_value"))
    return TF.store_product_inventory(sales, t.items.withColumnRenamed("item_id", "product_id"), 5, _best_seller(sales, 5))


def _best_seller(sales, store):
    """Id of a store's best seller as a scalar subquery, so that the inventory report has a row."""
    totals = sales.filter(F.col("store_id") == store).groupBy("product_id").agg(
        C.money_sum("sales_value").alias("s"))
    return totals.orderBy(F.col("s").desc(), "product_id").limit(1).select("product_id").scalar()


@query("tf5_customer_purchases", """
    SELECT customer_id, stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity_purchased,
           CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent FROM {retail} GROUP BY ALL""")
def tf5(t):
    return TF.customer_purchases_summary(t.retail)


@query("tf6_product_sales", f"""
    SELECT stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
           CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           {money('unit_price')} / count(unit_price) AS avg_unit_price, count(DISTINCT customer_id) AS distinct_customers,
           count(DISTINCT order_no) AS total_invoices FROM {{retail}} GROUP BY ALL""")
def tf6(t):
    return TF.product_sales_summary(t.retail)


@query("tf7_customer_segment", """
    SELECT *, CASE WHEN total_spent > 600000 THEN '高価格層' WHEN total_spent >= 300000 THEN '中価格層' ELSE '低価格層' END
             AS customer_segment
    FROM (SELECT customer_id, CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
          FROM {retail} GROUP BY ALL)""")
def tf7(t):
    return TF.customer_segment(t.retail, high=600000, mid=300000)


@query("tf8_sales_by_time", f"""
    SELECT CAST(ts AS DATE) AS order_date, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS order_hour,
           CAST(sum(user_id) AS BIGINT) AS total_quantity,
           CAST(sum(user_id * CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM events GROUP BY ALL""")
def tf8(t):
    return TF.sales_by_time_summary(_hours(t))


_TEXTS = """SELECT survey_category, CAST(0 AS BIGINT) AS part,
    array_to_string(list_sort(list(DISTINCT response_content)), chr(10)) AS response_contents FROM {survey} GROUP BY survey_category"""


@query("tf9_inquiry_texts", _TEXTS)
def tf9_texts(t):
    return TF.inquiry_texts(t.survey)


@query("tf9_summarize_inquiries", f"""
    SELECT s.survey_category, avg(positive_score) AS positive_score, count(*) AS n_responses,
           any_value(substr(trim(regexp_extract(response_contents, '^[^.!?。！？\\n]*')), 1, 30)) AS summary
    FROM {{survey}} s JOIN ({_TEXTS}) x ON s.survey_category = x.survey_category GROUP BY s.survey_category""")
def tf9(t):
    return TF.summarize_inquiries(t.survey)


@query("tf9_ranked_summaries", """
    SELECT survey_category, avg(positive_score) AS positive_score, count(*) AS n_responses, count(DISTINCT response_content) AS n_answers,
           CAST(1 AS BIGINT) AS n_summaries, TRUE AS sentences_of_the_answers FROM {survey} GROUP BY survey_category""")
def tf9_ranked(t):
    # One summary of all answers per category; each of its sentences is one of an answer.
    out = TF.summarize_inquiries_ranked(t.survey, n=2, sep="\n")
    said = SM.sentences(t.survey, ["survey_category"], "response_content").select("g", "sentence")
    shown = SM.keyed(out, ["survey_category"]).select("g", F.explode(F.split("summary", "\n")).alias("sentence"))
    missing = shown.join(said, ["g", "sentence"], "left_anti").count()
    answers = t.survey.groupBy("survey_category").agg(F.count_distinct("response_content").alias("n_answers"))
    n = out.groupBy("survey_category").agg(F.count(F.lit(1)).alias("n_summaries"))
    return out.join(answers, "survey_category").join(n, "survey_category").select(
        "survey_category", "positive_score", "n_responses", "n_answers", "n_summaries",
        (F.lit(missing == 0) & (F.col("summary") != "")).alias("sentences_of_the_answers"))


# --- user functions --------------------------------------------------------


@query("ud1_base64_text", "SELECT item_id, base64(encode(text)) AS b64 FROM benchmark")
def ud1(t):
    return t.benchmark.select("item_id", C.base64_text(F.encode("text", "UTF-8")).alias("b64"))


@query("ud2_date_text_function", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def ud2(t):
    text = F.concat(F.dayofmonth("o_orderdate"), F.lit("th "), F.date_format("o_orderdate", "MMMM yyyy"))
    return t.orders.select("o_orderkey", D.ordinal_date(text).alias("iso"))


@query("ud3_prompt_text", """
    SELECT doc_id, '[task]' || chr(10) || text || chr(10) || lang || chr(10) || coalesce(source, '') || chr(10) || '[end]' AS prompt
    FROM documents""")
def ud3(t):
    return t.documents.select("doc_id", X.join_texts("text", "lang", "source", head="[task]", tail="[end]").alias("prompt"))


def star_scorer():
    """Rule scorer: more commas, fewer stars; empty text fails."""
    def score(texts):
        out = []
        for s in texts:
            if not s:
                raise ValueError("empty text")
            out.append((f"{1 + s.count(',') % 5} stars", 0.5))
        return out
    return score


@query("ud4_batch_sentiment", """
    SELECT doc_id, CAST(1 + (len(text) - len(replace(text, ',', ''))) % 5 AS DOUBLE) * 0.5 AS positive_score
    FROM documents""")
def ud4(t):
    return X.sentiment(t.documents.select("doc_id", "text"), "text", star_scorer).drop("text")


@query("ud5_forecast_per_group", """
    WITH d AS (SELECT event_type, ts::DATE AS ds, ln(1 + count(*)) AS ly FROM events GROUP BY ALL)
    SELECT event_type, count(*) + 14 AS n_rows, CAST(14 AS BIGINT) AS n_future, TRUE AS ordered,
           round(CAST(var_pop(ly) * count(*) AS DOUBLE), 6) AS spread, TRUE AS fits FROM d GROUP BY event_type""")
def ud5(t):
    series = t.events.select("event_type", F.to_date("ts").alias("ds"), F.lit(1).alias("y"))
    return DM.forecast_fit(DM.forecast(series, ["event_type"], horizon=14), ["event_type"])


@query("ud6_metrics_per_group", """
    SELECT event_type, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
           round(avg(abs(e / nullif(value, 0))) * 100, 6) AS mape, round(median(abs(e / nullif(value, 0))) * 100, 6) AS mdape
    FROM (SELECT event_type, value, value - CAST(user_id % 20 AS DOUBLE) AS e FROM events) GROUP BY event_type""")
def ud6(t):
    rows = t.events.withColumn("guess", F.pmod("user_id", F.lit(20)).cast("double"))
    m = DM.forecast_metrics(rows, ["event_type"], "value", "guess")
    return m.withColumns({c: F.round(c, 6) for c in ("mae", "mse", "rmse", "mape", "mdape")})


def risk_scorer():
    """A logistic model of three columns, loaded once per task."""
    weights, bias = np.array([0.0001, 0.3, -0.5]), 0.25

    def score(rows):
        x = rows[["c_acctbal", "c_nationkey", "urgent"]].to_numpy(dtype=float)
        return 1.0 / (1.0 + np.exp(-(x @ weights + bias)))
    return score


@query("ud7_score_with_model", """
    SELECT c_custkey, round(1 / (1 + exp(-(c_acctbal * 0.0001::DOUBLE + c_nationkey * 0.3::DOUBLE
             - CAST(c_mktsegment = 'BUILDING' AS INTEGER) * 0.5::DOUBLE + 0.25::DOUBLE))), 9) AS prediction FROM customer""")
def ud7(t):
    rows = t.customer.withColumn("urgent", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    scored = X.score_rows(rows, ["c_acctbal", "c_nationkey", "urgent"], risk_scorer)
    return scored.select("c_custkey", F.round("prediction", 9).alias("prediction"))


def mirror_scorer():
    """Rule scorer that fails on French text."""
    def score(texts):
        for s in texts:
            if "é" in s:
                raise ValueError("cannot read")
        return [s[::-1] for s in texts]
    return score


@query("ud8_text_model_with_errors", """
    SELECT doc_id, CASE WHEN contains(text, 'é') THEN NULL ELSE CAST(len(text) AS BIGINT) END AS n FROM documents""")
def ud8(t):
    done = X.map_text(t.documents.select("doc_id", "text"), "text", mirror_scorer, "result", retries=0)
    return done.select("doc_id", F.length("result").cast("bigint").alias("n"))


@query("ud9_sql_scalar_functions", """
    SELECT event_id, '***@example.com' AS masked, CAST(user_id AS VARCHAR) || '@x' AS open,
           make_timestamp(2024, 1, CAST(day(ts) AS BIGINT), CAST(hour(ts) AS BIGINT), 5, 0) AS t FROM events""")
def ud9(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("""
        SELECT event_id, mask_email(CAST(user_id AS STRING) || '@x', false) AS masked,
               mask_email(CAST(user_id AS STRING) || '@x', true) AS open,
               CAST(transform_date(concat('1/', day(ts), '/24 ', hour(ts), ':05')) AS TIMESTAMP_NTZ) AS t
        FROM {e}""", e=t.events)


@query("ud10_sql_table_function", f"""
    SELECT store_area, store_name, item_id, total_sales,
           CAST(row_number() OVER (ORDER BY total_sales DESC, store_name, item_id) AS INTEGER) AS row_num
    FROM (SELECT store_area, store_name, item_id, {money('subtotal')} AS total_sales
          FROM ({_STORE_LINES}) WHERE store_area = 'ASIA' GROUP BY ALL) ORDER BY row_num LIMIT 5""")
def ud10(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM top_store_items(p_area => 'ASIA', limit_rows => 5)")


@query("ud10_sql_spend_segments", """
    SELECT *, CASE WHEN total_spent > 600000 THEN '高価格層' WHEN total_spent >= 300000 THEN '中価格層' ELSE '低価格層' END
             AS customer_segment
    FROM (SELECT customer_id, CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
          FROM {retail} GROUP BY ALL)""")
def ud10_segments(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM spend_segments(high => 600000, mid => 300000)")


@query("ud10_sql_daily_sales", """
    SELECT order_date, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM {retail} GROUP BY ALL""")
def ud10_daily(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM daily_sales()")


@query("ud10_sql_store_stock", """
    SELECT store_name, item_name, n.item_id, inventory_date, stock_quantity
    FROM (SELECT * FROM {inventory}
          QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY inventory_date DESC, stock_quantity DESC) = 1) n
    JOIN {items} i ON n.item_id = i.item_id JOIN {stores} s ON n.store_id = s.store_id
    WHERE store_name = 'Supplier#000000003' ORDER BY store_name, item_name, n.item_id LIMIT 10""")
def ud10_stock(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM store_stock(p_store => 'Supplier#000000003')")


@query("ud10_sql_customer_purchases", """
    SELECT customer_id, stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity_purchased,
           CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent FROM {retail} GROUP BY ALL""")
def ud10_purchases(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM customer_purchases()")


@query("ud10_sql_product_sales", """
    SELECT stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
           CAST(sum(quantity * CAST(unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           count(DISTINCT customer_id) AS distinct_customers FROM {retail} GROUP BY ALL""")
def ud10_products(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM product_sales()")


@query("ud10_sql_hourly_sales", """
    SELECT CAST(ts AS DATE) AS order_date, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS order_hour,
           CAST(sum(user_id) AS BIGINT) AS total_quantity,
           CAST(sum(user_id * CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM events GROUP BY ALL""")
def ud10_hours(t):
    TF.register_sql_functions(_with_views(t))
    return t.spark.sql("SELECT * FROM hourly_sales()")


def _hours(t):
    return t.events.select(
        F.to_date("ts").alias("order_date"), F.lpad(F.hour("ts").cast("string"), 2, "0").alias("order_hour"),
        F.col("user_id").alias("quantity"), F.col("value").alias("unit_price"))


def _with_views(t):
    _store_lines(t).createOrReplaceTempView("store_items")
    _hours(t).createOrReplaceTempView("retail_hours")
    t.inventory.createOrReplaceTempView("inventory")
    t.stores.createOrReplaceTempView("stores")
    t.items.createOrReplaceTempView("items")
    t.retail.createOrReplaceTempView("retail")
    return t.spark
