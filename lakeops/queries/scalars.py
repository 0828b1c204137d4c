"""2.7 scalar functions."""

from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.functions import dates as D
from lakeops.queries.registry import AS_OF, query


@query("sf1_string_building", """
    SELECT c_custkey, concat('C-', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS code,
           concat_ws('/', c_mktsegment, c_name) AS path, translate(c_name, '#', '-') AS dashed,
           regexp_replace(c_name, '0+', '', 'g') AS short, trim('  ' || c_mktsegment || ' ') AS seg,
           printf('%06d', c_custkey) AS six FROM customer""")
def sf1(t):
    return t.customer.select(
        "c_custkey", F.concat(F.lit("C-"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("code"),
        F.concat_ws("/", "c_mktsegment", "c_name").alias("path"), F.translate("c_name", "#", "-").alias("dashed"),
        F.regexp_replace("c_name", "0+", "").alias("short"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("seg"),
        F.format_string("%06d", "c_custkey").alias("six"))


@query("sf2_split_and_pick", """
    SELECT page_id, split_part(url, '/', 3) AS host, CASE WHEN len(string_split(url, '/')) >= 9
           THEN string_split(url, '/')[9] END AS ninth FROM pages""")
def sf2(t):
    parts = F.split("url", "/")
    return t.pages.select("page_id", F.get(parts, F.lit(2)).alias("host"), F.try_element_at(parts, F.lit(9)).alias("ninth"))


@query("sf3_loose_timestamp", "SELECT o_orderkey, o_orderdate + INTERVAL 9 HOUR + INTERVAL 5 MINUTE AS ts FROM orders")
def sf3(t):
    text = F.concat(F.month("o_orderdate"), F.lit("/"), F.dayofmonth("o_orderdate"), F.lit("/"),
                    F.date_format("o_orderdate", "yy"), F.lit(" 9:05"))
    # Two-digit years are read as 20xx, so 19xx dates are moved back.
    ts = D.loose_timestamp(text)
    year = F.year("o_orderdate")
    return t.orders.select("o_orderkey", F.when(year < 2000, ts - F.expr("INTERVAL 100 YEAR")).otherwise(ts)
                           .cast("timestamp_ntz").alias("ts"))


@query("sf4_ordinal_dates", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_iso, strftime(o_orderdate, '%Y-%m') AS month_iso,
           NULL::VARCHAR AS unreadable FROM orders""")
def sf4(t):
    n = F.dayofmonth("o_orderdate")
    suffix = (F.when(n.isin(1, 21, 31), "st").when(n.isin(2, 22), "nd").when(n.isin(3, 23), "rd").otherwise("th"))
    text = F.concat(n, suffix, F.lit(" "), F.date_format("o_orderdate", "MMMM yyyy"))
    return t.orders.select("o_orderkey", D.ordinal_date(text).alias("day_iso"),
                           D.month_text(F.date_format("o_orderdate", "MMMM yyyy")).alias("month_iso"),
                           D.ordinal_date(F.col("o_orderpriority")).alias("unreadable"))


@query("sf5_date_parts", """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, strftime(ts, '%H:%M') AS hhmm,
           CAST(date_trunc('month', ts) AS DATE) AS month_start, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hh,
           CAST(ts AS DATE) AS d, strftime(ts, '%A') AS day_name FROM events""")
def sf5(t):
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofweek("ts").alias("dow"),
        F.date_format("ts", "HH:mm").alias("hhmm"), F.trunc(F.to_date("ts"), "MM").alias("month_start"),
        F.lpad(F.hour("ts").cast("string"), 2, "0").alias("hh"), F.to_date("ts").alias("d"),
        F.date_format("ts", "EEEE").alias("day_name"))


@query("sf6_date_arithmetic", f"""
    SELECT order_id, order_date - 30 AS before, order_date + 30 AS after,
           CAST(date_diff('day', order_date, DATE '{AS_OF}') AS INTEGER) AS days FROM {{sales}}""")
def sf6(t):
    return t.sales.select("order_id", F.date_sub("order_date", 30).alias("before"),
                          F.date_add("order_date", 30).alias("after"),
                          F.datediff(D.day(AS_OF), "order_date").alias("days"))


@query("sf7_age_bands", """
    SELECT order_id, CAST(floor(d / 365.25::DOUBLE) AS INTEGER) AS age,
           CAST(floor(d / 365.25::DOUBLE / 5) * 5 AS INTEGER) AS age_group_5,
           CAST(floor(d / 365.25::DOUBLE / 10) * 10 AS INTEGER) AS age_group_10
    FROM (SELECT order_id, date_diff('day', order_date, DATE '2030-06-01') AS d FROM {sales})""")
def sf7(t):
    return t.sales.select("order_id", D.age_years("order_date", "2030-06-01").alias("age"),
                          D.age_band("order_date", "2030-06-01", 5).alias("age_group_5"),
                          D.age_band("order_date", "2030-06-01", 10).alias("age_group_10"))


# Holidays used by the calendar checks.
HOLIDAYS = ["1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]


@query("sf8_quarter_and_holiday", """
    SELECT order_id, 'Q' || CAST(quarter(order_date) AS VARCHAR) AS quarter,
           CASE WHEN strftime(order_date, '%m-%d') = '01-01' AND year(order_date) BETWEEN 1997 AND 2001
                THEN 1 ELSE 0 END AS is_holiday FROM {sales}""")
def sf8(t):
    return t.sales.select("order_id", D.quarter_label("order_date").alias("quarter"),
                          D.holiday_flag("order_date", HOLIDAYS).alias("is_holiday"))


@query("sf9_weekday_number", "SELECT event_id, CAST(dayofweek(ts) AS INTEGER) AS weekday FROM events")
def sf9(t):
    return t.events.select("event_id", D.weekday_number("ts").alias("weekday"))


@query("sf10_time_zone", "SELECT event_id, ts + INTERVAL 9 HOUR AS local_ts FROM events")
def sf10(t):
    return t.events.select("event_id", D.local_time(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("local_ts"))


@query("sf11_fiscal_labels", """
    SELECT order_id, CAST(CASE WHEN month(order_date) >= 4 THEN year(order_date) ELSE year(order_date) - 1 END AS INTEGER)
             AS fiscal_year,
           CAST(CASE WHEN month(order_date) IN (4,5,6) THEN 1 WHEN month(order_date) IN (7,8,9) THEN 2
                     WHEN month(order_date) IN (10,11,12) THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter,
           CASE WHEN month(order_date) BETWEEN 4 AND 9 THEN 'H1' ELSE 'H2' END AS fiscal_half FROM {sales}""")
def sf11(t):
    return t.sales.select("order_id", D.fiscal_year("order_date").alias("fiscal_year"),
                          D.fiscal_quarter("order_date").alias("fiscal_quarter"),
                          D.fiscal_half("order_date").alias("fiscal_half"))


@query("sf12_math", """
    SELECT order_item_id, CAST(round(CAST(subtotal AS DECIMAL(18,2)), 1) AS DOUBLE) AS r, CAST(floor(subtotal) AS BIGINT) AS f,
           CAST(ceil(subtotal) AS BIGINT) AS c, abs(quantity - 25) AS a, least(quantity, 10) AS lo,
           greatest(quantity, 40) AS hi, item_id % 3 AS m FROM {line_facts}""")
def sf12(t):
    return t.line_facts.select(
        "order_item_id", F.round(F.col("subtotal").cast("decimal(18,2)"), 1).cast("double").alias("r"),
        F.floor("subtotal").alias("f"), F.ceil("subtotal").alias("c"), F.abs(F.col("quantity") - 25).alias("a"),
        F.least("quantity", F.lit(10.0)).alias("lo"), F.greatest("quantity", F.lit(40.0)).alias("hi"),
        F.pmod("item_id", F.lit(3)).cast("bigint").alias("m"))


@query("sf13_safe_division", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / nullif(l_discount, 0) AS per_discount,
           coalesce(l_quantity / nullif(l_tax, 0), 0) AS per_tax FROM lineitem""")
def sf13(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             C.safe_div("l_extendedprice", "l_discount").alias("per_discount"),
                             C.safe_div("l_quantity", "l_tax", 0.0).alias("per_tax"))


@query("sf14_arrays", """
    SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS first,
           CAST(embedding[len(embedding)] AS DOUBLE) AS last, CAST(NULL AS DOUBLE) AS beyond FROM embeddings""")
def sf14(t):
    return t.embeddings.select("vec_id", F.size("embedding").alias("n"), F.get("embedding", F.lit(0)).cast("double").alias("first"),
                               F.element_at("embedding", -1).cast("double").alias("last"),
                               F.get("embedding", F.size("embedding")).cast("double").alias("beyond"))


@query("sf14_explode_sequence", """
    SELECT p_partkey, unnest(generate_series(1, p_size))::INTEGER AS step FROM part""")
def sf14_sequence(t):
    return t.part.select("p_partkey", F.explode(F.sequence(F.lit(1), F.col("p_size"))).alias("step"))


@query("sf15_structs", """
    SELECT order_id, item_id, quantity, subtotal FROM {line_facts}""")
def sf15(t):
    packed = t.line_facts.select(F.struct("order_id", F.struct("item_id", "quantity", "subtotal").alias("item")).alias("s"))
    return packed.select("s.order_id", "s.item.*")


@query("sf16_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id AS user_back,
           event_type AS type_back FROM events""")
def sf16(t):
    text = F.to_json(F.struct("user_id", "event_type", "value"))
    back = F.from_json(text, "user_id bigint, event_type string, value double")
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), back.alias("b")).select(
        "event_id", "k", F.col("b.user_id").alias("user_back"), F.col("b.event_type").alias("type_back"))


@query("sf17_digests", """
    SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS id_sha256, base64(encode(c_name)) AS name_b64,
           c_name AS name_back FROM customer""")
def sf17(t):
    key = F.lit("0123456789abcdef").cast("binary")
    secret = F.aes_encrypt(F.col("c_name").cast("binary"), key)
    return t.customer.select("c_custkey", F.sha2(F.col("c_custkey").cast("string"), 256).alias("id_sha256"),
                             C.base64_text(F.col("c_name").cast("binary")).alias("name_b64"),
                             F.aes_decrypt(secret, key).cast("string").alias("name_back"))


@query("sf18_casts", """
    SELECT event_id, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS amount, CAST(user_id AS VARCHAR) AS user_text,
           CAST(event_id % 100 AS TINYINT) AS tiny, value > 10 AS big, CAST(NULL AS DOUBLE) AS nothing,
           TRY_CAST(event_type AS BIGINT) AS bad FROM events""")
def sf18(t):
    return t.events.select(
        "event_id", F.col("value").cast("decimal(10,2)").cast("double").alias("amount"), F.col("user_id").cast("string").alias("user_text"),
        (F.col("event_id") % 100).cast("tinyint").alias("tiny"), (F.col("value") > 10).alias("big"),
        F.lit(None).cast("double").alias("nothing"), F.col("event_type").try_cast("bigint").alias("bad"))


@query("sf19_binning", """
    SELECT order_id, CASE WHEN total_amount < 50000 THEN 'low' WHEN total_amount < 150000 THEN 'mid' ELSE 'high' END AS band
    FROM {sales}""")
def sf19(t):
    return t.sales.select("order_id", C.bucketize("total_amount", [50000, 150000], ["low", "mid", "high"]).alias("band"))


@query("sf20_masking", """
    SELECT c_custkey, '***@example.com' AS email, c_name AS name_open, sha256(c_name) AS name_hashed FROM customer""")
def sf20(t):
    email = F.concat(F.lower("c_name"), F.lit("@shop.example"))
    return t.customer.select("c_custkey", C.mask_email(email, privileged=False).alias("email"),
                             C.mask_hash("c_name", privileged=True).alias("name_open"),
                             C.mask_hash("c_name", privileged=False).alias("name_hashed"))


@query("sf20_encrypted_names", "SELECT c_custkey, c_name AS name_back, TRUE AS hidden FROM customer")
def sf20_aes(t):
    key = "0123456789abcdef"
    hidden = t.customer.select("c_custkey", "c_name", C.mask_encrypt("c_name", key, protect=True).alias("b64"))
    back = F.aes_decrypt(F.unbase64("b64"), F.lit(key)).cast("string")
    return hidden.select("c_custkey", back.alias("name_back"), (F.col("b64") != F.col("c_name")).alias("hidden"))
