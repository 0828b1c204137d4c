"""2.1 sources. Files in the wanted format are first written from the test
tables by Spark, then read back by the operator under test."""

from pyspark.sql import functions as F

from lakeops.operators.quality import expect_or_drop
from lakeops.queries.registry import query
from lakeops.session import work_dir
from lakeops.sources import quoted_csv as Q
from lakeops.sources import readers as R
from lakeops.sources.writers import write_one_csv
from lakeops.streaming import ingest

EVENT_DDL = "event_id bigint, user_id bigint, event_type string, value double"


def _event_csv(t, name, header=True):
    path = work_dir(t.spark, name)
    t.events.select("event_id", "user_id", "event_type", "value").write.option("header", header).csv(path)
    return path


@query("src1_csv_inferred", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal FROM customer")
def src1(t):
    path = work_dir(t.spark, "src1")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return R.read_csv(t.spark, path).select(F.col("c_custkey").cast("int"), "c_name", "c_acctbal")


@query("src2_csv_quoted_text", "SELECT doc_id, text FROM documents")
def src2(t):
    path = work_dir(t.spark, "src2")
    t.documents.select("doc_id", "text").write.options(header=True, quote='"', escape='"', quoteAll=True).csv(path)
    return Q.read_quoted_csv(t.spark, path, "doc_id bigint, text string")


@query("src2_csv_one_large_file", "SELECT CAST(doc_id AS INTEGER) AS doc_id, lang, text FROM documents")
def src2_large(t):
    # One file, names and types from the file itself; any number of tasks may write and read it.
    path = write_one_csv(t.documents.select("doc_id", "lang", "text"), work_dir(t.spark, "src2-large"))
    return Q.read_quoted_csv(t.spark, path)


@query("src3_csv_with_schema", "SELECT event_id, user_id, event_type, value FROM events")
def src3(t):
    return R.read_csv_schema(t.spark, _event_csv(t, "src3", header=False), EVENT_DDL)


@query("src4_csv_file_stream", """
    SELECT event_id, user_id, event_type, value, NULL::VARCHAR AS _rescued_data, TRUE AS stamped FROM events""")
def src4(t):
    src = _event_csv(t, "src4")
    out, ckpt = work_dir(t.spark, "src4-out"), work_dir(t.spark, "src4-ckpt")
    bronze = ingest.bronze_stream(t.spark, src, "csv", out, ckpt, hints="event_id bigint, user_id bigint")
    return bronze.withColumn("stamped", F.col(ingest.INGEST_TIME).isNotNull()).drop(ingest.INGEST_TIME)


@query("src5_json_file_stream", "SELECT event_id, user_id, event_type, value FROM events")
def src5(t):
    src = work_dir(t.spark, "src5")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(src)
    out, ckpt = work_dir(t.spark, "src5-out"), work_dir(t.spark, "src5-ckpt")
    bronze = ingest.bronze_stream(t.spark, src, "json", out, ckpt, schema=EVENT_DDL)
    return bronze.select("event_id", "user_id", "event_type", "value")


@query("src6_rescued_data", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id, value,
           CASE WHEN event_type = 'error' THEN '{"user_id":"u' || user_id || '","extra":"' || event_type || '"}'
                ELSE '{"extra":"' || event_type || '"}' END AS _rescued_data FROM events""")
def src6(t):
    raw = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("value").cast("string").alias("value"), F.col("event_type").alias("extra"))
    return R.with_rescued(raw, "event_id bigint, user_id bigint, value double")


@query("src7_copy_into", "SELECT event_id, user_id, event_type, value, CAST(0 AS BIGINT) AS second_run FROM events")
def src7(t):
    src, out, ckpt = _event_csv(t, "src7"), work_dir(t.spark, "src7-out"), work_dir(t.spark, "src7-ckpt")
    ingest.copy_into(t.spark, src, out, ckpt, EVENT_DDL)
    again = ingest.copy_into(t.spark, src, out, ckpt, EVENT_DDL)
    return ingest.read_batches(t.spark, out).drop("ingestion_time").withColumn("second_run", F.lit(again).cast("bigint"))


@query("src7_copy_into_new_column", """
    SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 2 = 1 THEN 'n' || event_id END AS note,
           CAST((SELECT count(*) FROM events WHERE event_id % 2 = 1) AS BIGINT) AS second_run FROM events""")
def src7_new_column(t):
    src, out, ckpt = (work_dir(t.spark, n) for n in ("src7n", "src7n-out", "src7n-ckpt"))
    events = t.events.select("event_id", "user_id", "event_type", "value")
    events.filter("event_id % 2 = 0").write.option("header", True).csv(src)
    ingest.copy_into(t.spark, src, out, ckpt, EVENT_DDL)
    more = events.filter("event_id % 2 = 1").withColumn("note", F.concat(F.lit("n"), F.col("event_id")))
    more.write.mode("append").option("header", True).csv(src)
    second = ingest.copy_into(t.spark, src, out, ckpt, EVENT_DDL)
    return ingest.read_batches(t.spark, out).drop("ingestion_time").withColumn("second_run", F.lit(second).cast("bigint"))


_EXTRA = """SELECT event_id, value, '{"event_type":"' || event_type || '"}' AS _rescued_data FROM events"""


def _extra_stream(t, fmt):
    """A stream of files with a column that the schema does not name."""
    src, out, ckpt = (work_dir(t.spark, f"src6-{fmt}{n}") for n in ("", "-out", "-ckpt"))
    writer = t.events.select("event_id", "event_type", "value").write
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(src)
    return ingest.bronze_stream(t.spark, src, fmt, out, ckpt, schema="event_id bigint, value double").drop(ingest.INGEST_TIME)


@query("src6_rescued_csv_stream", _EXTRA)
def src6_csv(t):
    return _extra_stream(t, "csv")


@query("src6_rescued_json_stream", _EXTRA)
def src6_json(t):
    return _extra_stream(t, "json")


@query("src8_binary_as_base64", "SELECT item_id, text FROM benchmark")
def src8(t):
    # Text files go through base64 and back, so the rows must return unchanged.
    path = work_dir(t.spark, "src8")
    t.benchmark.write.json(path)
    files = R.read_binary_b64(t.spark, f"{path}/*.json")
    lines = files.select(F.explode(F.split(F.decode(F.unbase64("content_b64"), "UTF-8"), "\n")).alias("line"))
    parsed = lines.filter("line <> ''").select(F.from_json("line", "item_id bigint, text string").alias("r"))
    return parsed.select("r.item_id", "r.text")


@query("src9_sql_with_bound_frames", """
    SELECT lang, count(*) AS n, CAST(sum(quality) AS BIGINT) AS good FROM documents JOIN labels USING (doc_id) GROUP BY lang""")
def src9(t):
    return R.sql(t.spark, "SELECT lang, count(*) AS n, sum(quality) AS good FROM {d} JOIN {l} USING (doc_id) GROUP BY lang",
                 d=t.documents, l=t.labels)


@query("src10_literal_rows", """
    SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS INTEGER)
      AS rank FROM orders""")
def src10(t):
    ranks = R.rows(t.spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "o_orderpriority string, rank int")
    return t.orders.join(ranks, "o_orderpriority", "left").select("o_orderkey", "rank")


@query("src11_row_spine", """
    SELECT day_no, count(order_id) AS n
    FROM (SELECT unnest(generate_series(0, (SELECT date_diff('day', DATE '1995-01-01', max(order_date)) FROM {sales}))) AS day_no)
    LEFT JOIN {sales} ON date_diff('day', DATE '1995-01-01', order_date) = day_no GROUP BY day_no""")
def src11(t):
    sales = t.sales.select(F.datediff("order_date", F.lit("1995-01-01").cast("date")).cast("bigint").alias("day_no"), "order_id")
    days = R.spine(t.spark, sales.agg(F.max("day_no")).first()[0] + 1, "day_no")
    return days.join(sales, "day_no", "left").groupBy("day_no").agg(F.count("order_id").alias("n"))


@query("src6_rescued_rows_dropped", "SELECT event_id, user_id FROM events WHERE event_type <> 'error'")
def src6_drop(t):
    raw = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user_id"))
    typed = R.with_rescued(raw, "event_id bigint, user_id bigint")
    return expect_or_drop(typed, {"user_id_not_null": "user_id IS NOT NULL"}).good.drop("_rescued_data")
