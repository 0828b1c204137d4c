"""2.1 sinks: write, then read back."""

from pyspark.sql import functions as F

from lakeops.queries.registry import query
from lakeops.session import work_dir
from lakeops.sources import writers as W


@query("snk1_overwrite_table", "SELECT c_custkey, c_name FROM customer")
def snk1(t):
    path = work_dir(t.spark, "snk1")
    W.write_table(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")), path)
    return W.write_table(t.customer.select("c_custkey", "c_name"), path)


@query("snk2_append_with_new_column", """
    SELECT c_custkey AS key, c_acctbal AS balance, NULL::VARCHAR AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def snk2(t):
    path = work_dir(t.spark, "snk2")
    W.append_table(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")), path)
    return W.append_table(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"),
                                            F.lit("supplier").alias("kind")), path)


@query("snk3_partitioned_table", """
    SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN -value ELSE value END AS value, CAST(ts AS DATE) AS d FROM events""")
def snk3(t):
    path = work_dir(t.spark, "snk3")
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("d"))
    W.write_table(rows, path, partition_by=["d"])
    late = rows.filter("d >= DATE '2024-01-20'").withColumn("value", -F.col("value"))
    return W.write_table(late, path, partition_by=["d"], dynamic=True)


@query("snk4_csv_export", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def snk4(t):
    path = W.export_csv(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), work_dir(t.spark, "snk4"),
                        "orders.csv")
    return t.spark.read.options(header=True).schema("o_orderkey bigint, o_totalprice double, o_orderpriority string").csv(path)


@query("snk5_table_copy", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def snk5(t):
    return W.clone_table(t.spark, f"{t.sf_dir}/supplier.parquet", work_dir(t.spark, "snk5"))


@query("snk6_convert_format", "SELECT p_partkey, p_name, p_retailprice FROM part")
def snk6(t):
    src, dst = work_dir(t.spark, "snk6-csv"), work_dir(t.spark, "snk6-json")
    t.part.select("p_partkey", "p_name", "p_retailprice").write.option("header", True).csv(src)
    W.convert(t.spark, src, "csv", dst, "json", {"header": True})
    return t.spark.read.schema("p_partkey string, p_name string, p_retailprice string").json(dst).select(
        F.col("p_partkey").cast("bigint"), "p_name", F.col("p_retailprice").cast("double"))
