"""2.8 streaming. Events are split into files by day, streamed with the
AvailableNow trigger, and the outcome is compared with the batch answer."""

from pyspark.sql import functions as F

from lakeops.functions.columns import cents
from lakeops.operators.windows import latest_per_key
from lakeops.queries.registry import query
from lakeops.queries.sql import money
from lakeops.session import work_dir
from lakeops.streaming import changes as CH
from lakeops.streaming import ingest as IN
from lakeops.streaming import sessions as SE
from lakeops.streaming import stateful as ST

DDL = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def _event_files(t, name):
    """Events as Parquet files, about one per day; a heavy day gets several."""
    path = work_dir(t.spark, name)
    (t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
     .withColumn("day", F.to_date("ts")).hint("rebalance", F.col("day")).write.partitionBy("day").parquet(path))
    return path


def _event_stream(t, name, max_files=10):
    return IN.stream_files(t.spark, _event_files(t, name), "parquet", DDL, rescued=False, max_files=max_files)


@query("str1_bronze_stream", "SELECT event_id, user_id, event_type, value, TRUE AS stamped FROM events")
def str1(t):
    out, ckpt = work_dir(t.spark, "str1-out"), work_dir(t.spark, "str1-ckpt")
    IN.run_once(_event_stream(t, "str1"), out, ckpt)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value",
                                            F.col(IN.INGEST_TIME).isNotNull().alias("stamped"))


@query("str2_stream_expectations", "SELECT event_id, value FROM events WHERE value > 1 AND event_type <> 'error'")
def str2(t):
    out, ckpt = work_dir(t.spark, "str2-out"), work_dir(t.spark, "str2-ckpt")
    rules = {"value_positive": "value > 1", "no_error": "event_type <> 'error'"}
    IN.run_once(IN.expect_stream(_event_stream(t, "str2"), rules), out, ckpt)
    return t.spark.read.parquet(out).select("event_id", "value")


@query("str3_apply_changes", """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) = 1""")
def str3(t):
    # The sequence is not the arrival order: late records with an older sequence must lose.
    target, ckpt = work_dir(t.spark, "str3"), work_dir(t.spark, "str3-ckpt")
    stream = _event_stream(t, "str3-src").select("user_id", "event_id", "event_type", "value")
    CH.apply_changes(stream, target, ckpt, ["user_id"], "value")
    return CH.current_state(t.spark, target, ["user_id"], "value")


@query("str3_newest_by_state", """
    SELECT user_id, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def str3_state(t):
    # The state lets newer rows through only; the last of them per user is the current row.
    src, out = _event_files(t, "str3s"), work_dir(t.spark, "str3s-out")
    stream = IN.stream_files(t.spark, src, "parquet", DDL, rescued=False, max_files=10).select("user_id", "ts", "event_id", "value")
    days = t.events.agg(F.datediff(F.max("ts"), F.min("ts")) + 2).first()[0]
    ST.run_stateful(ST.newest_rows(stream, ["user_id"], "ts", f"{days} days"), out, work_dir(t.spark, "str3s-ckpt"))
    newer = t.spark.read.schema(stream.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return latest_per_key(newer, ["user_id"], ["ts"], ["event_id"]).select("user_id", "event_id", "ts", "value")


@query("str4_composite_key_changes", """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def str4(t):
    target, ckpt = work_dir(t.spark, "str4"), work_dir(t.spark, "str4-ckpt")
    stream = _event_stream(t, "str4-src").select("user_id", "event_type", "ts", "event_id", "value")
    CH.apply_changes(stream, target, ckpt, ["user_id", "event_type"], "ts")
    CH.compact(t.spark, target, ["user_id", "event_type"], "ts", upto=1)
    return CH.current_state(t.spark, target, ["user_id", "event_type"], "ts", ["ts"])


@query("str5_stream_static_join", """
    SELECT event_id, e.user_id, event_type, c_name, c_mktsegment FROM events e LEFT JOIN customer c ON e.user_id = c_custkey""")
def str5(t):
    out, ckpt = work_dir(t.spark, "str5-out"), work_dir(t.spark, "str5-ckpt")
    dim = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    IN.run_once(IN.enrich_stream(_event_stream(t, "str5").select("event_id", "user_id", "event_type"), dim, "user_id"), out, ckpt)
    return t.spark.read.parquet(out)


@query("str6_gold_refresh", f"""
    SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n, {money('value')} AS total FROM events GROUP BY ALL""")
def str6(t):
    out, ckpt = work_dir(t.spark, "str6-out"), work_dir(t.spark, "str6-ckpt")
    IN.run_once(_event_stream(t, "str6"), out, ckpt)
    silver = t.spark.read.parquet(out)
    return CH.refresh(silver.groupBy(F.to_date("ts").alias("d"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(cents("value")) / 100.0).alias("total")))


_SESSIONS = """
    SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS session_end,
           count(*) AS n_events
    FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
          FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) {op} 1800000000
                               THEN 1 ELSE 0 END AS s
                FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
    GROUP BY user_id, session_no"""


@query("str7_sessions", _SESSIONS.replace("{op}", ">="))
def str7(t):
    return SE.sessionize(t.events, "user_id", "ts")


@query("str7_sessions_strict", _SESSIONS.replace("{op}", ">"))
def str7_strict(t):
    return SE.sessionize(t.events, "user_id", "ts", strict=True)


@query("str7_event_sessions", """
    SELECT event_id, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no
    FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 1800000000
                         THEN 1 ELSE 0 END AS s
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def str7_label(t):
    return SE.label_sessions(t.events, "user_id", "ts").select("event_id", "session_no")


@query("str7_streamed_sessions", f"""
    SELECT user_id, session_start, session_end + INTERVAL 30 MINUTE AS session_end, n_events FROM ({_SESSIONS.replace("{op}", ">=")})""")
def str7_stream(t):
    return _streamed_sessions(t).withColumn("session_end", F.col("session_end") + F.expr("INTERVAL 30 MINUTE"))


@query("str7_all_streamed_sessions", f"""
    SELECT user_id, session_start, session_end + INTERVAL 30 MINUTE AS session_end, n_events FROM ({_SESSIONS.replace("{op}", ">=")})""")
def str7_all(t):
    # The same from many triggers.
    return _streamed_sessions(t, max_files=4).withColumn("session_end", F.col("session_end") + F.expr("INTERVAL 30 MINUTE"))


@query("str7_streamed_sessions_strict", f"""
    SELECT user_id, session_start, session_end, n_events FROM ({_SESSIONS.replace("{op}", ">")})""")
def str7_stream_strict(t):
    # Few files per trigger, so that state goes from trigger to trigger.
    return _streamed_sessions(t, strict=True, max_files=10)


def _streamed_sessions(t, strict=False, max_files=1000):
    """State per user. The watermark waits as long as the source lasts, so the order of its files does not matter."""
    src, out = _event_files(t, "str7-src"), work_dir(t.spark, "str7-out")
    stream = IN.stream_files(t.spark, src, "parquet", DDL, rescued=False, max_files=max_files)
    days, last = t.events.agg(F.datediff(F.max("ts"), F.min("ts")) + 2, F.max("ts")).first()
    sessions = SE.sessionize_run(stream, out, work_dir(t.spark, "str7-ckpt"), "user_id", "ts", strict=strict,
                                 watermark=f"{days} days", last=last)
    return sessions.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                           F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events")
