"""Late records, restarts, duplicate keys and untouched partitions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators.quality import expect_or_drop
from lakeops.operators.upsert import state_as_of, upsert, upsert_table
from lakeops.session import work_dir
from lakeops.sources.readers import with_rescued
from lakeops.sources.writers import write_table
from lakeops.streaming import changes, ingest

DDL = "k int, seq int, v string"


def put(spark, path, rows, ddl=DDL):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def state(spark, target):
    return {r["k"]: (r["seq"], r["v"]) for r in changes.current_state(spark, target, ["k"], "seq").collect()}


def test_late_record_loses_across_batches_and_runs(spark):
    src, target, ckpt = (work_dir(spark, n) for n in ("late", "late-t", "late-c"))

    def run():
        stream = ingest.stream_files(spark, src, "parquet", DDL, rescued=False).drop(ingest.INGEST_TIME)
        changes.apply_changes(stream, target, ckpt, ["k"], "seq")

    put(spark, src, [(1, 5, "new"), (2, 1, "a"), (2, 3, "c"), (2, 2, "b")])
    run()
    assert state(spark, target) == {1: (5, "new"), 2: (3, "c")}
    put(spark, src, [(1, 4, "late"), (2, 9, "z"), (3, 1, "first")])
    run()
    want = {1: (5, "new"), 2: (9, "z"), 3: (1, "first")}
    assert state(spark, target) == want
    run()  # nothing new
    assert state(spark, target) == want
    changes.write_changes(spark.createDataFrame([(1, 4, "older"), (3, 2, "second")], DDL), 7, target, ["k"], "seq")
    want[3] = (2, "second")
    changes.compact(spark, target, ["k"], "seq", upto=1)  # batch 7 arrived meanwhile
    assert state(spark, target) == want
    assert {r["batch"] for r in spark.read.parquet(target).select("batch").distinct().collect()} == {-1, 7}
    changes.compact(spark, target, ["k"], "seq", upto=7)
    assert state(spark, target) == want and spark.read.parquet(target).count() == 3


def test_retried_batch_changes_nothing(spark):
    target = work_dir(spark, "retry")
    batch = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], DDL)
    changes.write_changes(batch, 0, target, ["k"], "seq")
    changes.write_changes(batch, 0, target, ["k"], "seq")
    assert spark.read.parquet(target).count() == 1


def test_copy_into_loads_each_file_once(spark):
    src, out, ckpt = (work_dir(spark, n) for n in ("copy", "copy-o", "copy-c"))
    spark.createDataFrame([(1, "a")], "k int, v string").write.option("header", True).csv(src)
    assert ingest.copy_into(spark, src, out, ckpt, "k int, v string") == 1
    assert ingest.copy_into(spark, src, out, ckpt, "k int, v string") == 0
    spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string").coalesce(1).write.mode("append").option("header", True).csv(src)
    assert ingest.copy_into(spark, src, out, ckpt, "k int, v string") == 2
    assert spark.read.parquet(out).count() == 3


def test_stream_expectations_drop_and_count(spark):
    src, out, ckpt = (work_dir(spark, n) for n in ("exp", "exp-o", "exp-c"))
    put(spark, src, [(1, 1, "a"), (None, 2, "b"), (3, None, None)])
    stream = ingest.stream_files(spark, src, "parquet", DDL, rescued=False)
    query = ingest.run_once(ingest.expect_stream(stream, {"k_known": "k IS NOT NULL", "v_known": "v IS NOT NULL"}), out, ckpt)
    assert [r["k"] for r in spark.read.parquet(out).collect()] == [1]
    seen = query.recentProgress[0]["observedMetrics"]["expectations"]
    assert (seen["rows_in"], seen["k_known_failed"], seen["v_known_failed"]) == (3, 1, 1)


def test_null_injection_expectations(spark):
    good = [(datetime(2024, 1, 1), 1, 1)]
    bad = [(None, 1, 1)] * 10 + [(datetime(2024, 1, 1), None, 1)] * 10 + [(datetime(2024, 1, 1), 1, None)] * 10
    df = spark.createDataFrame(good + bad, "ds timestamp, item int, vm int")
    out = expect_or_drop(df, {"ds": "ds IS NOT NULL", "item": "item IS NOT NULL", "vm": "vm > 0"})
    assert (out.good.count(), out.bad.count()) == (1, 30)
    assert {r["rule"]: (r["passed"], r["failed"]) for r in out.metrics.collect()} == {
        "ds": (21, 10), "item": (21, 10), "vm": (21, 10)}


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_streams_rescue_undeclared_columns(spark, fmt):
    src, out, ckpt = (work_dir(spark, f"rescue-{fmt}{n}") for n in ("", "-o", "-c"))

    def put_files(rows, ddl):
        writer = spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append")
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(src)

    put_files([("1", "x")], "a string, b string")
    put_files([("extra", "2"), ("more", "bad")], "c string, a string")
    got = ingest.bronze_stream(spark, src, fmt, out, ckpt, schema="a int, b string").collect()
    assert sorted(((r["a"], r["b"], r["_rescued_data"]) for r in got), key=str) == sorted(
        [(1, "x", None), (2, None, '{"c":"extra"}'), (None, None, '{"a":"bad","c":"more"}')], key=str)
    put_files([("7", "y", "z")], "a string, b string, d string")
    assert ingest.bronze_stream(spark, src, fmt, out, ckpt, schema="a int, b string").count() == 4


def test_copy_into_widens_the_table(spark):
    src, out, ckpt = (work_dir(spark, f"widen{n}") for n in ("", "-o", "-c"))
    for rows, ddl, n in (([(1, "a")], "k int, v string", 1), ([(2, "b", "new"), (3, "c", None)], "k int, v string, w string", 2)):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").option("header", True).csv(src)
        assert ingest.copy_into(spark, src, out, ckpt, "k int, v string") == n
    got = {r["k"]: r["w"] for r in ingest.read_batches(spark, out).collect()}
    assert got == {1: None, 2: "new", 3: None}


def test_many_batches_are_all_counted(spark):
    src, out, ckpt = (work_dir(spark, f"many{n}") for n in ("", "-o", "-c"))
    spark.range(12).repartition(12).write.option("header", True).csv(src)
    assert ingest.copy_into(spark, src, out, ckpt, "id bigint", max_files=1) == 12


def test_rescued_data_of_rows(spark):
    raw = spark.createDataFrame([("1", "x", "p"), ("y", "2", None)], "a string, b string, extra string")
    got = [(r["a"], r["b"], r["_rescued_data"]) for r in with_rescued(raw, "a int, b int").orderBy("a").collect()]
    assert got == [(None, 2, '{"a":"y"}'), (1, None, '{"b":"x","extra":"p"}')]
    clean = with_rescued(spark.createDataFrame([("1",)], "a string"), "a int").first()
    assert clean["_rescued_data"] is None


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError, match="duplicate"):
        upsert(target, source, ["k"])


def test_upsert_sets_null_values(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, keep int")
    source = spark.createDataFrame([(1, None), (3, "n"), (None, "x")], "k int, v string")
    got = sorted(((r["k"], r["v"], r["keep"]) for r in upsert(target, source, ["k"]).collect()), key=str)
    assert got == sorted([(1, None, 1), (2, "b", 2), (3, "n", None), (None, "x", None)], key=str)


def test_upsert_reads_its_source_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(rows):
        runs.add(1)
        return rows
    source = spark.createDataFrame(spark.sparkContext.parallelize([(1, "b")], 1).mapPartitions(count), "k int, v string")
    assert upsert(spark.createDataFrame([(1, "a")], "k int, v string"), source, ["k"]).count() == 1
    assert runs.value == 1


def test_upsert_keeps_the_null_partition(spark):
    path = work_dir(spark, "null-part")
    write_table(spark.createDataFrame([(1, None, "old"), (2, "x", "old")], "k int, p string, v string"), path, partition_by=["p"])
    source = spark.createDataFrame([(9, None, "new")], "k int, p string, v string")
    out = upsert_table(spark, path, source, ["k", "p"], "p")
    assert sorted(map(tuple, out.select("k", "p", "v").collect()), key=str) == sorted(
        [(1, None, "old"), (2, "x", "old"), (9, None, "new")], key=str)


def test_upsert_table_touches_only_its_partitions(spark):
    path = work_dir(spark, "parts")
    write_table(spark.createDataFrame([(1, "x", "old"), (2, "x", "old"), (3, "y", "old")], "k int, p string, v string"),
                path, partition_by=["p"])
    before = {r[0] for r in spark.read.parquet(path).filter("p = 'y'").select(F.input_file_name()).collect()}
    source = spark.createDataFrame([(2, "x", "new"), (9, "z", "new")], "k int, p string, v string")
    for _ in range(2):
        out = upsert_table(spark, path, source, ["k", "p"], "p")
    assert sorted((r["k"], r["p"], r["v"]) for r in out.collect()) == [
        (1, "x", "old"), (2, "x", "new"), (3, "y", "old"), (9, "z", "new")]
    after = {r[0] for r in spark.read.parquet(path).filter("p = 'y'").select(F.input_file_name()).collect()}
    assert before == after


def test_state_as_of(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (2, 2, "b")], DDL)
    assert {r["k"]: r["v"] for r in state_as_of(log, ["k"], "seq", 2).collect()} == {1: "a", 2: "b"}


def test_streamed_sessions_do_not_depend_on_the_number_of_files(spark):
    """One file per trigger, written in any order: the same sessions as in one batch, the last ones included."""
    from lakeops.queries import streams
    from lakeops.queries.registry import Tables
    from lakeops.streaming.sessions import sessionize

    t = Tables(spark, "/root/testdata/sf0.001")
    want = sorted((r["user_id"], r["session_start"], r["n_events"]) for r in sessionize(t.events, "user_id", "ts").collect())
    got = streams._streamed_sessions(t, max_files=1).collect()
    assert sorted((r["user_id"], r["session_start"], r["n_events"]) for r in got) == want


def _bursts(spark, hours):
    """A file per (hour, user), in this order, with two events each."""
    src = work_dir(spark, "sessions-src")
    for i, (hour, u) in enumerate(hours):
        at = datetime.fromtimestamp(hour * 3600)
        put(spark, f"{src}/day={i}", [(u, at), (u, at)], "u int, ts timestamp")
    return src


def _session_run(spark, src, watermark, max_files=1, **parameters):
    from lakeops.streaming.sessions import sessionize_run

    stream = ingest.stream_files(spark, src, "parquet", "u int, ts timestamp", rescued=False, max_files=max_files)
    return sessionize_run(stream, work_dir(spark, "sessions-out"), work_dir(spark, "sessions-ckpt"), "u", "ts",
                          watermark=watermark, last=datetime.fromtimestamp(100 * 3600), **parameters)


def test_events_behind_the_watermark_are_an_error(spark):
    src = _bursts(spark, [(40, 1), (41, 2), (2, 1), (60, 2), (61, 2)])
    with pytest.raises(ValueError, match="came more than 1 hour late"):
        _session_run(spark, src, "1 hour")
    assert sorted((r["u"], r["n_events"]) for r in _session_run(spark, src, "2 days").collect()) == [(1, 2), (1, 2), (2, 2), (2, 2), (2, 2)]


@pytest.mark.parametrize("max_files", [1, 2, 100])
def test_sessions_from_state_do_not_depend_on_triggers(spark, max_files):
    """Files out of order, a burst that joins two sessions, a pause of exactly the gap."""
    src = _bursts(spark, [(50, 1), (10, 1), (9, 1), (48, 1), (49, 1), (10, None), (30, 2)])
    for strict, want in ((False, [(1, 2), (1, 2), (1, 2), (1, 2), (1, 2)]), (True, [(1, 4), (1, 6)])):
        got = _session_run(spark, src, "10 days", max_files, gap_seconds=3600, strict=strict).collect()
        assert sorted((r["u"], r["n_events"]) for r in got if r["u"] is not None) == [*want, (2, 2)]
        assert [r["n_events"] for r in got if r["u"] is None] == [2]


def test_state_is_freed(spark):
    from lakeops.streaming import stateful

    src = _bursts(spark, [(h, u) for h in range(10, 40, 3) for u in (1, 2, 3)])
    stream = ingest.stream_files(spark, src, "parquet", "u int, ts timestamp", rescued=False, max_files=3)
    # Sessions: only those near the watermark are held.
    closed = stateful.session_state(stream, "u", "ts", 1800, watermark="1 hour")
    out = work_dir(spark, "freed-out")
    query, late = stateful.run_stateful(closed, out, work_dir(spark, "freed-ckpt"))
    assert late == 0 and query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 12
    assert spark.read.parquet(out).count() == 27  # the last burst waits
    # Newest rows: all keys are behind the watermark once a later time has come.
    more = _bursts(spark, [(10, 1), (11, 2), (12, 3), (900, 4)])
    stream = ingest.stream_files(spark, more, "parquet", "u int, ts timestamp", rescued=False, max_files=1).select("u", "ts")
    newer = stateful.newest_rows(stream, ["u"], "ts", "1 hour")
    query, late = stateful.run_stateful(newer, work_dir(spark, "newest-out"), work_dir(spark, "newest-ckpt"))
    assert late == 0 and query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_open_sessions_of_a_user_wait_for_one_timer(spark):
    from lakeops.streaming import stateful

    src = _bursts(spark, [(h, 1) for h in range(10, 70, 3)])
    stream = ingest.stream_files(spark, src, "parquet", "u int, ts timestamp", rescued=False, max_files=100)
    held = stateful.session_state(stream, "u", "ts", 1800, watermark="10 days")
    query, _ = stateful.run_stateful(held, work_dir(spark, "waiting-out"), work_dir(spark, "waiting-ckpt"))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # not one or more for each of 20 sessions


@pytest.mark.parametrize("max_files", [1, 100])
def test_older_rows_lose_in_any_order(spark, max_files):
    from lakeops.streaming import stateful

    src = work_dir(spark, "newest-src")
    ddl = "k int, ts timestamp, v string, x double"
    rows = [(1, 5, "new"), (1, 4, "old"), (2, 1, "a"), (2, 3, "b"), (2, 3, "c"), (None, 2, "n"), (3, 1, None), (1, 1, "older")]
    for i, (k, hour, v) in enumerate(rows):
        put(spark, f"{src}/f={i}", [(k, datetime(2024, 1, 1, hour, 0, 0, 123456), v, 0.1)], ddl)
    stream = ingest.stream_files(spark, src, "parquet", ddl, rescued=False, max_files=max_files).select("k", "ts", "v", "x")
    out = work_dir(spark, "newest-out")
    _, late = stateful.run_stateful(stateful.newest_rows(stream, ["k"], "ts", "2 days"), out, work_dir(spark, "newest-ckpt"))
    got = spark.read.parquet(out).collect()
    newest = {}
    for r in sorted(got, key=lambda r: (r["ts"], r["v"] or "")):
        newest[r["k"]] = (r["ts"].hour, r["ts"].microsecond, r["v"], r["x"])
    assert late == 0 and newest == {1: (5, 123456, "new", 0.1), 2: (3, 123456, "c", 0.1), None: (2, 123456, "n", 0.1), 3: (1, 123456, None, 0.1)}
    assert not any(r["v"] in ("old", "older") for r in got) and len(got) <= 6
