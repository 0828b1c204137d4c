"""Sessions with an inactivity gap."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.null_safe import null_safe_join
from lakeops.streaming.stateful import close_after, closing_stream, run_stateful, session_state


def _slot(ts: str, gap_seconds: int) -> Column:
    return F.floor(_micros(F.col(ts)) / F.lit(gap_seconds * 1_000_000))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def session_slots(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800,
                  strict: bool = False, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Events per user and clock slot of the gap's length, with a session number.

    Two events of one slot are less than a gap apart, so a slot never straddles
    two sessions. A user has a limited number of slots per day, so the window
    here never sees raw events, however hot the user is.
    """
    slots = events.groupBy(user, _slot(ts, gap_seconds).alias("_slot")).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_m_{n}") for n, c in (sums or {}).items()])
    by_time = Window.partitionBy(user).orderBy("_slot")
    pause = _micros(F.col("_lo")) - _micros(F.lag("_hi").over(by_time))
    limit = gap_seconds * 1_000_000
    starts = F.coalesce(pause > limit if strict else pause >= limit, F.lit(True)).cast("int")
    return slots.withColumn("_starts", starts).withColumn(
        "session_no", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))


def sessionize(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800,
               strict: bool = False, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per session: user, number, start, end, event count, extra sums.

    A new session starts after ``gap_seconds`` without an event; ``strict``
    demands more than the gap.
    """
    slots = session_slots(events, user, ts, gap_seconds, strict, sums)
    return slots.groupBy(user, "session_no").agg(
        F.min("_lo").alias("session_start"), F.max("_hi").alias("session_end"),
        F.sum("_n").alias("n_events"), *[F.sum(f"_m_{n}").alias(n) for n in (sums or {})])


def label_sessions(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800,
                   strict: bool = False) -> DataFrame:
    """Every event with the number of its session; events without a time come first, as one session."""
    slots = session_slots(events, user, ts, gap_seconds, strict).select(user, "_slot", "session_no")
    slotted = events.withColumn("_slot", _slot(ts, gap_seconds))
    return null_safe_join(slotted, slots, [user, "_slot"], "left").select(*events.columns, "session_no")


def sessionize_stream(events: DataFrame, user: str, ts: str, gap: str = "30 minutes",
                      watermark: str = "1 hour") -> DataFrame:
    """Streaming form: closed sessions are emitted once the watermark has passed.

    ``session_end`` is the last event's time plus the gap.
    """
    return (
        events.withWatermark(ts, watermark)
        .groupBy(user, F.session_window(ts, gap).alias("session"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(user, F.col("session.start").alias("session_start"),
                F.col("session.end").alias("session_end"), "n_events")
    )


def sessionize_run(stream: DataFrame, out: str, checkpoint: str, user: str, ts: str, gap_seconds: int = 1800,
                   strict: bool = False, watermark: str = "1 hour", last: datetime | None = None) -> DataFrame:
    """All sessions of a bounded run, from state per user; the table ``out``.

    Sessions are written when the watermark has passed them. With ``last``, a time after all events, a
    closing row then lets the watermark pass the rest, so that the run ends with no state left; without
    it open sessions wait in the checkpoint for the next run. Events that came behind the
    watermark are counted by the stream, and are an error: the delay has to be as long as the
    source is out of order. With a delay as long as the whole source, neither the order nor the number of files matters.
    """
    spark = stream.sparkSession
    events = stream.select(user, F.col(ts).cast("timestamp").alias(ts))
    closing, folder = closing_stream(spark, events, ts)
    # Of the closing row only the time matters; its session is recognised by that and left out.
    sessions = session_state(events.unionByName(closing), user, ts, gap_seconds, strict, watermark)
    _, late = run_stateful(sessions, out, checkpoint)
    if late:
        raise ValueError(f"at least {late} events came more than {watermark} late and are in no session")
    if last is not None:
        far = last + timedelta(days=36_500)
        close_after(spark, folder, events.schema, ts, far)
        run_stateful(sessions, out, checkpoint)
        return spark.read.schema(sessions.schema).parquet(out).filter(F.col("session_start") < F.lit(far))
    return spark.read.schema(sessions.schema).parquet(out)
