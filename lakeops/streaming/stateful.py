"""State per key in streams: open sessions, and the newest row of a key.

Both processors keep one small value per key and free it by an event-time timer.
A session is closed once the watermark has passed the time up to which another
event could still extend it. The newest row of a key is forgotten once the
watermark has passed its sequence time by the retention: an older row that
arrives after that is behind the watermark, and Spark drops it.

A task first folds the events of an Arrow batch to one row per user and clock
slot, so a user with a third of all events is a few rows per batch and not one
group of raw events.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from lakeops.session import work_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
_EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the start of a query; it keeps them for itself."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def run_stateful(stream: DataFrame, out: str, checkpoint: str) -> tuple[StreamingQuery, int]:
    """Append everything available now; returns the query and the rows that came behind the watermark."""
    spark = stream.sparkSession
    with _settings(spark, **{_PROVIDER: _ROCKS, _PROGRESS: "100000"}):
        query = (stream.writeStream.format("parquet").outputMode("append").option("path", out)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return query, late


def merge_spans(spans: list[tuple[int, int, int]], gap: int, strict: bool) -> list[tuple[int, int, int]]:
    """Spans (first, last, events) with pauses that end a session between them only.

    A pause of ``gap`` ends a session; with ``strict`` only a longer one does.
    """
    out: list[tuple[int, int, int]] = []
    for lo, hi, n in sorted(spans):
        if out and (lo - out[-1][1] <= gap if strict else lo - out[-1][1] < gap):
            out[-1] = (out[-1][0], max(out[-1][1], hi), out[-1][2] + n)
        else:
            out.append((lo, hi, n))
    return out


class OpenSessions(StatefulProcessor):
    """The open sessions of a user, as spans; each is given out, and forgotten, when no event can extend it.

    A trigger adds its spans to a list and leaves those of earlier triggers unread, so its work is that of its own rows. One timer
    per user, at the earliest time at which a session may close, puts the spans together and gives out all that have closed.
    """

    def __init__(self, gap: int, strict: bool):
        self.gap, self.strict = gap, strict  # microseconds

    def init(self, handle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "lo array<bigint>, hi array<bigint>, n array<bigint>")
        self.timer = handle.getValueState("timer", "at bigint")

    def _closes(self, hi: int) -> int:
        """Milliseconds of the first watermark that closes a session with this last event."""
        return (hi + self.gap) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans = merge_spans([(r["lo"], r["hi"], r["n"]) for r in rows], self.gap, self.strict)
        self.spans.appendValue(tuple(map(list, zip(*spans))))
        earliest, held = self._closes(spans[0][1]), self.timer.get()
        if held is None or earliest < held[0]:
            if held is not None:
                self.handle.deleteTimer(held[0])
            self._wake(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = merge_spans([span for part in self.spans.get() for span in zip(*part)], self.gap, self.strict)
        stay = [s for s in held if self._closes(s[1]) > now]
        if stay:
            self.spans.put([tuple(map(list, zip(*stay)))])
            self._wake(self._closes(stay[0][1]))
        else:
            self.spans.clear()
            self.timer.clear()
        for lo, hi, n in held[:len(held) - len(stay)]:
            yield Row(user=key[0], lo=lo, hi=hi, n_events=n)

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


def _fold(gap: int):
    """Events of a batch to one row per user and clock slot; two events of a slot are less than a gap apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                yield batch
                continue
            lo = batch.column("lo").to_numpy()
            table = pa.table({"user": batch.column("user"), "ts": batch.column("ts"), "slot": pa.array(lo // gap),
                              "lo": batch.column("lo"), "n": batch.column("n")})
            folded = table.group_by(["user", "slot"]).aggregate([("ts", "max"), ("lo", "min"), ("lo", "max"), ("n", "sum")])
            yield from pa.table({"user": folded["user"], "ts": folded["ts_max"], "lo": folded["lo_min"], "hi": folded["lo_max"],
                                 "n": folded["n_sum"]}).combine_chunks().to_batches()

    return run


def session_state(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800, strict: bool = False,
                  watermark: str = "1 hour") -> DataFrame:
    """Closed sessions of a stream: user, start, end (its last event) and number of events.

    A pause of the gap ends a session; with ``strict`` only a longer one does, which a session window cannot express.
    Events without a time are in no session.
    """
    kind = events.schema[user].dataType.simpleString()
    gap = gap_seconds * 1_000_000
    rows = events.filter(F.col(ts).isNotNull()).select(
        F.col(user).alias("user"), F.col(ts).cast("timestamp").alias("ts"), F.unix_micros(F.col(ts).cast("timestamp")).alias("lo"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("hi"), F.lit(1).cast("bigint").alias("n"))
    folded = rows.mapInArrow(_fold(gap), f"user {kind}, ts timestamp, lo bigint, hi bigint, n bigint")
    closed = folded.withWatermark("ts", watermark).groupBy("user").transformWithState(
        OpenSessions(gap, strict), f"user {kind}, lo bigint, hi bigint, n_events bigint", "append", "eventtime")
    return closed.select(F.col("user").alias(user), F.timestamp_micros("lo").alias("session_start"),
                         F.timestamp_micros("hi").alias("session_end"), "n_events")


class NewestRow(StatefulProcessor):
    """The newest row of a key by sequence; rows that are not newer are dropped."""

    def __init__(self, retention: int):
        self.retention = retention  # milliseconds

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "seq bigint, rank string, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = max(rows, key=lambda r: (r["_seq"], r["_rank"]))
        held = self.newest.get() if self.newest.exists() else None
        if held is not None and (held[0], held[1]) >= (best["_seq"], best["_rank"]):
            return
        timer = best["_seq"] // 1000 + self.retention + 1
        if held is not None and held[2] != timer:
            self.handle.deleteTimer(held[2])
        if held is None or held[2] != timer:
            self.handle.registerTimer(timer)
        self.newest.update((best["_seq"], best["_rank"], timer))
        yield Row(row=best["_row"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, keys: Sequence[str], sequence_by: str, watermark: str = "1 hour",
                retention_ms: int = 0) -> DataFrame:
    """The rows of a change stream that are newer than all before them of their key.

    ``sequence_by`` is a time. Equal sequences go to the larger row as JSON text, in any
    order of arrival. Within a trigger only the newest row of a key comes out. The state of a key, a sequence
    and its text, is freed when the watermark has passed it.
    """
    row = F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false", **_EXACT_TIMES})
    rows = stream.filter(F.col(sequence_by).isNotNull()).select(
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key"), F.col(sequence_by).cast("timestamp").alias("_ts"),
        F.unix_micros(F.col(sequence_by).cast("timestamp")).alias("_seq"), row.alias("_rank"), row.alias("_row"))
    newer = rows.withWatermark("_ts", watermark).groupBy("_key").transformWithState(
        NewestRow(retention_ms), "row string", "append", "eventtime")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return newer.select(F.from_json("row", ddl, _EXACT_TIMES).alias("_")).select("_.*")


def closing_stream(spark: SparkSession, like: DataFrame, ts: str, name: str = "closing") -> tuple[DataFrame, str]:
    """A stream, empty at first, with the columns of another one, and its folder.

    Unite it with the stream to close; a row with a late time that ``close_after`` puts there lets the watermark pass everything.
    """
    folder = work_dir(spark, name)
    spark.createDataFrame([], like.schema).write.parquet(folder)
    return spark.readStream.schema(like.schema).parquet(folder), folder


def close_after(spark: SparkSession, folder: str, schema, ts: str, when) -> None:
    """Put the closing row: all null but the time."""
    row = {f.name: (when if f.name == ts else None) for f in schema.fields}
    spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema).write.mode("append").parquet(folder)
