"""Incremental file ingestion. Streams run with the AvailableNow trigger: each
run loads the files that arrived since the last one and then ends."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources.readers import with_rescued

INGEST_TIME = "cdc_timestamp"
BATCH = "_ingest_batch"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def infer_schema(spark: SparkSession, path: str, fmt: str, hints: str | None = None,
                 sampling_ratio: float = 1.0, **options) -> T.StructType:
    """Schema of the files present now, with the hinted columns replaced.

    Inference reads the files; on a large folder lower ``sampling_ratio``. A
    type guessed too narrow costs nothing later on: what does not fit is rescued.
    """
    opts = {"samplingRatio": sampling_ratio, **options}
    if fmt == "csv":
        opts = {"header": True, "inferSchema": True, **opts}
    schema = spark.read.format(fmt).options(**opts).load(path).schema
    hinted = {f.name: f for f in T.StructType.fromDDL(hints).fields} if hints else {}
    return T.StructType([hinted.get(f.name, f) for f in schema.fields])


def stream_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
                 hints: str | None = None, rescued: bool = True, max_files: int = 1000,
                 **options) -> DataFrame:
    """New files as a stream, typed, with rescued data and the ingest time.

    Text formats are read as STRING and typed per column, so one bad value
    costs neither the row nor the job. A stream has one schema, so columns that
    ``schema`` does not name do not come through here; :func:`bronze_stream` and
    :func:`copy_into` keep them.
    """
    if schema is None:
        schema = infer_schema(spark, path, fmt, hints, **options)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.readStream.format(fmt).options(**options).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    if rescued and fmt in ("csv", "json"):
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        stream = with_rescued(reader.schema(as_text).load(path), schema)
    else:
        stream = reader.schema(schema).load(path)
    return stream.withColumn(INGEST_TIME, F.current_timestamp())


def read_as_text(spark: SparkSession, paths: Sequence[str], fmt: str, **options) -> DataFrame:
    """CSV or JSON files with every column they have, as text.

    CSV files are read in groups with the same header line; columns that a
    group lacks are null.
    """
    if fmt == "json":
        return spark.read.options(primitivesAsString=True, **options).json(list(paths))
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    # The header is the first line of the first block; one line per file comes back, of a bounded number of files.
    first = lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in first.collect():
        groups.setdefault(r["header"], []).append(r["path"])
    frames = [spark.read.options(header=True, **options).csv(files) for files in groups.values()]
    out = frames[0] if frames else spark.createDataFrame([], T.StructType([]))
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def _new_files(spark: SparkSession, src: str, checkpoint: str, max_files: int,
               load: Callable[[list[str], int], None]) -> None:
    """Call ``load`` with the paths of each batch of files that arrived since the last run.

    Only the names of the files go through the stream, at most ``max_files`` of
    them per batch; ``load`` must write a batch so that a second call replaces it.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").distinct().collect()]
        if paths:
            load(paths, batch_id)

    names = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", max_files).load(src).select("path")
    names.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def run_once(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a Parquet table and wait for the end."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def bronze_stream(spark: SparkSession, src: str, fmt: str, out: str, checkpoint: str,
                  schema: T.StructType | str | None = None, hints: str | None = None, max_files: int = 1000,
                  **options) -> DataFrame:
    """Files to a bronze table with rescued data; returns the table.

    CSV and JSON files are read with all the columns they have: values that do
    not fit and columns that the schema does not name are kept in
    ``_rescued_data``. Other formats are typed by themselves.
    """
    if fmt not in ("csv", "json"):
        run_once(stream_files(spark, src, fmt, schema, hints, max_files=max_files, **options), out, checkpoint)
        return spark.read.parquet(out)
    wanted = schema if schema is not None else infer_schema(spark, src, fmt, hints, **options)

    def load(paths: list[str], batch_id: int) -> None:
        typed = with_rescued(read_as_text(spark, paths, fmt, **options), wanted)
        typed.withColumn(INGEST_TIME, F.current_timestamp()).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    _new_files(spark, src, checkpoint, max_files, load)
    return read_batches(spark, out)


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """A table written batch by batch, with the columns of all batches."""
    return spark.read.option("mergeSchema", True).option("basePath", out).parquet(out).drop(BATCH)


def copy_into(spark: SparkSession, src: str, target: str, checkpoint: str, schema: T.StructType | str,
              select: Mapping[str, Column] | None = None, fmt: str = "csv", max_files: int = 1000, **options) -> int:
    """Load files not loaded before; returns the number of rows added.

    The checkpoint remembers the files, so a second run adds nothing. CSV and
    JSON files that bring a new column widen the table by it, as text. The table
    is read by :func:`read_batches`. Rows are counted in the target.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    added = []

    def load(paths: list[str], batch_id: int) -> None:
        if fmt in ("csv", "json"):
            raw = read_as_text(spark, paths, fmt, **options)
            known = [f.name for f in wanted.fields]
            rows = raw.select(
                *[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in raw.columns
                  else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields],
                *[c for c in raw.columns if c not in known])
        else:
            rows = spark.read.schema(wanted).format(fmt).options(**options).load(paths)
        if select:
            rows = rows.select(*[c.alias(n) for n, c in select.items()])
        path = f"{target}/{BATCH}={batch_id}"
        rows.withColumn("ingestion_time", F.current_timestamp()).write.mode("overwrite").parquet(path)
        added.append(spark.read.parquet(path).count())

    _new_files(spark, src, checkpoint, max_files, load)
    return sum(added)


def expect_stream(stream: DataFrame, rules: Mapping[str, str], name: str = "expectations") -> DataFrame:
    """Drop rows that break a rule; passed and failed counts come as observed
    metrics of each micro-batch (``<rule>_failed``)."""
    holds = {n: F.coalesce(F.expr(r), F.lit(False)) for n, r in rules.items()}
    observed = stream.observe(name, F.count(F.lit(1)).alias("rows_in"),
                              *[F.count_if(~t).alias(f"{n}_failed") for n, t in holds.items()])
    for test in holds.values():
        observed = observed.filter(test)
    return observed


def enrich_stream(stream: DataFrame, static: DataFrame, on: str) -> DataFrame:
    """Left-join each micro-batch with a static table."""
    return stream.join(static, on, "left")
