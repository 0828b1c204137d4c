"""Batch writers. Everything is written by the executors."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.session import work_dir

PIECE_BYTES = 64 << 20  # of a file, copied by one task


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, dynamic: bool = False) -> DataFrame:
    """Write Parquet and return the table read back.

    ``dynamic`` replaces only the partitions present in ``df``.
    """
    if partition_by:
        # Rebalancing brings the rows of a partition value together, so that
        # files stay large, and splits a value too big for one task.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_known_size(dim: DataFrame) -> DataFrame:
    """A derived dimension, written to scratch and read back.

    Behind joins and filters Spark can only guess the size of a table, and
    guesses high; a small dimension would then have the fact shuffled by a key
    that may be hot. Of a written table the size is known when the join is planned.
    """
    return write_table(dim, work_dir(dim.sparkSession, "dimension"))


def append_table(df: DataFrame, path: str, merge_schema: bool = True) -> DataFrame:
    """Append; a frame with new columns widens the table."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", merge_schema).parquet(path)


def export_csv(df: DataFrame, folder: str, name: str, stamp: str | None = None) -> str:
    """CSV export named ``<stamp>_<name>``, one part file per partition."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = f"{folder}/{stamp}_{name}"
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
    return path


def write_one_csv(df: DataFrame, folder: str, piece_bytes: int = PIECE_BYTES, **options) -> str:
    """One CSV file with a header, in a new ``folder``; returns its path.

    Rows are written to part files by as many tasks as there are partitions. Then the
    lengths of the parts give each its place in the file, and tasks copy them there in pieces. A piece that is copied
    again writes the same bytes in the same place. Other file systems than ``file:`` (a local disk or a mounted
    share) do not write in the middle of a file, so there one task writes it.
    """
    spark, options = df.sparkSession, {"quote": '"', "escape": '"', **options}
    if _file_system(spark, folder).getUri().getScheme() != "file":
        df.coalesce(1).write.options(**options, header=True).csv(folder)
        return folder
    parts, target = f"{folder}/parts", f"{folder}/all.csv"
    spark.createDataFrame([], df.schema).coalesce(1).write.options(**options, header=True).csv(f"{parts}/0")
    df.write.options(**options, header=False).csv(f"{parts}/1")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(parts).select("path", "length")
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # a row per part file
    placed = files.withColumn("place", F.coalesce(F.sum("length").over(before), F.lit(0))).filter("length > 0")
    pieces = placed.select("path", "length", "place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(piece_bytes).cast("bigint"))).alias("start"))
    pieces = write_table(pieces.select("path", "start", F.least(F.lit(piece_bytes), F.col("length") - F.col("start")).alias("n"),
                                       (F.col("place") + F.col("start")).alias("place")), f"{folder}/pieces")
    n_pieces, n_bytes = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    copied = pieces.repartition(max(1, n_pieces)).mapInArrow(_copy_pieces(_local(target)), "n bigint").agg(F.sum("n")).first()[0] or 0
    if copied != n_bytes:
        raise RuntimeError(f"{copied} of {n_bytes} bytes were copied to {target}")
    _file_system(spark, parts).delete(spark._jvm.org.apache.hadoop.fs.Path(parts), True)
    return target


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _local(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/")


def _copy_pieces(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for piece in batch.to_pylist():
                out = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    with open(_local(piece["path"]), "rb") as part:
                        part.seek(piece["start"])
                        left, place = piece["n"], piece["place"]
                        while left:
                            data = part.read(min(left, 1 << 20))
                            if not data:
                                raise EOFError(f"{piece['path']} ends early")
                            place += _write_all(out, data, place)
                            left -= len(data)
                finally:
                    os.close(out)
                done.append(piece["n"])
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["n"])

    return run


def _write_all(out: int, data: bytes, place: int) -> int:
    done = 0
    while done < len(data):
        done += os.pwrite(out, data[done:], place + done)
    return done


def clone_table(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Full copy of a table."""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def convert(spark: SparkSession, src: str, fmt_in: str, dst: str, fmt_out: str,
            read_options: dict | None = None, write_options: dict | None = None) -> str:
    """Rewrite files of one format as another."""
    df = spark.read.format(fmt_in).options(**(read_options or {})).load(src)
    df.write.mode("overwrite").format(fmt_out).options(**(write_options or {})).save(dst)
    return dst
