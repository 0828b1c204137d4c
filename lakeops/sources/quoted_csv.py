"""CSV with line breaks inside quotes, read by many tasks per file.

A line break ends a record only if the quotes before it are even in number. The
file is read as lines, in blocks, by as many tasks as it has blocks. A first pass
takes the parity of the quotes of each block; the parities summed up from the start
of the file tell every block whether it begins inside a quoted field. A second pass
then joins the lines of each block to records. What a block has of a
record that begins or ends in another one is passed on as a fragment, and the fragments of
a record, one or two per block, are put together. Spark's own CSV parser reads
the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import work_dir

WHOLE, HEAD, MIDDLE, TAIL = range(4)
_INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their file, block and order. The order holds within a block, which one task reads."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")


def block_states(lines: DataFrame, quote: str = '"') -> DataFrame:
    """Whether each block begins inside a quoted field: ``path``, ``start``, ``inside``. One row per block."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    blocks = lines.groupBy("path", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("path", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


def _join_lines(quote: str):
    """The lines of each block, in order, to records and fragments."""
    mark = quote.encode()
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, held, odd, begun, n_records = None, [], 0, False, 0

        def ended() -> None:
            if held:
                out.append((*key, MIDDLE if begun else TAIL, key[1] == 0 and n_records == 0, b"\n".join(held).decode("utf-8", "replace")))

        for batch in batches:
            paths, starts, insides, values = (batch.column(c) for c in ("path", "start", "inside", "value"))
            values = values.cast(pa.binary())
            for p, s, inside, line in zip(paths.to_pylist(), starts.to_pylist(), insides.to_pylist(), values.to_pylist()):
                if (p, s) != key:
                    ended()
                    # ``begun``: the record that is held began in an earlier block.
                    key, held, odd, begun, n_records = (p, s), [], inside, inside == 1, 0
                held.append(line)
                odd ^= line.count(mark) & 1
                if not odd:
                    out.append((p, s, HEAD if begun else WHOLE, s == 0 and n_records == 0, b"\n".join(held).decode("utf-8", "replace")))
                    held, begun = [], False
                    n_records += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()
        ended()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run, "path string, start bigint, kind int, first boolean, text string"


def records(spark: SparkSession, path: str | Sequence[str], quote: str = '"') -> DataFrame:
    """The records of CSV files as text: ``first`` (of its file) and ``text``; blank ones are left out."""
    if len(quote.encode()) != 1:
        raise ValueError("a quote is one character")
    lines = _lines(spark, path)
    states_path = work_dir(spark, "csv-blocks")
    block_states(lines, quote).write.parquet(states_path)
    states = spark.read.parquet(states_path)  # its size is known: a row per block
    run, schema = _join_lines(quote)
    # However Spark joins, a block stays in one task, and the sort brings its lines back in order.
    ordered = lines.join(states, ["path", "start"]).sortWithinPartitions("path", "start", "at")
    pieces_path = work_dir(spark, "csv-records")
    ordered.select("path", "start", "inside", "value").mapInArrow(run, schema).write.parquet(pieces_path)
    pieces = spark.read.schema(schema).parquet(pieces_path)
    whole = pieces.filter(F.col("kind") == WHOLE).select("first", "text")
    # A block has its head before its tail; a record is a tail and what follows up to the next tail.
    parts = pieces.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("path").orderBy("start", "kind")
    parts = parts.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    glued = parts.groupBy("path", "record").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts")).select(
        "first", F.array_join("parts.text", "\n").alias("text"))
    ended = F.regexp_replace("text", "\r$", "")
    return whole.unionByName(glued).select("first", ended.alias("text")).filter(F.trim("text") != "")


def _type_of(values: Column) -> Column:
    """The first type that all values fit, as text."""
    fits = F.lit("string")
    for name in reversed(_INFERRED):
        fits = F.when(F.count_if(values.isNotNull() & values.try_cast(name).isNull()) == 0, F.lit(name)).otherwise(fits)
    return F.when(F.count(values) == 0, F.lit("string")).otherwise(fits)


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
                    header: bool = True, quote: str = '"', **options) -> DataFrame:
    """CSV files whose quoted fields may hold separators, doubled quotes and line breaks.

    Quotes inside a field are doubled, and a field that has quotes is quoted. With a ``schema`` the columns
    are taken by their place; without one, names come from the first record of a file (all files must have the same) and types
    from all values. ``options`` go to Spark's CSV parser. A quote that is never closed takes the rest of its file.
    """
    found = records(spark, path, quote)
    body = found.filter(~F.col("first")) if header else found
    parse = {"quote": quote, "escape": quote, "multiLine": "true", **{k: str(v) for k, v in options.items()}}
    if schema is not None:
        ddl = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return body.select(F.from_csv("text", _ddl(ddl), parse).alias("_")).select("_.*")
    top = found.filter("first").first() if header else found.first()
    if top is None:
        return spark.createDataFrame([], T.StructType([]))
    names = list(spark.createDataFrame([(top["text"],)], "text string").select(
        F.from_csv("text", ", ".join(f"c{i} string" for i in range(top["text"].count(options.get("sep", ",")) + 1)), parse).alias("_")).first()["_"])
    while names and names[-1] is None:
        names.pop()
    if not header:
        names = [f"_c{i}" for i in range(len(names))]
    text = body.select(F.from_csv("text", _ddl(T.StructType([T.StructField(n or f"_c{i}", T.StringType()) for i, n in enumerate(names)])), parse).alias("_")).select("_.*")
    kinds = text.agg(*[_type_of(F.col(f"`{c}`")).alias(c) for c in text.columns]).first()
    return text.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) for c in text.columns])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
