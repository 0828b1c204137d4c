"""Review text operators with pluggable scorers.

A scorer is a plain function ``list[str] -> list`` that runs inside Arrow
batches on the executors; a failure costs the rows concerned a NULL, never the
job. Where a rule is enough, the expression forms below stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeops.functions.columns import missing_to_dash
from lakeops.operators.numbering import number_rows

Scorer = Callable[[list], list]
ROWS_AT_ONCE = 1024
BYTES_AT_ONCE = 4 << 20


def prompts(df: DataFrame, text: str, topics: Sequence[str], polarities: Sequence[str],
            template: str) -> DataFrame:
    """One row per text, topic and polarity, with the filled template.

    ``template`` has the placeholders ``{text}``, ``{topic}`` and ``{polarity}``.
    """
    combos = F.explode(F.array(*[
        F.struct(F.lit(p).alias("polarity"), F.lit(t).alias("topic")) for p in polarities for t in topics
    ]))
    out = df.withColumn("_c", combos).select(*df.columns, "_c.polarity", "_c.topic")
    pieces, rest = [], template
    values = {"{text}": F.col(text), "{topic}": F.col("topic"), "{polarity}": F.col("polarity")}
    while rest:
        found = [(rest.index(k), k) for k in values if k in rest]
        if not found:
            pieces.append(F.lit(rest))
            break
        at, key = min(found)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(values[key])
        rest = rest[at + len(key):]
    return out.withColumn("prompt", F.concat(*pieces))


def join_texts(*cols: str, head: str = "", tail: str = "", sep: str = "\n") -> Column:
    """Head, the given text columns (NULL as empty text) and tail, by line."""
    return F.concat_ws(sep, F.lit(head), *[F.coalesce(F.col(c), F.lit("")) for c in cols], F.lit(tail))


def _safe_call(scorer: Scorer, values: list, retries: int) -> list:
    """The batch's results. A batch that keeps failing is halved until the bad
    rows are alone, and these are NULL."""
    for _ in range(retries + 1):
        try:
            out = list(scorer(values))
            if len(out) == len(values):
                return out
        except Exception:
            continue
    if len(values) <= 1:
        return [None] * len(values)
    half = len(values) // 2
    return _safe_call(scorer, values[:half], retries) + _safe_call(scorer, values[half:], retries)


def map_text(df: DataFrame, text: str, make_scorer: Callable[[], Scorer], name: str = "result",
             result_type: T.DataType | str = "string", retries: int = 1) -> DataFrame:
    """Apply a text model to every row.

    ``make_scorer`` is called once per task (load the model there). It gets up to ``ROWS_AT_ONCE`` texts
    and ``BYTES_AT_ONCE`` of them, or one text, so a worker holds few texts as Python strings, however long they are.
    """
    kind = to_arrow_type(T.DataType.fromDDL(result_type) if isinstance(result_type, str) else result_type)

    @F.arrow_udf(result_type)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = make_scorer()
        for batch in batches:
            for part in text_parts(batch):
                found = pd.Series(_safe_call(scorer, part.to_pylist(), retries), dtype=object)
                yield pa.Array.from_pandas(found, type=kind)

    return df.withColumn(name, score(F.col(text)))


def text_parts(texts: pa.Array, rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE) -> Iterator[pa.Array]:
    """The texts in slices of at most so many rows and bytes; a longer text is a slice of its own."""
    first, held = 0, 0
    for at, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > first and (held + n > size or at - first == rows):
            yield texts.slice(first, at - first)
            first, held = at, 0
        held += n
    if len(texts) > first:
        yield texts.slice(first)


def score_rows(df: DataFrame, cols: Sequence[str], make_scorer: Callable[[], Callable[[pd.DataFrame], Sequence]],
               name: str = "prediction", result_type: T.DataType | str = "double") -> DataFrame:
    """Apply a model to a struct of columns; the result has the declared type.

    ``make_scorer`` is called once per task (load the model there) and gives a
    function from a pandas frame of the columns to one result per row.
    """
    @F.pandas_udf(result_type)
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in batches:
            yield pd.Series(scorer(batch))

    return df.withColumn(name, score(F.struct(*[F.col(c) for c in cols])))


def sentiment(df: DataFrame, text: str, make_scorer: Callable[[], Scorer]) -> DataFrame:
    """``positive_score`` = stars × probability from a scorer that yields
    ``("n stars", probability)``; a failed row scores as unknown."""
    kind = pa.struct([("emotion", pa.string()), ("probability", pa.float32())])

    @F.arrow_udf("emotion string, probability float")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = make_scorer()
        for batch in batches:
            for part in text_parts(batch):
                found = [f if f is not None else ("unknown", 0.0) for f in _safe_call(scorer, part.to_pylist(), 0)]
                yield pa.array([{"emotion": e, "probability": p} for e, p in found], kind)

    scored = df.withColumn("_s", score(F.col(text)))
    return scored.withColumn("positive_score", positive_score(F.col("_s.emotion"), F.col("_s.probability"))).drop("_s")


def positive_score(emotion: Column, probability: Column) -> Column:
    """Stars in the label times probability; NULL for a label without stars."""
    stars = F.regexp_replace(emotion, " stars?", "").try_cast("tinyint")
    return stars * probability


def classify(text: Column | str, rules: Mapping[str, str], default: str) -> Column:
    """First label whose pattern (case-insensitive) occurs in the text."""
    value = F.lower(F.col(text) if isinstance(text, str) else text)
    out = None
    for label, pattern in rules.items():
        test = value.rlike(pattern)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(default)


def summarise(text: Column | str, n: int = 30) -> Column:
    """First sentence, cut to ``n`` characters."""
    value = F.col(text) if isinstance(text, str) else text
    return F.substring(F.trim(F.regexp_extract(value, r"^[^.!?。！？\n]*", 0)), 1, n)


def clean_results(df: DataFrame, cols: Sequence[str], marker: str = " -") -> DataFrame:
    """Missing and noisy results of the given columns to '-'."""
    return df.withColumns({c: missing_to_dash(c, marker) for c in cols})


def unpivot_topics(df: DataFrame, ids: Sequence[str],
                   columns: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Topic columns to rows: ``{sentiment: {topic label: column}}``; '-' goes."""
    branches = F.array(*[
        F.struct(F.lit(topic).alias("review_category"), F.col(col).alias("review_details"),
                 F.lit(sentiment).alias("sentiment"))
        for sentiment, topics in columns.items() for topic, col in topics.items()
    ])
    # All polarities in one explode: the wide table is read once.
    kept = F.filter(branches, lambda b: b["review_details"] != "-")
    return df.select(*ids, F.explode(kept).alias("_t")).select(*ids, "_t.*")


def process_in_batches(df: DataFrame, id_col: str, size: int, fn: Callable[[DataFrame], DataFrame],
                       out: str) -> DataFrame:
    """Run ``fn`` over every row whose id is not yet in ``out``; returns the table.

    All pending batches go through one distributed job. Rows are stored with their
    ``batch_id``, in files as large as the tasks make them: a folder per batch would be as
    many small files as there are batches. A restart finds the ids that are done and leaves them alone, so
    a batch that has grown is completed. ``fn`` has to keep ``id_col`` and
    ``batch_id``, and a row without a result as a row with a NULL.
    """
    spark = df.sparkSession
    todo = df.withColumn("batch_id", F.floor(F.col(id_col) / size).cast("bigint"))
    try:
        done = spark.read.parquet(out).select(F.col(id_col).alias("_done")).distinct()
        todo = todo.join(done, todo[id_col].eqNullSafe(done["_done"]), "left_anti")
    except Exception as error:  # first run: there is no table yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
    fn(todo).write.mode("append").parquet(out)
    return spark.read.parquet(out)


def group_texts(df: DataFrame, order: Sequence[Column | str], text: str, ratings: Sequence[str],
                size: int = 3, default_rating: int = 3, id_col: str = "id") -> DataFrame:
    """Merge each run of ``size`` texts into one row, ratings filled.

    A rating is the first one present in the run, else the default.
    """
    n = number_rows(df, [], order, "_rn")
    n = n.withColumn(id_col, F.floor((F.col("_rn") - 1) / size) + 1).withColumn(
        "_slot", F.pmod(F.col("_rn") - 1, F.lit(size)))
    texts = [F.max(F.when(F.col("_slot") == i, F.col(text))).alias(f"original_{i + 1}") for i in range(size)]
    filled = [F.coalesce(F.min_by(r, F.when(F.col(r).isNotNull(), F.col("_slot"))), F.lit(default_rating)).alias(r)
              for r in ratings]
    return n.groupBy(id_col).agg(*texts, *filled)


def voc_mart(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Report mart: constant parameters in front of the exploded topics."""
    return df.select(*[F.lit(v).alias(k) for k, v in constants.items()], *df.columns)

