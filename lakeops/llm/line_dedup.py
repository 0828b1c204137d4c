"""Line deduplication that can be undone: cuckoo filters over exact reference counts.

A line's key is its text without white space at the ends, in lower case (A-Z),
as 128 bits of hash. Three tables make the index, all in the shared folder:

* ``refs``: the exact count of lines per key and the smallest document that has it;
* ``filters``: one cuckoo filter per shard of keys, which a key enters with its
  first line and leaves with its last one;
* ``postings``: the keys of each document with their places, one row per document.

An insertion asks the filters first. Keys that they do not know are new and are
written without a look at ``refs``; only the others are joined with it, so a small
batch does not pay for the size of the index. A deletion takes a document's keys
from its posting, lowers the counts, removes keys without lines from the filters,
and names a new first document where the old one went; the lines that document
had lost come back. After any sequence of insertions and deletions the result is
that of an index built from the remaining documents.

Operations are folders. The newest row per key, or filter per shard, counts, and
an operation counts once its entry in the log is written, so one that fails leaves nothing.

The filters are dealt by shard, keys by their hash; lines are summed per key before
they are dealt, so a line that a third of all documents share is one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, map_rows, row_mark
from lakeops.operators.null_safe import null_safe_join
from lakeops.session import work_dir

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARDS = 64  # fixed when an index is made; some 10 million keys a shard make a filter of 32 MB
SLOTS = 4
FULLEST = 0.8  # of the slots, before a filter is built anew at twice the size
LEAST_BUCKETS = 64
_KICKS = 200


class Cuckoo:
    """Cuckoo filter with 16-bit fingerprints; every operation takes many keys at once.

    Each key is added and removed once. Fingerprints without a place after
    many moves go to a stash, so an added key is always found.
    """

    def __init__(self, buckets: int, table: bytes | None = None, stash: bytes = b""):
        self.mask = np.uint64(buckets - 1)
        self.table = (np.zeros((buckets, SLOTS), np.uint16) if table is None
                      else np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy())
        self.stash = [tuple(x) for x in np.frombuffer(stash, np.int64).reshape(-1, 2).tolist()]  # fingerprint, bucket

    def dump(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.array(self.stash, np.int64).tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        prints = (x >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1  # zero is an empty slot
        return prints, ((x >> np.uint64(8)) & self.mask).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        moved = (prints.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
        return at ^ (moved & self.mask).astype(np.int64)

    def _in_stash(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not self.stash:
            return np.zeros(len(prints), dtype=bool)
        held = set(self.stash)
        other = self._other(prints, at)
        return np.array([(p, a) in held or (p, b) in held
                         for p, a, b in zip(prints.tolist(), at.tolist(), other.tolist())], dtype=bool)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, at = self._places(keys)
        found = (self.table[at] == prints[:, None]).any(axis=1)
        found |= (self.table[self._other(prints, at)] == prints[:, None]).any(axis=1)
        return found | self._in_stash(prints, at)

    def _put(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Fill free slots; which fingerprints got one."""
        order = np.argsort(at, kind="stable")
        sorted_at = at[order]
        first = np.searchsorted(sorted_at, sorted_at, side="left")
        rank = np.arange(len(at)) - first  # keys of one bucket take its free slots in turn
        free = self.table[sorted_at] == 0
        slot = free & (free.cumsum(axis=1) == (rank + 1)[:, None])
        got = slot.any(axis=1)
        self.table[sorted_at[got], slot[got].argmax(axis=1)] = prints[order[got]]
        done = np.zeros(len(at), dtype=bool)
        done[order[got]] = True
        return done

    def add(self, keys: np.ndarray) -> None:
        prints, at = self._places(keys)
        for turn in range(_KICKS):
            done = self._put(prints, at)
            prints, at = prints[~done], at[~done]
            if not len(prints):
                return
            if turn:  # both buckets were full: one key per bucket takes the place of another
                _, one = np.unique(at, return_index=True)
                slot = (turn + at[one]) % SLOTS
                out = self.table[at[one], slot].copy()
                self.table[at[one], slot] = prints[one]
                prints[one] = out
            at = self._other(prints, at)
        self.stash.extend(zip(prints.tolist(), at.tolist()))

    def remove(self, keys: np.ndarray) -> None:
        prints, at = self._places(keys)
        while len(prints):
            other = self._other(prints, at)
            here, there = self.table[at] == prints[:, None], self.table[other] == prints[:, None]
            use_here, found = here.any(axis=1), here.any(axis=1) | there.any(axis=1)
            flat = np.where(use_here, at * SLOTS + here.argmax(axis=1), other * SLOTS + there.argmax(axis=1))
            for p, a, b in zip(prints[~found].tolist(), at[~found].tolist(), other[~found].tolist()):
                self.stash.remove((p, a) if (p, a) in self.stash else (p, b))
            places, one = np.unique(flat[found], return_index=True)
            self.table.reshape(-1)[places] = 0
            # Keys with one fingerprint and one slot: the others look again.
            left = np.flatnonzero(found)
            left = np.delete(left, one)
            prints, at = prints[left], at[left]


def line_keys(text: Column, least_points: int) -> Column:
    """Array of (h1, h2, pos) for the lines that may be dropped."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def key(line: Column) -> Column:
        return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)

    def one(line: Column, pos: Column) -> Column:
        k = key(line)
        return F.struct(F.when(F.length(k) >= least_points, F.xxhash64(k)).alias("h1"),
                        F.xxhash64(F.lit(1), k).alias("h2"), pos.alias("pos"))

    return F.filter(F.transform(lines, one), lambda x: x["h1"].isNotNull())


def _in_shards(heads: DataFrame, keys: DataFrame, schema: str,
               work: Callable[[int, Cuckoo, np.ndarray, np.ndarray], pa.RecordBatch | None],
               close: Callable[[int, Cuckoo], pa.RecordBatch] | None = None) -> DataFrame:
    """Deal filters and keys by shard; a shard's filter comes first, its keys stream past."""
    none = F.lit(None)
    head = heads.select("shard", F.lit(0).alias("kind"), "buckets", "table", "stash",
                        none.cast("bigint").alias("h1"), none.cast("bigint").alias("h2"))
    key = keys.select("shard", F.lit(1).alias("kind"), none.cast("int").alias("buckets"), none.cast("binary").alias("table"),
                      none.cast("binary").alias("stash"), "h1", "h2")
    # An expression of its own: by the plain column Spark may take the deal of a join below for this one, and that
    # join may still be planned anew while it runs.
    dealt = head.unionByName(key).repartition(F.xxhash64("shard")).sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cuckoo = None, None
        for batch in batches:
            numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if s == e:
                    continue
                if kinds[s] == 0:
                    if cuckoo is not None and close:
                        yield close(shard, cuckoo)
                    shard = int(numbers[s])
                    cuckoo = Cuckoo(batch.column(2)[s].as_py(), batch.column(3)[s].as_py(), batch.column(4)[s].as_py() or b"")
                    continue
                if shard != int(numbers[s]):
                    raise ValueError(f"keys of shard {numbers[s]} came without their filter")
                out = work(shard, cuckoo, batch.column(5).slice(s, e - s).to_numpy(),
                           batch.column(6).slice(s, e - s).to_numpy())
                if out is not None:
                    yield out
        if cuckoo is not None and close:
            yield close(shard, cuckoo)

    return dealt.mapInArrow(run, schema)


_FILTERS = "shard int, buckets int, n bigint, table binary, stash binary"


class LineIndex:
    """Index of the lines of documents, for insertions and deletions.

    ``path`` is a folder that all executors share; an existing index there goes on
    with the parameters it was made with. A document is an id: rows that repeat an id are
    one document. A null id is a document of its own, after all others.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", shards: int = SHARDS, least_points: int = 10):
        self.spark, self.path, self.id_type = spark, path.rstrip("/"), id_type
        self.shards, self.least_points = shards, least_points
        self.log = self._read_log()
        self.lookups = 0  # keys of the last insertion that the exact table was asked for

    def _read_log(self) -> list[str]:
        """Committed operations, oldest first."""
        spark = self.spark
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return []
        rows = spark.read.schema("number int, name string, shards int, least_points int").parquet(f"{self.path}/log/*").collect()
        if rows:
            self.shards, self.least_points = rows[0]["shards"], rows[0]["least_points"]
        return [r["name"] for r in sorted(rows, key=lambda r: r["number"])]

    def _write(self, df: DataFrame, operation: str, table: str) -> DataFrame:
        where = f"{self.path}/{operation}/{table}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def _commit(self, operation: str) -> None:
        row = [(len(self.log), operation, self.shards, self.least_points)]
        self.spark.createDataFrame(row, "number int, name string, shards int, least_points int").coalesce(1).write.parquet(
            f"{self.path}/log/{len(self.log):06d}")  # an error if another writer was faster
        self.log.append(operation)

    def _table(self, table: str, schema: str) -> DataFrame:
        """All rows of a table, with the number of their operation as ``version``."""
        out = self.spark.createDataFrame([], f"{schema}, version int")
        for number, operation in enumerate(self.log):
            if operation.startswith("delete") and table == "postings" or operation.startswith("insert") and table == "gone":
                continue
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{operation}/{table}")
            out = out.unionByName(rows.withColumn("version", F.lit(number)))
        return out

    def refs(self) -> DataFrame:
        """Exact count of lines and first document per key that has lines: ``h1``, ``h2``, ``refs``, ``first``."""
        rows = self._table("refs", f"h1 bigint, h2 bigint, refs bigint, first {self.id_type}")
        if len(self.log) > 1:
            newest = F.max_by(F.struct("refs", "first"), "version")
            rows = rows.groupBy("h1", "h2").agg(newest.alias("_")).select("h1", "h2", "_.refs", "_.first")
        return rows.filter("refs > 0").select("h1", "h2", "refs", "first")

    def filters(self) -> DataFrame:
        rows = self._table("filters", _FILTERS)
        if len(self.log) > 1:
            newest = rows.groupBy("shard").agg(F.max("version").alias("version"))
            rows = rows.join(newest, ["shard", "version"])
        return rows.drop("version")

    def postings(self) -> DataFrame:
        """Keys of the documents that are in the index: ``id``, ``mark`` (of the text), ``lines``."""
        lines = "array<struct<h1:bigint,h2:bigint,pos:int>>"
        rows = self._table("postings", f"id {self.id_type}, mark bigint, lines {lines}")
        if any(name.startswith("delete") for name in self.log):
            gone = self._table("gone", f"id {self.id_type}").select(F.col("id").alias("_gone"), F.col("version").alias("_until"))
            rows = rows.join(gone, rows["id"].eqNullSafe(gone["_gone"]) & (rows["version"] < gone["_until"]), "left_anti")
        return rows.drop("version")

    def _shard(self) -> Column:
        return F.pmod(F.col("h1"), F.lit(self.shards)).cast("int").alias("shard")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Add the lines of all rows. Rows of an id that is already there add to that document."""
        name = f"insert-{len(self.log):06d}"
        postings = self._write(docs.select(
            F.col(id_col).cast(self.id_type).alias("id"), row_mark(text_col).alias("mark"),
            line_keys(F.col(text_col), self.least_points).alias("lines")), name, "postings")
        lines = postings.select("id", F.explode("lines").alias("_")).select("id", "_.h1", "_.h2")
        keys = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("refs"), F.min("id").alias("first"))
        self.lookups = 0
        if not self.log:  # nothing to ask
            refs = self._write(keys.select("h1", "h2", "refs", "first"), name, "refs")
            self._fill(refs, name)
            self._commit(name)
            return
        keys = self._write(keys.withColumn("shard", self._shard()), name, "keys")
        known = self._probe(keys, name)
        self.lookups = known.count()
        old = known.join(self.refs().withColumnsRenamed({"refs": "_refs", "first": "_first"}), ["h1", "h2"])
        old = self._write(old.select("h1", "h2", "_refs", "_first"), name, "old")
        # Each key with what the exact table has of it: nothing for a new one.
        merged = keys.join(old, ["h1", "h2"], "left")
        refs = self._write(merged.select(
            "h1", "h2", (F.col("refs") + F.coalesce("_refs", F.lit(0))).alias("refs"),
            F.least("first", "_first").alias("first")), name, "refs")
        self._fill(refs.join(old, ["h1", "h2"], "left_anti"), name)
        self._commit(name)

    def _probe(self, keys: DataFrame, name: str) -> DataFrame:
        """Keys that the filters may know."""
        schema = "h1 bigint, h2 bigint"
        arrow = arrow_schema(schema)

        def work(shard: int, cuckoo: Cuckoo | None, h1: np.ndarray, h2: np.ndarray) -> pa.RecordBatch | None:
            found = cuckoo.contains(h1)
            return pa.RecordBatch.from_arrays([pa.array(h1[found]), pa.array(h2[found])], schema=arrow)

        own = keys.select("shard").distinct()
        filters = self.filters()
        asked = keys.join(filters.select("shard"), "shard", "left_semi")  # a shard without a filter knows nothing
        return self._write(_in_shards(filters.join(own, "shard", "left_semi"), asked, schema, work), name, "known")

    def _fill(self, new: DataFrame, name: str) -> None:
        """Add keys to the filters of their shards, built anew where they get too full."""
        new = new.select("h1", "h2").withColumn("shard", self._shard())
        filters = self.filters()
        sizes = new.groupBy("shard").agg(F.count(F.lit(1)).alias("_new"))
        need = F.col("_new") + F.coalesce("n", F.lit(0))
        wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(need / (SLOTS * FULLEST), F.lit(float(LEAST_BUCKETS))))))
        plan = sizes.join(filters, "shard", "left").select(
            "shard", need.alias("n"), F.greatest(wanted.cast("int"), "buckets").alias("buckets"),
            (F.col("buckets") < wanted).alias("again"), "table", "stash")
        plan = self._write(plan, name, "plan")
        again = F.coalesce("again", F.lit(False))
        heads = plan.select("shard", "buckets", *[F.when(~again, F.col(c)).alias(c) for c in ("table", "stash")])
        keys = new.select("shard", "h1", "h2")
        if self.log:
            grown = plan.filter(again).select("shard")
            keys = keys.unionByName(self.refs().withColumn("shard", self._shard()).join(grown, "shard", "left_semi").select(
                "shard", "h1", "h2"))
        self._write(_in_shards(heads, keys, _FILTERS, *_changes(Cuckoo.add)).drop("n").join(
            plan.select("shard", "n"), "shard").select("shard", "buckets", "n", "table", "stash"), name, "filters")

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out, by their ids; ids that are not there change nothing."""
        name = f"delete-{len(self.log):06d}"
        gone = self._write(ids.select(F.col(id_col).cast(self.id_type).alias("id")).distinct(), name, "gone")
        postings = self.postings()
        own = postings["id"].eqNullSafe(gone["id"])
        lost = postings.join(gone, own, "left_semi").select(F.explode("lines").alias("_")).select("_.h1", "_.h2")
        lost = self._write(lost.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_lost")), name, "lost")
        now = self.refs().join(lost, ["h1", "h2"])
        now = self._write(now.withColumn("refs", F.col("refs") - F.col("_lost")).select("h1", "h2", "refs", "first"), name, "now")
        # Keys whose first document goes get the smallest one of those that stay.
        headless = self._write(now.filter("refs > 0").join(gone, now["first"].eqNullSafe(gone["id"]), "left_semi").select(
            "h1", "h2"), name, "headless")
        stay = postings.join(gone, own, "left_anti").select("id", F.explode("lines").alias("_")).select("id", "_.h1", "_.h2")
        first = stay.join(headless, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(
            F.min("id").alias("_first"), F.lit(True).alias("_new"))
        refs = now.join(first, ["h1", "h2"], "left")
        self._write(refs.select("h1", "h2", "refs", F.when(F.col("_new"), F.col("_first")).otherwise(F.col("first")).alias("first")),
                    name, "refs")
        # The last line of a key went: so does the key.
        dead = now.filter("refs = 0").withColumn("shard", self._shard())
        filters = self.filters()
        sizes = dead.groupBy("shard").agg(F.count(F.lit(1)).alias("_dead"))
        heads = filters.join(sizes, "shard")
        changed = _in_shards(heads.drop("n", "_dead"), dead, _FILTERS, *_changes(Cuckoo.remove))
        self._write(changed.drop("n").join(heads.select("shard", (F.col("n") - F.col("_dead")).alias("n")), "shard").select(
            "shard", "buckets", "n", "table", "stash"), name, "filters")
        self._commit(name)

    def dropped(self) -> DataFrame:
        """Places of the lines that each document loses: ``id``, ``mark``, ``places``."""
        shared = self.refs().filter("refs > 1").select("h1", "h2", "first")
        lines = self.postings().select("id", "mark", F.explode("lines").alias("_")).select("id", "mark", "_.*")
        twice = lines.join(shared, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("first")))
        return twice.groupBy("id", "mark").agg(F.collect_set("pos").alias("places"))

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
        """What stays of every row of ``docs``, whose documents must be in the index.

        Returns the id, ``n_lines``, ``n_dropped`` and ``kept_sha256``, and
        ``kept_text`` if asked for. A line whose key has enough code points
        stays only in the smallest document that holds it, there as often as it
        occurs. A null or empty text is one empty line. Rows that repeat an id are one document:
        they have the same lines dropped. Other columns are not read.
        """
        kind = docs.schema[id_col].dataType.simpleString()
        rows = docs.select(F.col(id_col).cast(self.id_type).alias("id"), row_mark(text_col).alias("mark"),
                           F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
        drops = self._write(self.dropped(), f"dropped-{len(self.log):06d}", "places")
        joined = null_safe_join(rows, drops, ["id", "mark"]).select("own_id", "text", "places")
        names = [id_col, "n_lines", "n_dropped", "kept_sha256", *(["kept_text"] if with_text else [])]

        def one(key, text, places):
            lines = (text or "").split("\n")
            out = set(places or ())
            kept = "\n".join([x for i, x in enumerate(lines) if i not in out] if out else lines)
            row = key, len(lines), len(out), hashlib.sha256(kept.encode()).hexdigest()
            return (*row, kept) if with_text else row

        schema = f"`{id_col}` {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
        return map_rows(joined, schema, names, lambda: one)


def _changes(change: Callable[[Cuckoo, np.ndarray], None]):
    """The work on a shard's keys and the row of its filter after it."""
    arrow = arrow_schema(_FILTERS)

    def work(shard: int, cuckoo: Cuckoo, h1: np.ndarray, h2: np.ndarray) -> None:
        change(cuckoo, h1)

    def close(shard: int, cuckoo: Cuckoo) -> pa.RecordBatch:
        table, stash = cuckoo.dump()
        return pa.RecordBatch.from_pylist(
            [{"shard": shard, "buckets": len(cuckoo.table), "n": None, "table": table, "stash": stash}], schema=arrow)

    return work, close


def deduplicated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                       least_points: int = 10, with_text: bool = False, batches: int = 2) -> DataFrame:
    """Lines of a table that stay, from an index of its own, filled in ``batches`` dealt by a hash of the id.

    The result does not depend on the number of batches; all but the first ask the filters for the keys of those before.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    index = LineIndex(spark, work_dir(spark, "lines"), docs.schema[id_col].dataType.simpleString(), shards, least_points)
    for i in range(batches):
        index.insert(docs.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)) == i), id_col, text_col)
    return index.deduplicate(docs, id_col, text_col, with_text)
