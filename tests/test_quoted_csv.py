"""Quoted CSV in blocks against the standard library's reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from lakeops.sources.quoted_csv import block_states, read_quoted_csv, records, _lines
from lakeops.sources.readers import read_text_csv
from lakeops.sources.writers import write_one_csv

PIECES = ["a", "bc ", "é\U0001f600", '"', '""', "\n", "\n\n", "\r\n", ",", "x" * 30, "ends\n", '\n"', '",\n"']


def field(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 8)))


def write(path, rows, end="\n"):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())
    return str(path)


@pytest.fixture
def block_bytes(spark):
    """Sets the size of a block."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def put(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [64, 257, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_against_the_csv_module(spark, tmp_path, block_bytes, size, end):
    """Borders fall everywhere: inside fields, at doubled quotes, between the signs of a line end."""
    rng = random.Random(size)
    rows = [[str(i), field(rng) or "z", field(rng) or "z"] for i in range(250 if size > 100 else 60)]
    path = write(tmp_path / "one.csv", [["id", "a", "b"], *rows], end)
    block_bytes(size)
    got = read_quoted_csv(spark, path, "id string, a string, b string", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    got = sorted((list(r) for r in got.collect()), key=lambda r: int(r[0]))
    assert got == rows


def test_one_file_is_read_by_many_tasks(spark, tmp_path, block_bytes):
    rows = [[str(i), f"text {i}\nwith a \"quoted\" word, and more " * 20] for i in range(2000)]
    path = write(tmp_path / "large.csv", [["id", "text"], *rows])
    block_bytes(100_000)
    lines = _lines(spark, path)
    assert lines.rdd.getNumPartitions() > 10
    states = block_states(lines).collect()
    assert len(states) > 10 and {r["inside"] for r in states} == {0, 1}
    got = read_quoted_csv(spark, path)
    assert dict(got.dtypes) == {"id": "int", "text": "string"}
    one_task = read_text_csv(spark, path)
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, one_task.collect()), key=key)


def test_record_longer_than_blocks(spark, tmp_path, block_bytes):
    long = "\n".join(f'line "{i}"' for i in range(3000))
    path = write(tmp_path / "long.csv", [["id", "t"], ["1", long], ["2", "x"], ["3", long + "\n"], ["4", "y"]])
    block_bytes(500)
    got = {r["id"]: r["t"] for r in read_quoted_csv(spark, path, "id int, t string").collect()}
    assert got == {1: long, 2: "x", 3: long + "\n", 4: "y"}
    assert records(spark, path).count() == 5


def test_several_files_blank_lines_and_types(spark, tmp_path, block_bytes):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text('n,x,d,s\n1,2.5,2024-01-02,"a\nb"\n\n2,,2024-01-03,\n')
    (tmp_path / "d" / "b.csv").write_text('n,x,d,s\n30000000000,1,,"c"\n')
    (tmp_path / "d" / "c.csv").write_text("")
    block_bytes(16)
    got = read_quoted_csv(spark, str(tmp_path / "d"))
    assert dict(got.dtypes) == {"n": "bigint", "x": "double", "d": "date", "s": "string"}
    assert sorted((r["n"], r["x"], r["s"]) for r in got.collect()) == [(1, 2.5, "a\nb"), (2, None, None), (30000000000, 1.0, "c")]
    assert read_quoted_csv(spark, str(tmp_path / "d" / "c.csv")).columns == []


def test_quote_that_is_never_closed(spark, tmp_path, block_bytes):
    (tmp_path / "a.csv").write_text('id,t\n1,ok\n2,"open\nto the end\nof the file\n')
    block_bytes(8)
    got = {r["id"]: r["t"] for r in read_quoted_csv(spark, str(tmp_path / "a.csv"), "id int, t string").collect()}
    assert got[1] == "ok" and got[2].startswith('open\nto the end') or got[2].startswith('"open\nto the end')


@pytest.mark.parametrize("piece", [1, 700, 1 << 20])
def test_one_file_by_many_writers_has_the_bytes_of_one_writer(spark, tmp_path, piece):
    rng = random.Random(piece)
    rows = [(i, None if i % 7 == 0 else field(rng), "") for i in range(20 if piece == 1 else 400)]
    df = spark.createDataFrame(rows, "`id, \"no\"` int, text string, empty string").repartition(6, F.col("text"))
    df.coalesce(1).write.options(header=True, quote='"', escape='"').csv(f"file://{tmp_path}/by-one")
    want = next((tmp_path / "by-one").glob("part-*.csv")).read_bytes()
    path = write_one_csv(df, f"file://{tmp_path}/by many", piece)
    assert (tmp_path / "by many" / "all.csv").read_bytes() == want
    assert not (tmp_path / "by many" / "parts").exists()
    got = read_quoted_csv(spark, path, "id int, text string, empty string", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    assert sorted(r["id"] for r in got.collect()) == [r[0] for r in rows]


def test_one_file_without_rows(spark, tmp_path):
    path = write_one_csv(spark.createDataFrame([], "a int, b string"), f"file://{tmp_path}/none")
    assert (tmp_path / "none" / "all.csv").read_bytes() == b"a,b\n"
    assert read_quoted_csv(spark, path, "a int, b string").count() == 0

