import base64
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeops.llm.common import file_system
from lakeops.llm.warc import read_archives, read_records, round_trip, write_archives, write_record
from lakeops.session import work_dir

RECORDS = [write_record(i, f"http://x/{i}", (f"payload {i} " * (i * 7)).encode()) for i in range(12)]
DATA = b"".join(RECORDS)
STARTS = [sum(map(len, RECORDS[:i])) for i in range(13)]
PLAIN = [zlib.decompress(r, 31) for r in RECORDS]


def summary(data):
    found = list(read_records(data))
    return [f.headers["warc-row-id"] for f in found if f.reason is None], [(f.offset, f.length, f.reason) for f in found if f.reason]


def test_whole_archive():
    assert summary(DATA) == ([str(i) for i in range(12)], [])
    assert summary(b"".join(PLAIN)) == ([str(i) for i in range(12)], [])
    assert summary(gzip.compress(b"".join(PLAIN)))[0] == [str(i) for i in range(12)]
    assert summary(b"") == ([], [])


@pytest.mark.parametrize("hurt", [0, 5, 11])
def test_damaged_member(hurt):
    data = bytearray(DATA)
    data[STARTS[hurt] + len(RECORDS[hurt]) // 2] ^= 0x55
    ids, gaps = summary(bytes(data))
    assert ids == [str(i) for i in range(12) if i != hurt]
    assert gaps == [(STARTS[hurt], len(RECORDS[hurt]), gaps[0][2])]


def test_junk_and_cut_end():
    ids, gaps = summary(b"junk" + DATA[:STARTS[3]] + b"\x1f\x8b\x08 not a member " + DATA[STARTS[3]:-30])
    assert ids == [str(i) for i in range(11)]
    assert [g[0] for g in gaps] == [0, 4 + STARTS[3], 4 + STARTS[11] + 17] and gaps[-1][2] == "member cut off"


def test_record_before_a_lost_checksum():
    """Only the member's checksum is cut off: the record's own digests hold, the gap is logged."""
    ids, gaps = summary(DATA[:-3])
    assert ids == [str(i) for i in range(12)]
    assert gaps == [(STARTS[11], len(RECORDS[11]) - 3, "member cut off")]


def test_damaged_plain_records():
    lost = b"".join(PLAIN[:4]) + PLAIN[4][:-20] + b"".join(PLAIN[5:])
    ids, gaps = summary(lost)
    assert ids == [str(i) for i in range(12) if i != 4] and gaps[0][:2] == (len(b"".join(PLAIN[:4])), len(PLAIN[4]) - 20)
    wrong = PLAIN[2].replace(b"payload 2 payload", b"payload 3 payload", 1)
    ids, gaps = summary(b"".join(PLAIN[:2]) + wrong + PLAIN[3])
    assert ids == ["0", "1", "3"] and gaps[0][2] == "block digest"


def test_damaged_member_of_many_records():
    ids, gaps = summary(gzip.compress(b"".join(PLAIN))[:-30])
    assert ids[:3] == ["0", "1", "2"] and gaps


def expected(rows, least=0):
    first = {}
    for r in rows:
        if r["page_id"] is not None:
            first[r["html"] or ""] = min(first.get(r["html"] or "", r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        data = (r["html"] or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        original = first.get(r["html"] or "") if len(data) >= least else r["page_id"]
        again = original is not None and original != r["page_id"]
        out.append((r["page_id"], len(data), digest, "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


SCHEMA = "page_id bigint, url string, html string, key string, digest string, original int"
ROWS = [(5, "http://a/ b\r\n", "<p>same</p>", "k", "d", 1), (3, None, "<p>same</p>", "k", "d", 1), (3, None, "<p>same</p>", "k", "d", 1),
        (9, "http://a", "<p>same</p>", None, None, None), (1, "http://a", None, None, None, None), (2, "u", "", None, None, None),
        (None, None, "<p>same</p>", None, None, None), (None, "x", None, None, None, None), (7, "u", "é" * 300_000, "k", "d", 1),
        (8, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "k", "d", 1)]


@pytest.mark.parametrize("least", [0, 1, 1000])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = round_trip(pages, least_revisit_bytes=least)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(pages.collect(), least)
    assert round_trip(pages.limit(0)).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.unionByName(pages.selectExpr("page_id + 100000 AS page_id", "url", "html").filter("page_id % 3 = 0"))
    assert sorted((tuple(r) for r in round_trip(pages).collect()), key=str) == expected(pages.collect())


def test_files_are_salvaged(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    folder = work_dir(spark, "warc-test")
    made = write_archives(pages, folder, file_bytes=20_000).collect()
    assert len(made) > 3 and sum(r["records"] for r in made) == pages.count()
    files, base = file_system(folder)
    with files.open_input_stream(made[0]["path"], compression=None) as stream:
        data = bytearray(stream.read())
    data[len(data) // 2] ^= 0x55
    with files.open_output_stream(made[0]["path"], compression=None) as stream:
        stream.write(bytes(data))
    found = read_archives(spark, folder, with_payload=True).collect()
    assert sum(r["kind"] == "record" for r in found) == pages.count() - 1
    gap, = (r for r in found if r["kind"] == "gap")
    assert gap["reason"] and gap["length"] > 0
    html = {str(r["page_id"]): r["html"] for r in pages.collect()}
    assert all(r["payload"].decode() == html[r["row_id"]] for r in found if r["kind"] == "record")


def test_text_ids_are_one_header_value(spark):
    ids = ["a\r\nX: 1", "  lead ", "line\r\n\r\nbody", "100%", "%41", "tab\t", "é", "plain", None]
    pages = spark.createDataFrame([(i, f"<p>{n % 3}") for n, i in enumerate(ids)], "page_id string, html string").withColumn(
        "url", F.lit("http://x/"))
    folder = work_dir(spark, "warc-ids")
    write_archives(pages, folder, least_revisit_bytes=0)
    rows = read_archives(spark, folder).collect()
    assert {r["kind"] for r in rows} == {"record"}
    assert sorted(map(str, (r["row_id"] for r in rows))) == sorted(map(str, ids))
    assert {r["refers_to_row"] for r in rows if r["record_type"] == "revisit"} <= set(ids)
