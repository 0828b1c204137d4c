"""The registered queries on the smallest test data."""

import pytest

from lakeops.llm.queries import ORACLES, QUERIES
from tests.oracle import connect

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    1: "page_id url text n_chars", 2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "query_id rank vec_id score", 4: "doc_id held_out lang_pred score", 5: "doc_id n_tokens ids_sha256 decoded_sha256",
    6: "doc_id size source_size target taken", 7: "doc_id keep_id group_size kept text_sha256",
    8: "doc_id fingerprint component_id", 9: "doc_id held_out score predicted",
    10: "file row n_tokens n_segments doc_ids offsets cu_seqlens ids_sha256",
    11: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    12: "word form root n n_near form_n",
    13: "doc_id n_lines n_dropped kept_sha256",
}
TABLES = {1: "pages", 2: "pages", 3: None, 10: None, 12: None}


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_rows(spark, name):
    number = int(name[2:].split("_")[0])
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[number].split()
    table = TABLES.get(number, "documents")
    if table:
        assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    else:
        assert found.count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_check_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    want = connect(SF_DIR).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(want.fetchall())
