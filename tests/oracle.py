"""Compare a query with its check SQL: column names, types, row count, values."""

from __future__ import annotations

import math

import duckdb

from lakeops.queries import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
          "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
          "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(_norm(x) for x in v.values())
    return v


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    """Differences found, empty if the results agree."""
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    if name not in ORACLES:
        return [] if got is not None else ["no rows"]
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    data = rel.fetchall()
    problems = []
    if sorted(names) != cols:
        return [f"columns {cols} != {sorted(names)}"]
    for c, t in df.dtypes:
        want = _TYPES.get(t, t.upper().replace(" ", ""))
        have = types[c].upper().replace(" ", "")
        if want != have and not t.startswith(("array", "struct", "map")):
            problems.append(f"type of {c}: {t} against {types[c]}")
    at = [names.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in at) for r in data]
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
        return problems
    if not got:
        problems.append("both results are empty")
    got.sort(key=_key)
    want.sort(key=_key)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, x, y) for c, x, y in zip(cols, g, w) if x != y]
        problems.append(f"{len(bad)} rows differ, first: {str(cells[:3])[:400]}")
    return problems
