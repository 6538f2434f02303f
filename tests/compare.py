"""Compare a Spark result with DuckDB on the same tables, order-insensitive."""

import glob
import math
import os

import duckdb

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else v) for v in row)


def _canonical(rows, order):
    out = []
    for row in rows:
        values = [row[i] for i in order]
        out.append(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in values))
    return sorted(out, key=_key)


def check(df, con, sql):
    """Names, types and the multiset of rows must be equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    columns = sorted(names)
    got = _canonical([tuple(r) for r in df.collect()], [df.columns.index(c) for c in columns])
    want = _canonical(expected, [names.index(c) for c in columns])
    assert len(got) == len(want)
    assert len(got) > 0
    assert got == want
