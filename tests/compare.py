"""Side-by-side comparison of a query with its check SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from orderloom.sources.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


_FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
}


def difference(df, con, sql) -> str | None:
    """None when the frame and the SQL agree exactly, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    mine = {f.name: _FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    bad_types = {c: (mine[c], types[c]) for c in names if mine[c] != types[c]}
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(expected):
        return f"rows {len(got)} vs {len(expected)}"
    a, b = _sorted_rows(df.columns, got), _sorted_rows(names, expected)
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ ({sorted(names)}), first: {wrong[0]}"
    return f"types {bad_types}" if bad_types else None
