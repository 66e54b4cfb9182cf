"""Compare a Spark query with its check query the way the driver does: rows, columns, values."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v if v is None else repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted([tuple(str(_value(r[i])) for i in order) for r in rows])


def compare(df, con, sql: str):
    """(equal, message) of a Spark DataFrame and a DuckDB query."""
    cur = con.execute(sql)
    d_names, d_rows = rows_of([c[0] for c in cur.description], cur.fetchall())
    s_names, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if s_names != d_names:
        return False, f"columns {s_names} != {d_names}"
    if len(s_rows) != len(d_rows):
        return False, f"rows {len(s_rows)} != {len(d_rows)}"
    bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    return not bad, f"{len(s_rows)} rows, {len(bad)} differ" + (f": {str(bad[0])[:600]}" if bad else "")


def spark_types(df):
    return dict(sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields))


DUCK_TO_SPARK = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "INTEGER": "int"}


def duck_types(con, sql: str):
    return dict(sorted((r[0], DUCK_TO_SPARK.get(r[1], r[1])) for r in con.execute(f"DESCRIBE {sql}").fetchall()))
