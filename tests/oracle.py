"""Comparing a Spark result with the rows DuckDB gives for the SQL counterpart."""

import datetime
import decimal
from collections import Counter

import duckdb

from tablewright.plans.profiling import TABLES

# How Spark's type names read in DuckDB.
SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array": "[]"}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(value)
    return value


def difference(df, con, sql):
    """What is different, as text; empty when names, types and rows agree.  And the number of rows."""
    cursor = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(df.columns)
    if names != sorted(kinds):
        return f"columns {names} / {sorted(kinds)}", 0
    types = [f"{c}: {t} / {kinds[c]}" for c, t in df.dtypes if SAME.get(t.split("<")[0], "?") not in kinds[c]]
    order = [list(kinds).index(c) for c in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    if types:
        return f"types {types}", 0
    if ours != theirs:
        return (f"{sum(ours.values())} / {sum(theirs.values())} rows; only ours {list(ours - theirs)[:3]}; "
                f"only theirs {list(theirs - ours)[:3]}"), 0
    return "", sum(ours.values())
