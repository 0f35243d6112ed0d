"""Run a driver query on Spark and its oracle on DuckDB; compare row sets.

Columns are sorted by name, values normalised (dates and timestamps to ISO
text, integral floats to ints) and rows compared as a multiset, which is
what the order-insensitive check needs.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v


def rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [tuple(_norm(t[i]) for i in order) for t in tuples]


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date",
                  "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "DOUBLE": "double", "BOOLEAN": "boolean",
                  "SMALLINT": "smallint", "TINYINT": "tinyint", "FLOAT": "float"}


def duck_type(t: str) -> str:
    t = str(t).upper()
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK_TO_SPARK.get(t, t.lower())


def types_match(df, con, sql):
    """(ok, message): column types agree by name."""
    rel = con.sql(sql)
    d = {n.lower(): duck_type(t) for n, t in zip(rel.columns, rel.types)}
    s = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    bad = {n: (s[n], d.get(n)) for n in s if d.get(n) != s[n]}
    return (not bad), (f"type mismatch {bad}" if bad else "types ok")


def spark_rows(df):
    names = df.columns
    return sorted(names, key=str.lower), rows(names, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = [c for c in rel.columns]
    return sorted(names, key=str.lower), rows(names, rel.fetchall())


def compare(df, con, sql):
    """(ok, message)."""
    ok, msg = types_match(df, con, sql)
    if not ok:
        return ok, msg
    s_names, s_rows = spark_rows(df)
    d_names, d_rows = duck_rows(con, sql)
    if [n.lower() for n in s_names] != [n.lower() for n in d_names]:
        return False, f"columns differ: spark {s_names} vs oracle {d_names}"
    cs, cd = collections.Counter(s_rows), collections.Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:5]
        only_d = list((cd - cs).elements())[:5]
        return False, (f"rows differ: spark {len(s_rows)} oracle {len(d_rows)}; "
                       f"only spark {only_s}; only oracle {only_d}")
    return True, f"{len(s_rows)} rows"
