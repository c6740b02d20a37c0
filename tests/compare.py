"""Runs a registered query and its oracle and compares them the way the driver does: by name, value and row multiset."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

from broadsheet.fixtures import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def _multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


FAMILIES = {
    "bigint": "int", "int": "int", "integer": "int", "hugeint": "huge", "double": "float", "float": "float",
    "string": "text", "varchar": "text", "boolean": "bool", "timestamp": "ts", "timestamp_ntz": "ts",
}


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else a message; plus seconds of the Spark side."""
    t = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - t
    if sql is None:
        return (None if rows else "no rows"), seconds, len(rows)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]).lower() for d in cur.description}
    want = cur.fetchall()
    a, b = _multiset(df.columns, rows), _multiset(names, want)
    if a[0] != b[0]:
        return f"columns {a[0]} != {b[0]}", seconds, len(rows)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = {c: (kinds[c], types[c]) for c in kinds
           if FAMILIES.get(kinds[c], kinds[c]) != FAMILIES.get(types[c], types[c]) or kinds[c] in ("int",) and types[c] != "integer"}
    if a[1] != b[1]:
        only_a = [r for r in a[1] if r not in set(b[1])][:3]
        only_b = [r for r in b[1] if r not in set(a[1])][:3]
        return f"{len(rows)} vs {len(want)} rows; spark {a[0]} {only_a} oracle {only_b} types {odd}", seconds, len(rows)
    if odd:
        return f"types {odd}", seconds, len(rows)
    return None, seconds, len(rows)
