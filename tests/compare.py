"""Spark result vs DuckDB oracle: same columns, same rows (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    """digits=None compares floats bit for bit."""
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        if digits is None:
            return float.hex(v)
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows(cols, records, digits=6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in records]
    return sorted(out, key=repr)


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    "smallint": "SMALLINT", "float": "FLOAT",
}


def type_mismatches(spark_df, con, sql: str):
    """Columns whose Spark type does not map to the DuckDB result type."""
    rel = con.sql(sql)
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = []
    for f in spark_df.schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            out.append((f.name, f.dataType.simpleString(), got))
    return out


def compare(spark_df, con, sql: str, digits: int = 6):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    bad_types = type_mismatches(spark_df, con, sql)
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows(s_cols, s_rows, digits), rows(d_cols, d_rows, digits)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"
