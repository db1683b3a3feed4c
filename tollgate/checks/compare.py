"""Compare a Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0)
                 for v in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duckdb(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint"}


def type_mismatches(df, con, sql) -> list[tuple[str, str, str]]:
    """(column, spark type, duckdb type) for columns whose types differ."""
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in df.schema.fields:
        d = duck.get(f.name)
        if DUCK_TO_SPARK.get(d, (d or "").lower()) != f.dataType.simpleString():
            out.append((f.name, f.dataType.simpleString(), d))
    return out


def compare(df, con, sql) -> tuple[bool, str]:
    bad_types = type_mismatches(df, con, sql)
    if bad_types:
        return False, f"types differ: {bad_types[:5]}"
    sc, sr = rows_of_spark(df)
    oc, orows = rows_of_duckdb(con, sql)
    if sc != oc:
        return False, f"columns differ: spark-only {sorted(set(sc) - set(oc))}, oracle-only {sorted(set(oc) - set(sc))}"
    if len(sr) != len(orows):
        return False, f"row count {len(sr)} vs {len(orows)}"
    a = sorted(sr, key=lambda r: repr(r))
    b = sorted(orows, key=lambda r: repr(r))
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, u, v) for c, u, v in zip(sc, x, y) if u != v]
            return False, f"first differing row: {diff[:5]}"
    return True, f"{len(sr)} rows"
