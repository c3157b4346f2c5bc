"""Spark results against DuckDB's, as the driver compares them."""

import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*' if os.path.isdir(p) else ''}')")
    return con


def plain(rows, order):
    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(value(r[k]) for k in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names, want = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a = plain(got, [df.columns.index(c) for c in sorted(names)])
    b = plain(want, [names.index(c) for c in sorted(names)])
    if a != b:
        return f"{len(a)} and {len(b)} rows; only Spark {sorted(set(a) - set(b))[:3]}; only SQL {sorted(set(b) - set(a))[:3]}"
    return None
