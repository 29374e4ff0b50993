"""Order-insensitive comparison of Spark rows with DuckDB rows."""

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v))
    if isinstance(v, int):
        return (1, repr(float(v))) if abs(v) < 2**53 else (5, str(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ").replace("+00:00", ""))
    if isinstance(v, (list, tuple)):
        return (3, str([norm(x) for x in v]))
    return (6, str(v))


def same_rows(spark_df, con, sql):
    rel = con.sql(sql)
    dcols, drows = rel.columns, rel.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    assert len(srows) == len(drows)
    a = sorted(tuple(norm(v) for v in r) for r in srows)
    b = sorted(tuple(norm(v) for v in r) for r in drows)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    assert not diffs, diffs[:3]
    return len(srows)
