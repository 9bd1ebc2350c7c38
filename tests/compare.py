"""Run registered queries and their SQL twins side by side.

python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v if isinstance(v, int) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Spark type -> the type DuckDB must give the same column
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def differences(spark, con, query, sql, folder) -> str | None:
    """None when both sides give the same columns and the same rows, else a short description."""
    df = query(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    types = {d[0]: str(d[1]) for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description}
    unlike = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]}
    if unlike:
        return f"types {unlike}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return f"rows {len(mine[1])} / {len(theirs[1])}, only Spark {list(a - b)[:3]}, only SQL {list(b - a)[:3]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from sitewell.plans import registered
    from sitewell.session import session
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or list(registered.QUERIES):
        start = time.time()
        try:
            found = differences(spark, con, registered.QUERIES[name], registered.SQL[name], folder)
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name:28s} {time.time() - start:6.2f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(1 if main(where, sys.argv[2:]) else 0)
