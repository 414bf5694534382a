"""Compare registered queries with their SQL in DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (repr(float(f"{v:.10g}")) if v != int(v) else repr(int(v)))
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


def compare(df, con, sql) -> str:
    """Empty when both sides agree, else what differs."""
    got_columns = df.columns
    got = df.collect()
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = want.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    names = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
    }
    for c, t in df.dtypes:
        if names.get(t) != want_types[c]:
            return f"type of {c}: {t} != {want_types[c]}"
    a, b = rows_of(got_columns, got), rows_of(want_columns, want_rows)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference {x} != {y}"
    if not a:
        return "no rows on either side"
    return ""


def main() -> None:
    from tallyloom.plans import load_all
    from tallyloom.session import build_session

    args = sys.argv[1:]
    root = args[0] if args else "/root/testdata/sf0.01"
    families = [a[1:] for a in args[1:] if a.startswith("@")]
    names = [a for a in args[1:] if not a.startswith("@")]
    if families:
        import importlib

        from tallyloom.plans.registry import REGISTRY

        for f in families:
            importlib.import_module(f"tallyloom.plans.{f}")
        found = REGISTRY
    else:
        found = load_all()
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    bad = 0
    for name, q in found.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.run(spark, root)
            if q.sql is None:
                verdict = "" if df.count() > 0 else "no rows"
            else:
                verdict = compare(df, con, q.sql)
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(verdict)
        print(f"{'BAD ' if verdict else 'ok  '} {name} {time.time() - start:.2f}s {'' if q.sql else '(rows only)'} {verdict[:900]}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
