"""Run a registered query against its SQL on the same tables and compare whole results."""

import datetime as dt
import glob
import os
import sys
from decimal import Decimal

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("datetime", value.isoformat())
    return (type(value).__name__, str(value))


def compare(df, con, sql):
    """None when equal, else a short description of the first difference."""
    names = sorted(df.columns)
    got = sorted(tuple(canonical(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = sorted(tuple(canonical(r[i]) for i in order) for r in result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, SQL gives {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            diff = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
            return f"row differs: {diff[:4]}"
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_module
    from terrace.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8, 8, "compare")
    con = connect(folder)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    wanted = sys.argv[1:] or list(queries)
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:40s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
