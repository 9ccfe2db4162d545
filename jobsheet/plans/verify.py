"""Run a registered query next to its SQL oracle and compare the results.

Used by the test-suite and by ``python -m jobsheet.plans.verify``.  The
comparison is order-insensitive: column names must match, row counts must
match, and rows are compared after sorting with a small float tolerance.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from jobsheet.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, v)
    if isinstance(v, bool):
        return (2, float(v))
    if isinstance(v, int):
        return (2, float(v))
    if isinstance(v, (list, tuple)):
        return (3, tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return (4, str(v))


def _close(a, b, tol=1e-6):
    if a[0] != b[0]:
        return False
    if a[0] == 2:
        return abs(a[1] - b[1]) <= tol * max(1.0, abs(a[1]), abs(b[1]))
    if a[0] == 3:
        return len(a[1]) == len(b[1]) and all(_close(x, y, tol) for x, y in zip(a[1], b[1]))
    return a == b


def compare(spark_rows, spark_cols, sql_rows, sql_cols, tol=1e-6):
    """Return (ok, message)."""
    if sorted(spark_cols) != sorted(sql_cols):
        return False, f"columns differ: spark={spark_cols} sql={sql_cols}"
    if len(spark_rows) != len(sql_rows):
        return False, f"row count spark={len(spark_rows)} sql={len(sql_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    qi = [sql_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in qi) for r in sql_rows)
    exact = a == b
    for x, y in zip(a, b):
        if not all(_close(u, v, tol) for u, v in zip(x, y)):
            return False, f"value mismatch:\n spark={x}\n sql  ={y}\n cols={order}"
    return True, "exact" if exact else "within tolerance"


def check(spark, name: str, sf_dir: str, con=None):
    from jobsheet.plans import catalog  # noqa: F401  (registers queries)
    from jobsheet.plans.registry import REGISTRY
    e = REGISTRY[name]
    t0 = time.time()
    df = e.fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    t1 = time.time()
    if e.sql is None:
        return True, f"rows-only ({len(rows)} rows)", t1 - t0
    con = con or duck(sf_dir)
    res = con.execute(e.sql())
    sql_cols = [d[0] for d in res.description]
    sql_rows = res.fetchall()
    ok, msg = compare(rows, cols, sql_rows, sql_cols)
    return ok, f"{msg} ({len(rows)} rows)", t1 - t0


def main(argv=None):
    argv = argv if argv is not None else sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    from jobsheet.plans import catalog  # noqa: F401
    from jobsheet.plans.registry import REGISTRY
    from jobsheet.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    names = names or list(REGISTRY)
    bad = 0
    for n in names:
        try:
            ok, msg, dt = check(spark, n, sf_dir, con)
        except Exception as ex:  # report and continue
            ok, msg, dt = False, f"ERROR {type(ex).__name__}: {str(ex)[:800]}", 0.0
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {dt:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
