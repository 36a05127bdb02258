"""Run named queries on Spark and their check SQL on DuckDB and compare whole results."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(v):
    return "num" if isinstance(v, (int, float)) and not isinstance(v, bool) else type(v).__name__


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == int(v) if isinstance(v, float) and math.isfinite(v) else False:
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(data, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(df, con, sql):
    """Empty text if both results are equal, otherwise what differs first."""
    a_names, a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    b_names, b = rows_of([d[0] for d in rel.description], rel.fetchall())
    if a_names != b_names:
        return f"columns {a_names} / {b_names}", len(a)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}", len(a)
    for x, y in zip(a, b):
        for n, p, q in zip(a_names, x, y):
            if p != q or (p is not None and type(p) is not type(q)):
                return f"{n}: {p!r} / {q!r} in {x} / {y}", len(a)
    return "", len(a)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    import __spark_entry__ as entry
    from tidemark.session import get_session

    spark = get_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, checks = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in checks:
                problem, n = compare(df, con, checks[name])
            else:
                n = len(df.collect())
                problem = "" if n else "no rows"
        except Exception as exc:
            problem, n = "error " + str(exc)[:1500], 0
        bad += bool(problem)
        label = "FAIL" if problem else "ok" if name in checks else "rows"
        print(f"{label:5}{name:32}{n:8} rows {time.time() - start:6.2f}s {problem}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
