"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH with the reason.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from essayspark.sources.tables import TABLES  # noqa: E402


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
            return (0, "nan")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    if hasattr(v, "tolist"):
        return (2, repr([_norm(x) for x in v.tolist()]))
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, int):
        return (1, f"{float(v):.6f}")
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"ROWS-ONLY {name}: {len(s_rows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_sorted, sc = rows_of(s_cols, s_rows)
    d_sorted, dc = rows_of(d_cols, d_rows)
    if sc != dc:
        return f"MISMATCH {name}: columns spark={sc} duck={dc}"
    if len(s_sorted) != len(d_sorted):
        return f"MISMATCH {name}: rows spark={len(s_sorted)} duck={len(d_sorted)}"
    bad = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b]
    if bad:
        return f"MISMATCH {name}: {len(bad)} rows differ; first spark={bad[0][0]} duck={bad[0][1]}"
    return f"OK {name}: {len(s_sorted)} rows (spark {t1 - t0:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from essayspark.session import build_session

    import __spark_entry__ as entry

    if os.environ.get("PLAIN_SESSION"):
        # the driver's own kind of session: none of this package's settings
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    n_bad = 0
    for name in names or sorted(qs):
        try:
            line = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and keep going
            line = f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}"
        n_bad += not (line.startswith("OK") or line.startswith("ROWS-ONLY"))
        print(line, flush=True)
    print(f"{n_bad} failing of {len(names or qs)}")
    return n_bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
