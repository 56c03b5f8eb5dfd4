"""Compare registered queries with their SQL, the way the driver does.

Usage: python tests/check_oracle.py SF_DIR [QUERY ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def normal(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir, query, sql):
    """(problem or None, row count)"""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    for g, w in zip(got, want):
        if g != w:
            return f"first difference\n  spark {str(g)[:600]}\n  sql   {str(w)[:600]}", len(got)
    return None, len(got)


def main():
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("FATAL")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            problem, n = compare(spark, con, sf_dir, query, sqls.get(name))
        except Exception as failure:  # noqa: BLE001
            problem, n = f"{type(failure).__name__}: {str(failure)[:1500]}", -1
        bad += problem is not None
        kind = "sql" if name in sqls else "rows only"
        print(f"{'FAIL' if problem else 'ok':4} {name} rows={n} {kind} {time.perf_counter() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
