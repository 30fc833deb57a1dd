"""Compare registered queries with their SQL: rows, columns and values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf) / f"{t}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"create view {t} as select * from read_parquet('{files}')")
    return con


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, run, sql, sf):
    """None when equal, else what differs."""
    df = run(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first:\n   got  {str(bad[0][0])[:600]}\n   want {str(bad[0][1])[:600]}"
    if not got[1]:
        return "no rows"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf), entry.oracle_sql(), 0
    for name in names:
        t = time.time()
        try:
            told = compare(spark, con, name, entry.queries()[name], sqls[name], sf)
        except Exception as exc:  # noqa: BLE001
            told = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += told is not None
        print(f"{'ok  ' if told is None else 'FAIL'} {name} {time.time() - t:.2f}s {told or ''}", flush=True)
    print(f"{failed} of {len(names)} differ")
