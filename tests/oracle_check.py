"""Compare registered queries with their SQL: python tests/oracle_check.py [folder] [query ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_module  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    df = entry_module.queries()[name](spark, folder)
    got = df.collect()
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = canonical(got, df.columns), canonical(want, columns)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return not bad, f"{len(a)} rows" + (f", {len(bad)} differ, first {bad[0]}" if bad else "")


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry_module.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    sys.exit(bool(failed))
