"""Compare registered queries with their SQL: ``check_queries.py DIR [NAME ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import oracle
from __spark_entry__ import oracle_sql, queries


def main() -> int:
    d, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(d)
    bad = 0
    for name, fn in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            columns, got = oracle.spark_rows(fn(spark, d))
            took = time.time() - t
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows  {name:32s} {len(got):7d} {took:6.2f}s", flush=True)
                continue
            wanted_columns, wanted = oracle.duck_rows(con, sql)
            if columns == wanted_columns and got == wanted:
                print(f"ok    {name:32s} {len(got):7d} {took:6.2f}s", flush=True)
                continue
            bad += 1
            print(f"DIFF  {name:32s} {len(got)} vs {len(wanted)}", columns, wanted_columns)
            shown = 0
            for a, b in zip(got, wanted):
                if a != b and shown < 3:
                    print("   spark ", repr(a)[:300]); print("   oracle", repr(b)[:300]); shown += 1
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
