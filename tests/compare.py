"""Run the queries beside their SQL in DuckDB and compare them as bags of rows.

python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(cell(v) for v in value)
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def differences(df, con, sql):
    """None if both give the same columns and rows, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = bag(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = bag(df.columns, df.collect())
    if got == want:
        return None
    missing, extra = want - got, got - want
    return (
        f"rows {sum(got.values())} against {sum(want.values())}; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )


def main():
    from __spark_entry__ import oracle_sql, queries
    from tidemill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            text = differences(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:
            text = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += text is not None and not text.startswith("no SQL")
        print(f"{name:28s} {time.time() - start:6.2f}s  {text or 'ok'}", flush=True)
    print(f"{len(wanted)} queries, {bad} differ")


if __name__ == "__main__":
    main()
