"""Compare the registered queries with their SQL on DuckDB, value by value."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_value(r[i])).__name__, _value(r[i])) for i in order) for r in rows)


def difference(spark, con, build, sql, sf_dir):
    """None where both agree, else a short description."""
    df = build(spark, sf_dir)
    got = df.collect()
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    expected = answer.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = bag(df.columns, got), bag(names, expected)
    if a != b:
        return (f"rows {len(got)} vs {len(expected)}; only spark {list((a - b).items())[:2]}; "
                f"only sql {list((b - a).items())[:2]}")
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from ledgerbrook.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            diff = difference(spark, con, build, entry.oracle_sql()[name], sf)
        except Exception as error:
            diff = "ERROR " + str(error)[:1500]
        print(f"{'ok  ' if diff is None else 'DIFF'} {name:28s} {time.time() - start:6.2f}s {diff or ''}", flush=True)
