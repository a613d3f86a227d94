"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle_compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, query, sql, folder) -> str:
    """Empty if equal, else what differs."""
    frame = query(spark, folder)
    got_columns, got = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    answer = con.execute(sql)
    want_columns, want = sorted_rows([c[0] for c in answer.description], answer.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:3]
        lack = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} != {len(want)}; extra {extra}; lack {lack}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference\n   {got_columns}\n   spark {a}\n   sql   {b}"
    return "" if got else "no rows"


def main(argv):
    import __spark_entry__ as entry
    from pulsegrid.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                   "spark.ui.enabled": "false",
                                                   "spark.ui.showConsoleProgress": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], folder)
            else:
                n = query(spark, folder).count()
                problem = "" if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem}",
              flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
