"""Compare registered queries with their SQL on DuckDB: python tests/check.py [folder] [name ...]"""

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return x + 0.0 if x else 0.0
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(made, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def kind(v):
    return "n" if isinstance(v, (int, float)) and not isinstance(v, bool) else type(v).__name__


def compare(df, con, sql):
    """None when equal, else a short account of the first difference."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(want_names, want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(df.columns)}\n   spark {x}\n   sql   {y}"
        for u, v in zip(x, y):
            if u is not None and type(u) is not type(v):
                return f"type {type(u)} != {type(v)} in {x}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from tallywork.session import get_session

    conf = dict(a.split("=", 1) for a in sys.argv[1:] if "=" in a)
    args = [a for a in sys.argv[1:] if "=" not in a]
    folder = args[0] if args else "/root/testdata/sf0.01"
    qs, sqls = queries(), oracle_sql()
    names = args[1:] or list(qs)
    spark = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", **conf}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    bad = []
    for n in names:
        t = time.time()
        try:
            df = qs[n](spark, folder)
            if n in sqls:
                diff = compare(df, con, sqls[n])
            else:
                diff = None if df.count() >= 0 else "?"
        except Exception as e:  # noqa: BLE001
            diff = "".join(traceback.format_exception_only(e))[:1500]
        print(f"{'ok ' if diff is None else 'BAD'} {n} {time.time() - t:.2f}s {'' if n in sqls else '(no sql)'}", flush=True)
        if diff:
            bad.append(n)
            print("   ", diff, flush=True)
    print(len(names) - len(bad), "of", len(names), "equal; bad:", bad)


if __name__ == "__main__":
    main()
