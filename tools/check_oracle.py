"""Run registered queries next to their SQL and compare whole results.

    python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
         "boolean": "BOOLEAN"}


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(frame, con, sql):
    """Problems found, an empty list when rows, names and types agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = rows_of(names, cursor.fetchall())
    mine = rows_of(frame.columns, frame.collect())
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
        return problems
    for name, kind in frame.dtypes:
        if TYPES.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} != {len(theirs)}")
    if mine != theirs:
        left, right = set(mine), set(theirs)
        problems.append(f"values differ: {sorted(left - right)[:2]} / {sorted(right - left)[:2]}")
    return problems


def main(argv):
    from cadastre.plans.registered import QUERIES, SQL
    from cadastre.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    wanted = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problems = compare(frame, con, SQL[name])
                status = "OK" if not problems else "FAIL " + " | ".join(problems)
            else:
                status = f"ROWS {len(frame.collect())}"
        except Exception as exc:
            status = "FAIL " + type(exc).__name__ + " " + str(exc)[:600]
        failed += status.startswith("FAIL")
        print(f"{name:24s} {time.time() - started:6.2f}s {status}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
