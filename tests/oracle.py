"""Runs registered queries against their SQL on the same tables and compares the values."""

from __future__ import annotations

import math
import os
import sys
import threading
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return repr(v)


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def compare(spark, con, name, run, sql, sf_dir):
    """(ok, message)."""
    t0 = time.time()
    df = run(spark, sf_dir)
    rows = df.collect()
    t1 = time.time()
    cols = sorted(df.columns)
    got = sorted(tuple(norm(x[c]) for c in cols) for x in rows)
    if sql is None:
        return True, f"rows only: {len(got)} rows, spark {t1 - t0:.1f}s"
    guard = threading.Timer(60, con.interrupt)  # an SQL twin that does not end is a failure
    guard.start()
    try:
        rel = con.execute(sql)
    finally:
        guard.cancel()
    desc = {d[0]: str(d[1]) for d in rel.description}
    want_rows = rel.fetchall()
    t2 = time.time()
    times = f"spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s"
    if sorted(desc) != cols:
        return False, f"columns {cols} != {sorted(desc)}"
    order = {c: i for i, c in enumerate(desc)}
    want = sorted(tuple(norm(x[order[c]]) for c in cols) for x in want_rows)
    for f in df.schema.fields:
        mine = TYPE_NAMES.get(f.dataType.simpleString())
        if mine and mine != desc[f.name]:
            return False, f"type of {f.name}: {mine} != {desc[f.name]}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)} ({times})"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, {cols}: {bad[:2]} ({times})"
    return True, f"{len(got)} rows, {times}"


def main():
    import __spark_entry__ as entry
    from sparkloom.session import build_session
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, message = compare(spark, con, name, run, sqls.get(name), sf_dir)
        except Exception as e:  # a report over all queries
            ok, message = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("OK  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
