"""Run registered queries against their SQL in DuckDB. Also usable from a shell:
``python tests/compare.py <sf_dir> [name-part ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def canonical(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    got_cols, got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return ("rows", len(got), None)
    rel = con.execute(sql)
    want_cols, want = canonical(rel.fetchall(), [c[0] for c in rel.description])
    if got_cols != want_cols:
        return ("columns", got_cols, want_cols)
    if got != want:
        a, b = set(got), set(want)
        return ("values", (len(got), sorted(a - b, key=repr)[:2]), (len(want), sorted(b - a, key=repr)[:2]))
    return ("ok", len(got), None)


def session(cores=8):
    from pyspark.sql import SparkSession
    return (SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "16g").config("spark.sql.adaptive.enabled", "true")
            .getOrCreate())


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    sf_dir, wanted = argv[0], argv[1:]
    spark, con = session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            verdict, a, b = compare(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            verdict, a, b = "error", type(e).__name__, str(e)[:1500]
        took = time.time() - start
        if verdict in ("ok", "rows"):
            print(f"{verdict:7s} {name} rows={a} {took:.1f}s", flush=True)
        else:
            bad += 1
            print(f"FAIL {name} [{verdict}] {took:.1f}s\n   got:  {str(a)[:1500]}\n   want: {str(b)[:1500]}", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
