"""Compare registered queries with their SQL counterparts: python -m workload.check [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("check")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(v, ".10g")
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, sf_dir, queries, oracles) -> str:
    df = queries[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return f"rows-only {len(got)}" if got else "EMPTY"
    cur = con.execute(oracles[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    types = {d[0]: str(d[1]) for d in cur.description}
    odd = {c: t for c, t in types.items() if not any(
        t.upper().startswith(x) for x in ("BIGINT", "VARCHAR", "DOUBLE", "BOOL", "NUMBER", "STRING"))}
    if odd:
        return f"TYPES {odd}"
    if got_cols != want_cols:
        return f"COLUMNS {got_cols} != {want_cols}"
    if got != want:
        a, b = set(got), set(want)
        return f"VALUES {len(got)} vs {len(want)} only-spark {sorted(a - b)[:2]} only-sql {sorted(b - a)[:2]}"
    return f"ok {len(got)}"


def main() -> int:
    from workload import ORACLES, QUERIES
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con, bad = session(), database(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            out = compare(spark, con, name, sf_dir, QUERIES, ORACLES)
        except Exception as e:  # noqa: BLE001
            out = f"ERROR {type(e).__name__} {str(e)[:600]}"
        bad += not out.startswith(("ok", "rows-only"))
        print(f"{name:32} {time.time() - start:6.1f}s {out}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
