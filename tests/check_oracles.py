"""Run registered queries against their SQL checks: python tests/check_oracles.py [sf] [name ...]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, dt.date)):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql):
    """None when equal, else a description of the first difference."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(got)
    for x, y in zip(a, b):
        if x != y:
            return f"first difference in {sorted(names)}:\n   spark {str(x)[:700]}\n   sql   {str(y)[:700]}", len(got)
    return None, len(got)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if args[1:] and not any(name.startswith(a) for a in args[1:]):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                problem, n = compare(df, con, oracles[name])
            else:
                problem, n = None, df.count()
        except Exception:
            problem, n = traceback.format_exc()[-1800:], -1
        bad += problem is not None
        verdict = "ok" if problem is None else "BAD"
        print(f"{verdict:4} {name:28} rows={n:<8} {time.time() - start:6.2f}s {'' if name in oracles else '(rows only)'}", flush=True)
        if problem:
            print("    ", problem, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
