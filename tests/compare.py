"""Runs registered queries against their SQL on the same tables and compares whole results."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value, digits):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, digits) + 0.0 if digits is not None else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v, digits) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v, digits)) for k, v in sorted(value.items()))
    return value


def rows_of(names, rows, digits):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i], digits) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, query, sql, digits=6):
    """(message or None, seconds, rows)"""
    start = time.time()
    df = query(spark, folder)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return None, seconds, len(got)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", seconds, len(got)
    a, b = rows_of(df.columns, got, digits), rows_of(names, expected, digits)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", seconds, len(got)
    for x, y in zip(a, b):
        if x != y:
            cols = sorted(names)
            diff = {c: (p, q) for c, p, q in zip(cols, x, y) if p != q}
            return f"{sum(p != q for p, q in zip(a, b))} rows differ, first: {diff}", seconds, len(got)
    return None, seconds, len(got)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = [a for a in sys.argv[2:] if a != "--distributed"]  # parts of query names, or `section:NAME`
    sections = [w.split(":")[1] for w in wanted if w.startswith("section:")]
    if sections:
        wanted = [f"={n}" for s in entry.SECTIONS if s.__name__.split(".")[-1] in sections for n in s.QUERIES]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "--distributed" in sys.argv:  # force the plans for inputs that do not fit one task
        spark.conf.set("spark.marketlens.singleTaskBytes", "0")
    con, sqls, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in f"={name}" if w[0] != "=" else w == f"={name}" for w in wanted):
            continue
        exact = None
        try:
            problem, seconds, n = compare(spark, con, folder, name, query, sqls.get(name))
            if problem is None and name in sqls:
                exact, _, _ = compare(spark, con, folder, name, query, sqls[name], None)
        except Exception as e:  # noqa: BLE001
            problem, seconds, n = f"{type(e).__name__}: {str(e)[:600]}", 0, 0
        bad += problem is not None
        state = "FAIL" if problem else ("ok" if name in sqls else "ran")
        print(f"{state:5}{name:32}{seconds:7.2f}s {n:7} {problem or ''}{' ~' + exact if exact else ''}", flush=True)
    print("failed:", bad)
