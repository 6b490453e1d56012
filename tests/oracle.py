"""Compare every query with its SQL oracle: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def make_spark(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("medallion")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, db, folder: str, name: str):
    """(agrees, seconds, detail) of one query."""
    started = time.time()
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got), seconds, f"{len(got)} rows, no oracle"
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, seconds, f"columns {df.columns} and {names}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:2]
        extra = [r for r in got if r not in set(want)][:2]
        return False, seconds, f"{len(got)} and {len(want)} rows; missing {missing}; extra {extra}"
    return True, seconds, f"{len(got)} rows | " + ", ".join(
        f"{f.name}:{f.dataType.simpleString()}/{kinds[f.name]}" for f in df.schema.fields
    )


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments[0] if arguments else "/root/testdata/sf0.01"
    session, database = make_spark(), connect(where)
    failed = 0
    for query_name in arguments[1:] or entry.queries():
        try:
            ok, took, text = compare(session, database, where, query_name)
        except Exception as error:
            ok, took, text = False, 0.0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {query_name} {took:.2f}s {text[:700]}", flush=True)
    print(f"{failed} failed")
