"""Run registered queries and their SQL on the same tables and compare the rows."""

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd


def connect(folder):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "item"):
        return _cell(value.item())
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(float(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    columns = [frame[name].astype(object).tolist() for name in frame.columns]
    return Counter(tuple(_cell(v) for v in row) for row in zip(*columns))


def difference(spark_frame, sql_frame):
    """None when equal, else a short account of what differs."""
    left, right = sorted(spark_frame.columns), sorted(sql_frame.columns)
    if left != right:
        return f"columns {set(left) ^ set(right)}"
    a, b = rows_of(spark_frame), rows_of(sql_frame)
    if a == b:
        return None
    only_a, only_b = a - b, b - a
    return (
        f"{sum(a.values())} vs {sum(b.values())} rows, {sum(only_a.values())} and {sum(only_b.values())} unmatched; "
        f"{left}; spark {sorted(map(str, only_a))[:2]}; sql {sorted(map(str, only_b))[:2]}"
    )


def main(folder, names):
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = build(spark, folder).toPandas()
        except Exception as error:
            bad += 1
            print(f"{name:32s} ERROR {str(error)[:800]}", flush=True)
            continue
        took = time.time() - start
        if name not in sql:
            print(f"{name:32s} rows {len(got)} (no SQL) {took:.2f}s", flush=True)
            continue
        start = time.time()
        try:
            problem = difference(got, db.execute(sql[name]).df())
        except Exception as error:
            problem = f"SQL {error}"
        bad += problem is not None
        verdict = "ok" if problem is None else f"DIFF {problem[:1500]}"
        print(f"{name:32s} {len(got):8d} {took:6.2f}s sql {time.time() - start:5.2f}s {verdict}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
