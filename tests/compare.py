"""Spark results against DuckDB on the same tables: names, row counts and sorted values."""

import math
import sys
import time

import duckdb

from workload.inputs import TABLES


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value) if value is not None else "null"


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, sf, run, sql):
    """Empty text when both sides agree."""
    df = run(spark, sf)
    got_names, got = canonical(df.columns, df.collect())
    result = con.execute(sql)
    want_names, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference {a} != {b}"
    return ""


def main(sf, only):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), entry.oracle_sql()
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                text = difference(spark, con, sf, run, sqls[name]) or "same"
            else:
                text = f"{run(spark, sf).count()} rows"
        except Exception as error:  # noqa: BLE001
            text = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {text}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
