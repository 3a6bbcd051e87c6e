"""Run registered queries against their SQL checks: ``python -m tests.oracle sf_dir [prefix ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def connect(path: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql: str):
    """None if both sides agree, else a description of the difference."""
    spark_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    a, b = rows_of(df.columns, spark_rows), rows_of(sql_columns, sql_rows)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main(path: str, prefixes):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from recspark.queries import QUERIES, SQL_CHECKS
    con, failed = connect(path), 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, path)
            if name in SQL_CHECKS:
                problem = compare(con, df, SQL_CHECKS[name])
            else:
                rows = df.count()
                problem = None if rows else "no rows"
                name += f" (no SQL, {rows} rows)"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
            if not any(k in type(error).__module__ for k in ("duckdb", "pyspark")):
                traceback.print_exc()
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
