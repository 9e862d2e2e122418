"""Compare the check queries with their SQL twins: python -m tests.check [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str(tuple(row[i] for i in order)) for row in rows)


def compare(df, connection, sql):
    """None when equal, else a short description of the first difference."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, df.collect())
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"\n  spark {a[:600]}\n  duck  {b[:600]}"
    return None


def main(argv):
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in ("region nation customer supplier part orders lineitem events documents "
                  "embeddings pages benchmark labels conversations").split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    oracles = entry.oracle_sql()
    failed = 0
    for name, function in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            df = function(spark, sf_dir)
            if name in oracles:
                difference = compare(df, connection, oracles[name])
            else:
                difference = None if df.count() > 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += difference is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if difference is None else 'DIFF ' + difference}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
