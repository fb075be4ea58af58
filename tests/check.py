"""Compares registered queries with their SQL twins: ``python tests/check.py FOLDER [names]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def same_result(frame, con, sql):
    """None when equal, else a short description of the difference."""
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = normal(names, cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(want[1])} differ, e.g. {bad[0]}" if bad else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in oracles:
                result = same_result(frame, con, oracles[name]) or "equal"
            else:
                result = f"{frame.count()} rows"
        except Exception as e:
            result = f"FAILED {type(e).__name__} {str(e)[:600]}"
        print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
