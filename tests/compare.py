"""Run registered queries beside their SQL in DuckDB: python tests/compare.py [sf] [name ...]"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if columns else "no columns"
    result = con.execute(sql)
    names, expected = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return f"columns {columns} <> {names}"
    if got == expected:
        return None
    only = [r for r in got if r not in set(expected)][:2], [r for r in expected if r not in set(got)][:2]
    return f"{len(got)} <> {len(expected)} rows; only here {only[0]}; only there {only[1]}"


def main():
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__} {str(error)[:900]}"
        note = "" if name in oracles else " (no SQL)"
        print(f"{'ok ' if problem is None else 'BAD'} {name}{note} {time.time() - started:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
