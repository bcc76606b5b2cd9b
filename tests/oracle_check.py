"""Compare registered queries with their SQL. Run: python tests/oracle_check.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(row) for row in df.select(names).collect()), key=repr)


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    found = [column[0] for column in cursor.description]
    order = sorted(range(len(found)), key=lambda i: found[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [found[i] for i in order], sorted(rows, key=repr)


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
        .config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            got = spark_rows(query(spark, folder))
        except Exception as error:  # report and go on with the next query
            print(f"{name:28} FAILED {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        want = sql_rows(connection, oracle_sql()[name])
        verdict = "ok" if got == want else "DIFFERENT"
        print(f"{name:28} {verdict} rows {len(got[1])}/{len(want[1])} {took:.1f}s", flush=True)
        if got != want:
            print(got[0], want[0])
            for mine, theirs in [pair for pair in zip(got[1], want[1]) if pair[0] != pair[1]][:3]:
                print("  ", mine, "\n  ", theirs)
