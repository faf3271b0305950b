"""Run registered queries in Spark and their SQL forms in DuckDB, and compare row by row.

    python -m tillstar_checks.compare /root/testdata/sf0.01 [name ...]
"""

import sys
import time
from decimal import Decimal

import duckdb

from tillstar_checks.oracle import oracle_sql
from tillstar_checks.registry import registry
from tillstar.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(value)
    return str(value)


def as_table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


# Types as both engines name them.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, connection, folder, name, sql):
    """None if equal, else what differs."""
    frame = registry()[name](spark, folder)
    spark_columns, spark_rows = as_table(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    description = [(d[0], str(d[1])) for d in result.description]
    duck_columns, duck_rows = as_table([d[0] for d in description], result.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} / {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} / {len(duck_rows)}"
    different = [(a, b) for a, b in zip(spark_rows, duck_rows, strict=True) if a != b]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    kinds = dict(description)
    types = [
        (c, t, kinds[c])
        for c, t in frame.dtypes
        if KINDS.get(t, t.upper()).replace(" ", "") != kinds[c].replace(" ", "")
    ]
    if types:
        return f"types {types}"
    return None


def main(folder, names):
    spark = get_session(app_name="compare", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    sql = oracle_sql()
    failed = []
    for name in names or registry():
        started = time.time()
        try:
            problem = compare(spark, connection, folder, name, sql[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        if problem:
            failed.append(name)
        print(f"{name:28} {time.time() - started:6.1f}s {problem or 'equal'}", flush=True)
    print(f"{len(failed)} different: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
