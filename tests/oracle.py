"""Compare registered queries with their SQL on DuckDB.

``python -m tests.oracle [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tuples = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(tuples, key=lambda t: tuple((v is None, str(v)) for v in t))


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs first."""
    columns, rows = sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted_columns, wanted = sorted_rows(names, result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    types = sorted((name, TYPES.get(kind, kind)) for name, kind in df.dtypes)
    wanted_types = sorted((d[0], str(d[1])) for d in result.description)
    if types != wanted_types:
        return f"types {types} != {wanted_types}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    for row, want in zip(rows, wanted):
        if row != want or [type(v) for v in row] != [type(v) for v in want]:
            return f"{row} != {want}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                outcome = difference(df, con, sqls[name]) or "ok"
            else:
                outcome = f"ok, {len(df.collect())} rows, no SQL"
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not outcome.startswith("ok")
        print(f"{name:28s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
