"""Run queries on Spark and their SQL in DuckDB, and compare rows, names and types.

    python -m stopwise_testbed.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from stopwise_testbed.oracle import ORACLE
from stopwise_testbed.queries import REGISTRY
from stopwise.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def local_session(cpus: int | str = 8) -> SparkSession:
    session = get_session(
        "stopwise-local",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def check(spark: SparkSession, connection, name: str, sf: str) -> str | None:
    """What differs between Spark and DuckDB for a query; None if nothing does."""
    df = REGISTRY[name](spark, sf)
    spark_names, spark_rows = df.columns, [tuple(row) for row in df.collect()]
    spark_types = {field.name: _TYPES.get(field.dataType.simpleString()) for field in df.schema}
    result = connection.execute(ORACLE[name])
    duck_types = {column[0]: str(column[1]) for column in result.description}
    duck_rows = result.fetchall()
    if spark_types != duck_types:
        return f"types {spark_types} against {duck_types}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    ours = _canonical(spark_names, spark_rows)
    theirs = _canonical(list(duck_types), duck_rows)
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"row {mine} against {other}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark, connection = local_session(), connect(sf)
    failures = 0
    for name in names:
        started = time.time()
        try:
            problem = check(spark, connection, name, sf)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name}"
              + (f"  {problem}" if problem else ""), flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main())
