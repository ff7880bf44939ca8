"""Compare every query with its SQL: ``python -m tests.oracle [folder] [query ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry_points
from tierflow import session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


# DuckDB type by Spark type; timestamps carry no zone on the SQL side.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    df = entry_points.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(_plain(row[c]) for c in columns) for row in df.collect())
    result = con.execute(entry_points.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in result.description}
    if sorted(described) != columns:
        return f"columns {columns} against {sorted(described)}"
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    other = {c: (types[c], described[c]) for c in columns if types[c] != described[c]}
    if other:
        return f"types {other}"
    order = list(described)
    want = Counter(tuple(_plain(row[order.index(c)]) for c in columns) for row in result.fetchall())
    if got != want:
        return f"{sum(got.values())} rows against {sum(want.values())}: only Spark {list((got - want).items())[:3]}, only SQL {list((want - got).items())[:3]}"
    return None if got else "no rows"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_points.queries())
    spark = session.build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - started:6.1f}s {'ok' if problem is None else 'DIFFERS ' + problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
