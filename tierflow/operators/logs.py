"""Batches of a table as append-only folders, one catalog partition each.

What a micro-batch adds is written to a folder of its attempt and becomes visible, whole, when one statement adds
its partition. Files are never rewritten, so readers keep what they have open, and an attempt that failed or
is repeated leaves at most a folder nobody refers to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def change(spark: SparkSession, statement: str) -> None:
    """Every catalog change that readers can see goes through here."""
    spark.sql(statement)


def create(spark: SparkSession, log: str, columns: str, root: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {log} ({columns}, batch string) USING parquet PARTITIONED BY (batch) "
        f"LOCATION '{root}/log'"
    )


def folder(root: str, batch: str) -> str:
    """A new folder for an attempt at a batch."""
    return f"{root}/batches/{batch}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, log: str, batch: str, path: str) -> None:
    """Show the files in ``path`` as the batch; a batch that is there already stays as it is."""
    change(spark, f"ALTER TABLE {log} ADD IF NOT EXISTS PARTITION (batch = '{batch}') LOCATION '{path}'")
    spark.catalog.refreshTable(log)


def batches(spark: SparkSession, log: str) -> list[str]:
    return sorted(r.partition.partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {log}").collect())


def read(spark: SparkSession, log: str, names: Sequence[str]) -> DataFrame:
    """The rows of some batches; no other folder is read."""
    return spark.table(log).filter(F.col("batch").isin(*names)).drop("batch")


def forget(spark: SparkSession, log: str, names: Sequence[str]) -> None:
    """Take batches out of the log in one statement; their files stay for running readers."""
    if names:
        change(spark, f"ALTER TABLE {log} DROP IF EXISTS " + ", ".join(f"PARTITION (batch = '{n}')" for n in names))
        spark.catalog.refreshTable(log)


def batch_name(spark: SparkSession, number: int) -> str:
    """Name of a micro-batch that no other stream has: the id its checkpoint holds, and its number."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or uuid.uuid4()}-{number:09d}"


def settled(names: Sequence[str]) -> list[str]:
    """Batches that no stream will repeat: all but the newest of each."""
    newest = {n.rpartition("-")[0]: n for n in sorted(names)}
    return [n for n in names if n not in newest.values()]


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
