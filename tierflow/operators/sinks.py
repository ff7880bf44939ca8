"""Writers: overwrite, versioned publish, typed export, bucketed warehouse table."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXPORT, Field
from .logs import properties
from .quality import conformance, gate

# Looks at what was stored and raises, or returns what is to be noted on the version.
Check = Callable[[DataFrame], Mapping[str, object] | None]

# Rows a bucket of the warehouse table should have, where the caller names no number of buckets.
ROWS_PER_BUCKET = 2_000_000


def _writer(df: DataFrame, partition_by: Sequence[str], fmt: str) -> DataFrameWriter:
    """Rows of one output folder are brought together first, so a folder gets few files. Rebalancing,
    unlike a repartition, lets adaptive execution split a folder that holds much of the data."""
    if not partition_by:
        return df.write.format(fmt)
    return df.hint("rebalance", *partition_by).write.format(fmt).partitionBy(*partition_by)


def overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", only_touched: bool = False
) -> None:
    """Replace the data at ``path``, or with ``only_touched`` just the partitions that ``df`` has."""
    mode = "dynamic" if only_touched else "static"
    _writer(df, partition_by, fmt).mode("overwrite").option("partitionOverwriteMode", mode).save(path)


# ---------------------------------------------------------------- versioned publish


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return name


def publish(
    df: DataFrame,
    name: str,
    run_ts: datetime,
    partition_by: Sequence[str] = (),
    checks: Sequence[Check] = (),
    fmt: str = "parquet",
    keep: int = 2,
) -> DataFrame:
    """Stage, validate, publish; returns the published data.

    The plan runs once, into a new table of its own. The checks see what was stored. Only then the
    view ``name`` moves to the new table, in one catalog operation: readers see the old version or the
    new one. If a check raises, the view stays as it was and the staged table is dropped. The ``keep``
    newest versions stay, so that queries running on the previous one can finish.
    """
    version = store(df, name, run_ts, partition_by, checks, fmt)
    move(df.sparkSession, {name: version}, keep)
    return df.sparkSession.table(version)


def _new_version(name: str, stamp: str) -> str:
    return f"{name}__{stamp}_{uuid.uuid4().hex[:8]}"


def store(
    df: DataFrame,
    name: str,
    run_ts: datetime,
    partition_by: Sequence[str] = (),
    checks: Sequence[Check] = (),
    fmt: str = "parquet",
) -> str:
    """Write a version of ``name`` that no reader sees yet and check what was stored; returns the table of the
    version. If a check raises, that table is dropped; what the checks return is noted on it."""
    spark = df.sparkSession
    version = _new_version(name, f"{run_ts:%Y%m%d%H%M%S}")
    _writer(df, partition_by, fmt).saveAsTable(version)
    with dropped_on_error(spark, version):
        staged = spark.table(version)
        notes = {k: v for check in checks for k, v in (check(staged) or {}).items()}
        if notes:
            spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in notes.items()) + ")")
    return version


@contextmanager
def dropped_on_error(spark: SparkSession, version: str) -> Iterator[None]:
    try:
        yield
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise


def move(spark: SparkSession, targets: Mapping[str, str], keep: int = 2, source: str | None = None) -> None:
    """Point each view at its new version, one right after the other, and only then drop old versions.
    ``source`` is noted on the views: the version they were made from."""
    for name, version in targets.items():
        noted = {"version": version, **({"source": source} if source else {})}
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in noted.items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT * FROM {version}")
    for name, version in targets.items():
        _drop_old_versions(spark, name, version, keep)


def current_version(spark: SparkSession, name: str) -> str:
    """The table that a published name shows now."""
    return properties(spark, name)["version"]


def resolve(spark: SparkSession, name: str) -> tuple[DataFrame, int]:
    """What a published name shows now and its number of rows: as noted when the version was checked, counted only
    for a view that has no version, as that of a log."""
    version = properties(spark, name).get("version")
    table = spark.table(version or name)
    noted = properties(spark, version).get("rows") if version else None
    return table, int(noted) if noted is not None else table.count()


def versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of a published name, oldest first."""
    database, _, short = name.rpartition(".")
    pattern = re.compile(re.escape(short.lower()) + r"__\d{14}_[0-9a-f]{8}")
    found = spark.sql(f"SHOW TABLES{' IN ' + database if database else ''} LIKE '{short}__*'").collect()
    return sorted(f"{database}.{r.tableName}" if database else r.tableName for r in found if pattern.fullmatch(r.tableName))


def _drop_old_versions(spark: SparkSession, name: str, current: str, keep: int) -> None:
    """Only versions before the current one: a later one may be another run's stage."""
    older = [v for v in versions(spark, name) if v < current.lower()]
    for old in older[: max(len(older) - (keep - 1), 0)]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


# ---------------------------------------------------------------- export and warehouse table


def to_export(gold: DataFrame, fields: Sequence[Field] = EXPORT) -> DataFrame:
    """The declared columns in the declared order and types. A value that does not fit its decimal
    stops the job: it must not reach the export as NULL."""
    return gold.select(*(F.col(f.name).cast(f.type).alias(f.name) for f in fields))


def conforms(fields: Sequence[Field] = EXPORT) -> Check:
    """A check for ``publish`` and ``load_table``."""
    return lambda df: gate(conformance(df, fields), "schema conformance")


def create_bucketed_table(
    spark: SparkSession,
    name: str,
    fields: Sequence[Field] = EXPORT,
    bucket_by: str = "customer_id",
    sort_by: Sequence[str] = ("churn_risk", "rfm_segment"),
    buckets: int = 200,
) -> None:
    """A table with text widths, hashed on one column and sorted inside each bucket. Joins and
    groupings on the bucket column need no exchange; filters on the sort columns skip row groups. A table that
    is there already must have this layout."""
    columns = ", ".join(f.ddl for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({bucket_by}) SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS"
    )
    found = _described(spark, name)
    layout = tuple(found.get(k, "").replace("`", "") for k in ("Num Buckets", "Bucket Columns", "Sort Columns"))
    if layout != (str(buckets), f"[{bucket_by}]", f"[{', '.join(sort_by)}]"):
        raise ValueError(f"{name} has another layout: {layout}")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def publish_bucketed(
    spark: SparkSession, export: str, name: str, buckets: int | None = None, keep: int = 2
) -> DataFrame:
    """Load the current version of ``export`` into the bucketed table ``name`` in place of what it held.

    The rows are loaded into a table of their own; when that is whole, the location of ``name`` moves to it in
    one catalog operation. A load that fails, in whatever stage, leaves readers on the old rows. (A view would
    cast columns with a text width, which hides the buckets.) Without ``buckets`` a new table gets as many as
    its first rows ask for, and a table that is there keeps its own.
    """
    source = current_version(spark, export)
    df = spark.table(source)
    if spark.catalog.tableExists(name):
        buckets = buckets or int(_described(spark, name)["Num Buckets"])
        create_bucketed_table(spark, name, buckets=buckets)
    elif buckets is None:
        buckets = max(1, math.ceil(df.count() / ROWS_PER_BUCKET))
    version = _new_version(name, source.rpartition("__")[2].partition("_")[0])
    create_bucketed_table(spark, version, buckets=buckets)
    with dropped_on_error(spark, version):
        load_table(df, version, mode="append")
    create_bucketed_table(spark, name, buckets=buckets)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{_described(spark, version)['Location']}'")
    spark.catalog.refreshTable(name)
    _drop_old_versions(spark, name, version, keep)
    return spark.table(name)


def load_table(df: DataFrame, name: str, fields: Sequence[Field] = EXPORT, mode: str = "replace") -> DataFrame:
    """Check the columns, then load. 'replace' gives the same table however often it is run, but deletes the old
    files before it writes: where readers must be safe use ``publish_bucketed``. 'append' adds to the table.

    Rows are hashed as the buckets are before they are written, so each bucket is written by one task
    as one file. The bucket column is the key of the export, one row each.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode}")
    conforms(fields)(df)
    spark = df.sparkSession
    described = _described(spark, name)
    if "Num Buckets" in described:
        df = df.repartition(int(described["Num Buckets"]), described["Bucket Columns"].strip("[]`"))
    df.write.insertInto(name, overwrite=mode == "replace")
    return spark.table(name)
