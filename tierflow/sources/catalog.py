"""Bronze tables in the catalog: schema discovery and partition registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def register(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    schema: str | None = None,
    partition_by: tuple[str, ...] | None = None,
    **options: str,
) -> DataFrame:
    """Make the files at ``path`` the external table ``name`` with all their partitions.

    The only place where a schema is inferred, and only if none is given. Folder columns are part of
    an inferred schema, so ``partition_by`` names which columns they are. A name that is known must be that of the
    same files in the same columns.
    """
    if schema is None:
        found = spark.read.format(fmt).options(**options).load(path).schema
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {fmt}"
    if options:
        sql += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    known = spark.catalog.tableExists(name)
    spark.sql(f"{sql} LOCATION '{path}'")
    if known:
        _require_same(spark, name, path, schema)
    if partition_by:
        repair(spark, name)
    return spark.table(name)


def _require_same(spark: SparkSession, name: str, path: str, schema: str) -> None:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    # the catalog writes locations its own way
    plain = lambda where: where.removeprefix("file:").replace("//", "/").rstrip("/")
    if plain(described["Location"]) != plain(path):
        raise ValueError(f"{name} is registered at {described['Location']}, not {path}")
    columns = lambda fields: {f.name.lower(): f.dataType for f in fields}
    wanted, found = columns(StructType.fromDDL(schema).fields), columns(spark.table(name).schema.fields)
    if wanted != found:
        raise ValueError(f"{name} is registered with other columns: {found}")


def repair(spark: SparkSession, name: str) -> DataFrame:
    """Bring the registered partitions in line with the folders: new ones in, vanished ones out."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)
