"""Typed readers. Lines that do not fit the schema are kept aside, not lost and not fatal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_CLICKS, BRONZE_CRM, CLICK_FOLDERS

CORRUPT = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Landed orders in the types their files have: dates as timestamps or text, amounts as decimals or
    doubles; files of a full load, without the columns of the change log, beside change files. The clean-up
    reads dates from text and converts amounts."""
    orders = spark.read.option("mergeSchema", True).parquet(path)
    return orders.withColumn("order_date", F.col("order_date").cast("string"))


def click_schema(folders: bool = True) -> str:
    """Clicks, the corrupt line, and the delivery folders as integer columns."""
    schema = f"{BRONZE_CLICKS}, {CORRUPT} string"
    return ", ".join([schema, *(f"{f} int" for f in CLICK_FOLDERS)]) if folders else schema


def read_clicks(spark: SparkSession, path: str, folders: bool = True) -> DataFrame:
    """JSON lines, gzip or plain, in year / month / day / hour folders."""
    return spark.read.schema(click_schema(folders)).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_crm(spark: SparkSession, path: str) -> DataFrame:
    """CSV exports with a header, all days below ``path``. A file whose header differs from the schema
    is an error; a line that does not parse is kept as a corrupt line."""
    return (
        spark.read.schema(f"{BRONZE_CRM}, {CORRUPT} string")
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fitted the schema, and the lines that did not."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
