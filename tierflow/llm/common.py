"""Helpers the operators share: inputs, staged tables, batches of bounded size, row ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow import session

# Rows of one Arrow batch: a batch of long documents must fit in a Python worker.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = session.scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str, last: bool = False
) -> DataFrame:
    """``mapInArrow`` with small batches. ``make`` runs once per task and returns the function of a batch; with
    ``last`` that is called once more, with None, when the task's rows are over."""
    ready(df.sparkSession)

    def run(batches):
        step = make()
        for batch in batches:
            yield from step(batch)
        if last:
            yield from step(None)

    return df.mapInArrow(run, schema)


def ready(spark: SparkSession) -> None:
    """Small batches, and this package on the path of Python workers that were started elsewhere."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def held_out(modulus: int):
    """True where crc32 of the decimal doc_id has remainder 2; a null id is learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 2, F.lit(False))


def part_offsets(counts: DataFrame, key: str, part: str, n: str) -> DataFrame:
    """Per key and part, how many rows of the key stand in smaller parts. One row per key and part comes in."""
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, part, F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long").alias("before"))


# Rows that one task sorts where rows are numbered.
SORTED_ROWS = 1 << 16


def ordered(df: DataFrame, keys: Sequence[str], label: str, rows: int = SORTED_ROWS) -> DataFrame:
    """A stored table of ``df``, which is one itself, with ``_part`` and ``_seq``: rows are range-partitioned by
    ``keys`` and numbered in each part in their order, parts in the order of the keys. Make the last key one that
    no two rows share: then no group of equal rows has to fit in one part."""
    parts = max(-(-df.count() // rows), df.sparkSession.sparkContext.defaultParallelism)
    numbered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_seq", F.monotonically_increasing_id())
    return stage(numbered.withColumn("_part", F.shiftright("_seq", 33).cast("int")), label)


def runs(table: DataFrame, group: Sequence[str]) -> DataFrame:
    """Of a table that is ``ordered`` by ``group`` and more, a row per part and group: ``_first`` number, ``_rows``, and
    ``_before``, the rows of the group in earlier parts. A row's place in its group is _before + _seq - _first."""
    counted = table.groupBy("_part", *group).agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
