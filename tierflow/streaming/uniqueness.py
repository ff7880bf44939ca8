"""Uniqueness of a key over everything that was ever delivered, each run reading only what is new.

How often each key came is the state of a streaming count, on the executors' disks, so a micro-batch looks up its own
keys and reads no earlier row. What it writes is the new count of keys that now stand more than once, and the
number of all rows so far. Counts only grow, so the newest of a key is its largest: a batch that is repeated, or seen
both in its own folder and in a compacted one, changes no figure. The report equals that of the rule over all rows.
NULL keys are rows, but repeat nothing.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import logs
from ..operators.quality import Unique, unique_report

_ROWS, _KEY = "rows", "key"
_FOLDED = "folded-"


def create_counts(spark: SparkSession, log: str, root: str, key_type: str = "string") -> None:
    logs.create(spark, log, f"kind string, key {key_type}, n long", root)


def count_keys(source: DataFrame, rule: Unique, log: str, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Count the keys of the rows that are new; ``trigger`` is that of the stream, by default what is there."""
    kind = source.sparkSession.table(log).schema["key"].dataType
    line = lambda name, key: F.struct(F.lit(name).alias("kind"), key.cast(kind).alias("key"))
    lines = source.select(F.explode(F.array(line(_KEY, F.col(rule.column)), line(_ROWS, F.lit(None)))).alias("line"))
    # partial counts come before the exchange: a hot key, and the count of all rows, are one row per task
    counts = lines.groupBy("line.kind", "line.key").agg(F.count(F.lit(1)).alias("n"))

    def add(batch: DataFrame, number: int) -> None:
        name = logs.batch_name(batch.sparkSession, number)
        path = logs.folder(root, name)
        told = batch.filter((F.col("kind") == _ROWS) | F.col("key").isNotNull() & (F.col("n") > 1))
        told.select("kind", "key", "n").write.parquet(path)
        logs.commit(batch.sparkSession, log, name, path)

    stream = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(add)
    return stream.trigger(**(trigger or {"availableNow": True})).start()


def repeated_keys(spark: SparkSession, log: str) -> DataFrame:
    """``key, n`` of the keys that came more than once."""
    return _newest(spark.table(log)).filter(F.col("kind") == _KEY).select("key", "n")


def report(spark: SparkSession, log: str, rule: Unique, context: str | None = None, run_ts: datetime | None = None) -> DataFrame:
    """The rule's line over all rows counted so far, as ``evaluate`` gives it, for ``record`` and ``gate``."""
    figures = _newest(spark.table(log)).agg(
        F.sum(F.when(F.col("kind") == _KEY, F.col("n"))).alias("f"), F.max(F.when(F.col("kind") == _ROWS, F.col("n"))).alias("total")
    )
    return unique_report(figures, rule, context, run_ts)


def compact_counts(spark: SparkSession, log: str, root: str) -> None:
    """Fold the batches that no stream will repeat, and what was folded before, into one folder."""
    names = logs.batches(spark, log)
    old = sorted({*logs.settled([n for n in names if not n.startswith(_FOLDED)]), *(n for n in names if n.startswith(_FOLDED))})
    if len(old) < 2:
        return
    name = f"{_FOLDED}{uuid.uuid4().hex}"
    path = logs.folder(root, name)
    _newest(logs.read(spark, log, old)).write.parquet(path)
    logs.commit(spark, log, name, path)
    logs.forget(spark, log, old)


def _newest(lines: DataFrame) -> DataFrame:
    return lines.groupBy("kind", "key").agg(F.max("n").alias("n"))
