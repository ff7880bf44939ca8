"""Incremental silver orders: a change log over a base, merged when read.

A batch of changes is written as it is, into a folder of its own: no key of the table is looked up and no month is
rewritten. The published name is a view that merges the base with the log, newest version first; what of the
base the log does not touch is read without an exchange. A compaction, run as often as reads are to stay cheap, folds
the log into the months it touches and moves the view, the one pointer there is, to the new base.

Between any two statements the view shows every order once: a log whose changes are in the base too merges to the
same rows, so neither a batch nor a compaction has a half-way state, and repeating one changes nothing.

Base and log keep the newest version of every order, also of orders that are deleted or unusable (``live`` is
false). An old change that arrives late therefore never brings back what a newer change replaced, and the result
equals a full refresh whatever the order of arrival.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import ORDER_TIES, at, conform_orders, usable_order
from ..operators import logs
from ..operators.dedup import dedup_latest
from ..operators.quality import ORDER_RULES, Rule, evaluate, gate
from ..operators.sinks import overwrite
from ..schemas import BRONZE_ORDER_CHANGES

PARTITIONS = ("live", "order_year", "order_month")
SILVER = (
    "order_id", "customer_id", "order_date", "total_amount", "status",
    "order_year", "order_month", "processed_at",
)
_STATE = (
    "order_id string, customer_id string, order_date timestamp, total_amount double, status string, "
    "seq long, op string, processed_at timestamp, live boolean, order_year int, order_month int"
)
_COLUMNS = tuple(column.split()[0] for column in _STATE.split(", "))
_PLACES = "live boolean, order_year int, order_month int, location string"


# ---------------------------------------------------------------- landed changes


def order_changes(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    schema: str | T.StructType | None = None,
    sequence: str = "seq",
    op_col: str = "op",
) -> DataFrame:
    """New change files below ``path``, in the types they have landed in: dates as timestamps or text, amounts as
    decimals or doubles, taken from one of the files unless ``schema`` is given. Sequence and kind of change, under the
    names given, may be missing, as in files of a full load; such a row loses to any change."""
    if schema is None:
        schema = _landed(spark, path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in ((sequence, T.LongType()), (op_col, T.StringType())) if n not in schema.names)])
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path).withColumns({"seq": F.col(sequence).cast("long"), "op": F.col(op_col).cast("string")})
    return rows.withColumn("order_date", F.col("order_date").cast("string"))


def _landed(spark: SparkSession, path: str) -> T.StructType:
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return T.StructType.fromDDL(BRONZE_ORDER_CHANGES)


def _as_state(changes: DataFrame, run_ts: datetime | None, delete_value: str) -> DataFrame:
    """Typed change rows with their verdict. Rejected rows without a date share partition 0 / 0."""
    typed = conform_orders(changes).filter(F.col("order_id").isNotNull())
    deleted = F.col("op").eqNullSafe(F.lit(delete_value))
    judged = typed.withColumn("live", F.coalesce(usable_order(), F.lit(False)) & ~deleted)

    def place(column: str):
        return F.when(F.col("live"), F.col(column)).otherwise(F.coalesce(F.col(column), F.lit(0)))

    return judged.withColumns(
        {"order_year": place("order_year"), "order_month": place("order_month"), "processed_at": at(run_ts)}
    ).select(*_COLUMNS)


def _newest(versions: DataFrame) -> DataFrame:
    """One row per order, as a full refresh picks it; of equal rows the one that was taken in first."""
    return dedup_latest(versions, ["order_id"], ["seq"], tie_break=[*ORDER_TIES, "op", F.col("processed_at").asc()])


# ---------------------------------------------------------------- base, log and view


def _log(table: str) -> str:
    return f"{table}_log"


def create_orders_table(spark: SparkSession, table: str, root: str, view: str) -> None:
    """The log ``<table>_log``, an empty base and the view of the live rows, unless they are there."""
    logs.create(spark, _log(table), _STATE, root)
    if not spark.catalog.tableExists(view):
        _show(spark, table, view, _new_base(spark, table, root, {}))


def current_base(spark: SparkSession, view: str) -> str:
    return logs.properties(spark, view)["base"]


def _new_base(spark: SparkSession, table: str, root: str, places: dict[tuple, str]) -> str:
    """A table of its own whose partitions are the given folders. Where they are is kept beside them, so the
    next compaction can take over those it does not touch."""
    base = f"{table}__{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(*p, where) for p, where in places.items()], _PLACES)
    rows.coalesce(1).write.parquet(f"{root}/places/{base}")
    spark.sql(f"CREATE TABLE {base} ({_STATE}) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{root}/base/{base}'")
    if places:
        spark.sql(f"ALTER TABLE {base} ADD " + " ".join(f"{_spec(p)} LOCATION '{where}'" for p, where in places.items()))
    return base


def _values(partition: Sequence) -> list[str]:
    return [f"{column}={str(value).lower()}" for column, value in zip(PARTITIONS, partition)]


def _spec(partition: Sequence) -> str:
    return f"PARTITION ({', '.join(_values(partition))})"


def _show(spark: SparkSession, table: str, view: str, base: str) -> None:
    """Point the view at a base, in one statement. Orders the log has are merged with their version in the base, the
    others come straight from it; both sides of a filter on the month prune the base."""
    log, silver = _log(table), ", ".join(SILVER)
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ("seq", *ORDER_TIES, "op"))
    state = ", ".join(_COLUMNS)
    logs.change(
        spark,
        f"""CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('base' = '{base}') AS
WITH changed AS (SELECT order_id FROM {log} GROUP BY order_id),
versions AS (
  SELECT {state} FROM {log}
  UNION ALL SELECT {state} FROM {base} b LEFT SEMI JOIN changed c ON b.order_id = c.order_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {newest}, processed_at ASC NULLS FIRST) AS rank FROM versions)
SELECT {silver} FROM {base} b LEFT ANTI JOIN changed c ON b.order_id = c.order_id WHERE live
UNION ALL SELECT {silver} FROM ranked WHERE rank = 1 AND live""",
    )


def _within(partitions: Sequence[Sequence]):
    """A partition filter: it names partition columns only, so the scan prunes with it."""
    return F.struct(*PARTITIONS).isin(*(F.struct(*(F.lit(v) for v in row)) for row in partitions))


# ---------------------------------------------------------------- batches and compaction


def append_changes(
    changes: DataFrame,
    table: str,
    root: str,
    run_ts: datetime | None,
    rules: Sequence[Rule] = ORDER_RULES,
    delete_value: str = "D",
    batch: str | None = None,
) -> None:
    """Add one batch of changes to the log: what is read and written is the batch, whatever the size of the table.

    The rules are checked on what was written, before it becomes visible; orders are unique by the merge. A batch that
    runs again, also after a compaction took it in, adds nothing new.
    """
    spark = changes.sparkSession
    name = batch or str(uuid.uuid4())
    path = logs.folder(root, name)
    _newest(_as_state(changes, run_ts, delete_value)).write.parquet(path)
    staged = spark.read.schema(_STATE).parquet(path)
    if staged.isEmpty():
        return
    gate(evaluate(staged.filter("live"), rules), f"orders {name}")
    logs.commit(spark, _log(table), name, path)


def compact_orders(
    spark: SparkSession, table: str, root: str, view: str, rules: Sequence[Rule] = ORDER_RULES, keep: int = 2,
    only: Sequence[str] | None = None,
) -> None:
    """Fold the batches that are in the log now into a new base, then move the view, then forget the batches.

    Only months that hold an order of the log, before or after, are written; the others are taken over as they are.
    This is the one place where keys of the base are looked up. One compaction at a time; batches may be
    added meanwhile and stay in the log. ``only`` names the batches that may be folded, where another job reads the
    log too. What comes to the driver are partition values and their folders.
    """
    names = [n for n in logs.batches(spark, _log(table)) if only is None or n in only]
    if not names:
        return
    old = current_base(spark, view)
    base, changes = spark.table(old), logs.read(spark, _log(table), names)
    held = base.select("order_id", *PARTITIONS).join(changes.select("order_id"), "order_id", "left_semi")
    touched = [tuple(r) for r in changes.select(*PARTITIONS).unionAll(held.select(*PARTITIONS)).distinct().collect()]
    merged = _newest(base.filter(_within(touched)).unionByName(changes))
    path = f"{root}/compacted/{uuid.uuid4().hex}"
    overwrite(merged, path, PARTITIONS)
    staged = spark.read.schema(merged.schema).parquet(path)
    gate(evaluate(staged.filter("live"), rules), f"orders {table}")
    filled = [tuple(r) for r in staged.select(*PARTITIONS).distinct().collect()]
    places = {tuple(r)[:3]: r["location"] for r in spark.read.schema(_PLACES).parquet(f"{root}/places/{old}").collect()}
    kept = {p: where for p, where in places.items() if p not in touched}
    new = _new_base(spark, table, root, kept | {p: f"{path}/{'/'.join(_values(p))}" for p in filled})
    _show(spark, table, view, new)
    logs.forget(spark, _log(table), names)
    _drop_old(spark, table, old, new, keep)


def _drop_old(spark: SparkSession, table: str, previous: str, current: str, keep: int) -> None:
    """Forget bases before the previous one, for queries that still plan with it; their files stay."""
    database, _, short = table.rpartition(".")
    found = spark.sql(f"SHOW TABLES{' IN ' + database if database else ''} LIKE '{short}__*'").collect()
    names = [f"{database}.{r.tableName}" if database else r.tableName for r in found]
    spared = {current.lower(), previous.lower()} if keep > 1 else {current.lower()}
    for name in names:
        if name.lower() not in spared:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def ingest_orders(
    source: DataFrame,
    table: str,
    root: str,
    checkpoint: str,
    run_ts: datetime | None = None,
    interval: str | None = None,
    rules: Sequence[Rule] = ORDER_RULES,
    append: Callable[..., None] = append_changes,
) -> StreamingQuery:
    """Start the stream from change files to the log. The checkpoint remembers which files were taken in;
    without ``interval`` the stream handles what is new and stops."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}

    def add(rows: DataFrame, number: int) -> None:
        append(rows, table, root, run_ts, rules=rules, batch=logs.batch_name(rows.sparkSession, number))

    return source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(**trigger).start()
