"""Incremental silver customers: only export files that are new are read.

Kept beside the published customers is the newest row of every customer, also of those that are unusable, so exports
may arrive in any order and the result equals a full refresh. A delivery is written once, merged with that state,
checked as stored, and then state and customers move. The checkpoint remembers which files were taken in, a log which
delivery they came with and the lines that did not parse. A delivery that is refused stays untaken and is read
again by the next run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import conform_crm
from ..operators import logs
from ..operators.dedup import latest_snapshot
from ..operators.quality import CRM_RULES, Absent, Rule, evaluate, gate, record
from ..operators.sinks import move, store
from ..plans.flows import Lake
from ..schemas import BRONZE_CRM
from ..sources.readers import CORRUPT

_COLUMNS = tuple(column.split()[0] for column in BRONZE_CRM.split(", "))
_STAGED = f"{BRONZE_CRM}, {CORRUPT} string, file string"
_LOG = f"kind string, file string, rows long, {CORRUPT} string"


def crm_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New export files below ``path``, with the file each row came in."""
    reader = (
        spark.readStream.schema(f"{BRONZE_CRM}, {CORRUPT} string")
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).withColumn("file", F.col("_metadata.file_path"))


def fold_exports(
    batch: DataFrame,
    lake: Lake,
    root: str,
    number: str,
    run_ts: datetime,
    rules: Sequence[Rule] = CRM_RULES,
    allow_corrupt: bool = False,
) -> None:
    """Merge one delivery into the customers. Repeating it changes nothing but the version."""
    spark = batch.sparkSession
    path = logs.folder(root, number)
    batch.select(*_COLUMNS, CORRUPT, "file").write.parquet(f"{path}/rows")
    staged = spark.read.schema(_STAGED).parquet(f"{path}/rows")
    if staged.isEmpty():
        return
    delivered = staged.groupBy(F.lit("file").alias("kind"), "file").agg(F.count(F.lit(1)).alias("rows")).withColumn(CORRUPT, F.lit(None).cast("string"))
    corrupt = staged.filter(F.col(CORRUPT).isNotNull()).select(F.lit("corrupt").alias("kind"), "file", F.lit(1).cast("long").alias("rows"), CORRUPT)
    delivered.unionByName(corrupt).write.parquet(f"{path}/log")
    lines = record(evaluate(staged, [Absent(CORRUPT)], "crm-bronze", run_ts), lake.name("dq_results"))
    if not allow_corrupt:
        gate(lines, "crm-bronze")

    def check(stored: DataFrame) -> dict[str, int]:
        report = record(evaluate(stored, rules, "crm-silver", run_ts), lake.name("dq_results"))
        gate(report, "crm-silver")
        return {"rows": report.first()["total_rows"]}

    state_name, name = lake.name("customers_state"), lake.name("silver_customers")
    versions = staged.filter(F.col(CORRUPT).isNull() & F.col("customer_id").isNotNull()).select(*_COLUMNS)
    if spark.catalog.tableExists(state_name):
        versions = versions.unionByName(spark.table(logs.properties(spark, state_name)["version"]))
    state = store(latest_snapshot(versions, ["customer_id"], "export_date"), state_name, run_ts, fmt=lake.fmt)
    customers = store(conform_crm(spark.table(state), run_ts), name, run_ts, checks=[check], fmt=lake.fmt)
    move(spark, {state_name: state, name: customers}, source=number)
    logs.commit(spark, lake.name("customer_deliveries"), number, f"{path}/log")


def ingest_crm(
    source: DataFrame,
    lake: Lake,
    root: str,
    checkpoint: str,
    run_ts: datetime,
    rules: Sequence[Rule] = CRM_RULES,
    allow_corrupt: bool = False,
) -> StreamingQuery:
    """Take in the export files that are new, then stop."""
    logs.create(source.sparkSession, lake.name("customer_deliveries"), _LOG, root)

    def fold(batch: DataFrame, number: int) -> None:
        fold_exports(batch, lake, root, logs.batch_name(batch.sparkSession, number), run_ts, rules, allow_corrupt)

    return source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fold).trigger(availableNow=True).start()
