"""Clickstream ingestion as a stream: bad rows set aside, no event twice, every delivered row counted.

Event ids seen so far are the state of the stream's dedup, in RocksDB: a micro-batch looks up its own ids and writes a
log of what changed, however many there are. Nothing of the published table is read. A row that breaks a rule
keeps its reason; identical copies of such a row are duplicates like those of an event.

Each micro-batch is one folder of a log: accepted rows, rejected rows and the report of the rules become visible
with one statement, under the id of the batch. Views show the three kinds. A compaction folds batches into a base
with a partition per day. The progress of every micro-batch (rows delivered, duplicates, lateness, state) is a
table too, so that accepted + rejected + duplicates = delivered can be checked at any time.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.cleaning import at
from ..operators import logs
from ..operators.quality import CLICK_RULES, Absent, Complete, Rule, evaluate, gate
from ..session import require_utc
from ..schemas import BRONZE_CLICKS
from ..sources.readers import CORRUPT, click_schema

# How often and how much the delivery writes.
FLUSH_INTERVAL = "60 seconds"
FLUSH_BYTES = 5 * 1024 * 1024

_BRONZE = tuple(column.split()[0] for column in BRONZE_CLICKS.split(", "))
SILVER = (*_BRONZE, "event_ts", "event_date", "event_hour", "processed_at")
REJECTED = (*_BRONZE, "processed_at", "reason", CORRUPT)
REPORT = ("rule", "column", "outcome", "failing_rows", "total_rows", "processed_at")
_ROWS = (
    f"{BRONZE_CLICKS}, event_ts timestamp, event_hour int, processed_at timestamp, reason string, {CORRUPT} string, "
    "rule string, column string, outcome string, failing_rows long, total_rows long"
)
_LOG = f"kind string, event_date date, {_ROWS}"
_NO_DAY = "1970-01-01"  # partition of rows without a day: rejected rows and reports
VIEWS = {"accepted": ("", SILVER), "rejected": ("_rejected", REJECTED), "report": ("_report", REPORT)}
_PROGRESS = (
    "query string, batch long, started timestamp, delivered long, duplicates long, late_rows long, "
    "max_lateness_hours double, state_rows long, state_reads long"
)
# What the rules say of a row, in the order they are looked at; the others need more than one row.
_RULES = (Absent(CORRUPT), *(r for r in CLICK_RULES if isinstance(r, Complete)))


def click_source(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    folders: bool = True,
) -> DataFrame:
    """New click files below ``path``; at most ``max_files`` or about ``max_bytes`` per micro-batch."""
    reader = spark.readStream.schema(click_schema(folders)).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


# ---------------------------------------------------------------- tables


def create_click_tables(spark: SparkSession, name: str, root: str) -> None:
    """Log, base and progress of the published table ``name``, and its views ``name``, ``name_rejected`` and
    ``name_report``, unless they are there."""
    logs.create(spark, f"{name}_log", _LOG, root)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name}_base ({_ROWS}, kind string, event_date date, fold int) USING parquet "
        f"PARTITIONED BY (kind, event_date, fold) LOCATION '{root}/base'"
    )
    spark.createDataFrame([], _PROGRESS).write.mode("append").parquet(f"{root}/progress")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_progress ({_PROGRESS}) USING parquet LOCATION '{root}/progress'")
    if not spark.catalog.tableExists(name):
        for kind in VIEWS:
            _show(spark, name, kind, 0, [])
    elif "fold" not in logs.properties(spark, name):
        raise ValueError(f"{name} is published by full refreshes")


def _show(spark: SparkSession, name: str, kind: str, fold: int, folded: Sequence[str]) -> None:
    """Point a view at the base up to ``fold`` and the batches of the log that are not ``folded`` into it."""
    suffix, columns = VIEWS[kind]
    picked = ", ".join(f"`{c}`" for c in columns)
    others = f" AND batch NOT IN ({', '.join(repr(b) for b in folded)})" if folded else ""
    logs.change(
        spark,
        f"CREATE OR REPLACE VIEW {name}{suffix} TBLPROPERTIES ('fold' = '{fold}') AS "
        f"SELECT {picked} FROM {name}_base WHERE kind = '{kind}' AND fold <= {fold} "
        f"UNION ALL SELECT {picked} FROM {name}_log WHERE kind = '{kind}'{others}",
    )


# ---------------------------------------------------------------- the stream


def judged(raw: DataFrame) -> DataFrame:
    """Every delivered row with its instant, the first rule it breaks, and what a copy of it has in common with it: the
    event id, or of a row that is rejected all it says."""
    require_utc(raw.sparkSession)
    timed = raw.withColumn("event_ts", F.try_to_timestamp(F.col("timestamp")))
    reason = F.coalesce(*(F.when(rule.fails(), "corrupt" if rule.column == CORRUPT else rule.column) for rule in _RULES))
    said = F.sha2(F.to_json(F.struct(*_BRONZE, CORRUPT)), 256)
    marked = timed.withColumn("reason", reason)
    return marked.withColumn("copy_key", F.when(F.col("reason").isNull(), F.concat(F.lit("e"), F.col("event_id"))).otherwise(F.concat(F.lit("r"), said)))


def _lateness() -> Column:
    """Hours between a click and its micro-batch."""
    return (F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.col("event_ts"))) / 3600.0


def once(rows: DataFrame, late_hours: float) -> DataFrame:
    """Judged rows without those seen before; what was delivered is observed on the way."""
    good, hours = F.col("reason").isNull(), _lateness()
    watched = rows.observe(
        "clicks",
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(good & (hours > late_hours)).alias("late_rows"),
        F.max(F.when(good, hours)).alias("max_lateness_hours"),
    )
    return watched.dropDuplicates(["copy_key"])


def append_batch(
    batch: DataFrame, name: str, root: str, number: str, run_ts: datetime | None = None, files: int | None = None,
    rules: Sequence[Rule] = CLICK_RULES,
) -> None:
    """Write one micro-batch, check it as written, and show it: accepted and rejected rows and the report at once. The
    plan of the stream runs once. A batch that is there already, from a run that was cut off, stays as it is."""
    spark = batch.sparkSession
    path = logs.folder(root, number)
    good = F.col("reason").isNull()
    rows = batch.select(
        F.when(good, "accepted").otherwise("rejected").alias("kind"),
        F.when(good, F.to_date("event_ts")).alias("event_date"),
        *_BRONZE,
        "event_ts",
        F.hour("event_ts").alias("event_hour"),
        at(run_ts).alias("processed_at"),
        "reason",
        CORRUPT,
    )
    (rows if files is None else rows.repartition(files)).write.parquet(path)
    staged = spark.read.schema(_LOG).parquet(path)
    if staged.isEmpty():
        return
    gate(evaluate(staged.filter("kind = 'accepted'"), rules), f"clicks {number}")
    report = evaluate(staged, _RULES).select(F.lit("report").alias("kind"), "*", at(run_ts).alias("processed_at"))
    report.coalesce(1).write.mode("append").parquet(path)
    logs.commit(spark, f"{name}_log", number, path)


def ingest_clicks(
    raw: DataFrame,
    name: str,
    root: str,
    checkpoint: str,
    run_ts: datetime | None = None,
    interval: str | None = None,
    files_per_batch: int | None = None,
    late_hours: float = 24.0,
) -> StreamingQuery:
    """Start the stream from bronze files to the click tables.

    Without ``interval`` it takes what is there and stops; ``FLUSH_INTERVAL`` and a source of ``FLUSH_BYTES`` give the
    delivery's own policy, and ``files_per_batch`` the files of a flush. State is spread over as many partitions as
    a shuffle has when the checkpoint is made.
    """
    spark = raw.sparkSession
    create_click_tables(spark, name, root)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}

    def add(batch: DataFrame, number: int) -> None:
        append_batch(batch, name, root, logs.batch_name(batch.sparkSession, number), run_ts, files_per_batch)

    stream = once(judged(raw), late_hours).writeStream.foreachBatch(add)
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()


# ---------------------------------------------------------------- progress


class Progress(StreamingQueryListener):
    """Writes a row of the progress table after every micro-batch of click streams.

    >>> with Progress(spark, name, root) as progress:
    ...     progress.finish(ingest_clicks(...))
    """

    def __init__(self, spark: SparkSession, name: str, root: str) -> None:
        self.spark, self.name, self.path = spark, name, f"{root}/progress"
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def finish(self, query: StreamingQuery, timeout: float = 120.0) -> None:
        """Wait for the stream to end and for its last row."""
        ended = self.ended.setdefault(str(query.runId), threading.Event())
        query.awaitTermination()
        if not ended.wait(timeout):
            raise TimeoutError(f"no end of {query.runId} was reported")
        self.spark.catalog.refreshTable(f"{self.name}_progress")

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("clicks")
        if seen is None or not seen["delivered"]:
            return
        state = p.stateOperators[0]
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc).replace(tzinfo=None)
        metrics = state.customMetrics
        row = (
            str(p.id), p.batchId, started, seen["delivered"], metrics.get("numDroppedDuplicateRows", 0),
            seen["late_rows"], seen["max_lateness_hours"], state.numRowsTotal, metrics.get("rocksdbGetCount", 0),
        )
        self.spark.createDataFrame([row], _PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()


def balance(spark: SparkSession, name: str) -> DataFrame:
    """``outcome, rows``: delivered rows by what became of them; the others add up to ``delivered``. A micro-batch that
    was repeated has two rows of progress and counts once."""
    spark.catalog.refreshTable(f"{name}_progress")
    batches = spark.table(f"{name}_progress").groupBy("query", "batch").agg(F.max("delivered").alias("delivered"), F.max("duplicates").alias("duplicates"))
    progress = batches.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("delivered", "duplicates")))
    measured = progress.selectExpr("stack(2, 'delivered', delivered, 'duplicate', duplicates) AS (outcome, rows)")
    accepted = spark.table(name).agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("rows"))
    reasons = spark.table(f"{name}_rejected").groupBy(F.concat(F.lit("rejected: "), F.col("reason")).alias("outcome"))
    return measured.unionAll(accepted).unionAll(reasons.agg(F.count(F.lit(1)).alias("rows")))


def shown_clicks(spark: SparkSession, name: str, names: Sequence[str]) -> DataFrame:
    """Accepted clicks of the base and of the named batches of the log."""
    fold = int(logs.properties(spark, name)["fold"])
    base = spark.table(f"{name}_base").filter((F.col("kind") == "accepted") & (F.col("fold") <= fold))
    return base.select(*SILVER).unionAll(logs.read(spark, f"{name}_log", names).filter("kind = 'accepted'").select(*SILVER))


# ---------------------------------------------------------------- compaction


def compact_clicks(spark: SparkSession, name: str, root: str, only: Sequence[str] | None = None) -> None:
    """Fold the batches that are in the log now into the base: their rows are written once more, by kind and day, and
    nothing that is in the base already. The new partitions are hidden until a view names their fold, and a view
    that does leaves the folded batches out, so each view shows every row once at any time. The newest batch of a
    stream stays, as the stream may repeat it. ``only`` names the batches that may be folded, where another job reads
    the log too. One compaction at a time."""
    log, base = f"{name}_log", f"{name}_base"
    fold = _finish_views(spark, name)
    names = [n for n in logs.settled(logs.batches(spark, log)) if only is None or n in only]
    if not names:
        return
    _clear(spark, base, fold)
    path = f"{root}/compacted/{uuid.uuid4().hex}"
    rows = logs.read(spark, log, names).withColumn("event_date", F.coalesce("event_date", F.lit(_NO_DAY).cast("date")))
    rows.hint("rebalance", "kind", "event_date").write.partitionBy("kind", "event_date").parquet(path)
    days = spark.read.parquet(path).select("kind", "event_date").distinct().collect()
    added = " ".join(
        f"PARTITION (kind = '{d.kind}', event_date = '{d.event_date}', fold = {fold + 1}) LOCATION '{path}/kind={d.kind}/event_date={d.event_date}'"
        for d in days
    )
    logs.change(spark, f"ALTER TABLE {base} ADD {added}")
    spark.catalog.refreshTable(base)
    for kind in reversed(VIEWS):
        _show(spark, name, kind, fold + 1, names)
    logs.forget(spark, log, names)


def _finish_views(spark: SparkSession, name: str) -> int:
    """The fold the views show. After a compaction that was cut off when it had moved some of them, the others are moved
    too and what it folded is forgotten."""
    folds = {kind: int(logs.properties(spark, f"{name}{suffix}")["fold"]) for kind, (suffix, _) in VIEWS.items()}
    newest = max(folds.values())
    if newest == 0:
        return 0
    done = next(kind for kind, fold in folds.items() if fold == newest)
    text = spark.sql(f"SHOW CREATE TABLE {name}{VIEWS[done][0]}").first()[0]
    folded = [b for b in logs.batches(spark, f"{name}_log") if f"'{b}'" in text]
    for kind, fold in folds.items():
        if fold < newest:
            _show(spark, name, kind, newest, folded)
    logs.forget(spark, f"{name}_log", folded)
    return newest


def _clear(spark: SparkSession, base: str, fold: int) -> None:
    """Forget partitions of a fold that no view came to show."""
    hidden = [r.partition for r in spark.sql(f"SHOW PARTITIONS {base}").collect() if int(r.partition.rpartition("=")[2]) > fold]
    specs = [", ".join(f"{k} = '{v}'" for k, v in (part.split("=") for part in p.split("/"))) for p in hidden]
    if specs:
        logs.change(spark, f"ALTER TABLE {base} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))
        spark.catalog.refreshTable(base)
