"""Gold kept up to date from what is new in silver.

The state is a log of partial aggregates per customer and period. Clicks come as rows per session and per day, whose
clicks add up from run to run: the rows are the exact sets of sessions and days, spread however active a customer is.
Orders come as a row per month, replaced when one of its orders changes, because a deletion or correction can take a
minimum or maximum away. A run reads the batches that are new in the logs of clicks and orders, writes their
partial aggregates and their names together, brings the features of the customers in them up to date from the
state, takes over those of all others, and scores the customers.

A batch counts once: its name is in the state in the same commit. Features say up to which run of the state they go, so
a run that was cut off is made up for by the next. Compact the logs with the batches that are ``taken`` only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import at
from ..functions.scoring import churn_risk, rfm_segment
from ..operators import logs
from ..operators.sinks import move, resolve, store
from ..session import sized_shuffles
from ..streaming.clicks import shown_clicks
from ..streaming.orders import current_base
from .flows import Lake, publish_gold

_STATE = (
    "customer_id string, part string, value string, number long, clicks long, orders long, amount double, "
    "first_order timestamp, last_order timestamp, returned long"
)
_COLUMNS = tuple(column.split()[0] for column in _STATE.split(", "))
_PAIR = ("customer_id", "order_year", "order_month")


def _log(lake: Lake) -> str:
    return lake.name("gold_state_log")


def create_gold_state(spark: SparkSession, lake: Lake, root: str) -> None:
    """An empty state and its view, unless they are there."""
    logs.create(spark, _log(lake), _STATE, root)
    if not spark.catalog.tableExists(lake.name("gold_state")):
        _show(spark, lake, None, 0)


def _show(spark: SparkSession, lake: Lake, base: str | None, number: int) -> None:
    """Point the state at a compacted base and the runs after it."""
    columns = ", ".join(_COLUMNS)
    older = f"SELECT {columns} FROM {base} UNION ALL " if base else ""
    logs.change(
        spark,
        f"CREATE OR REPLACE VIEW {lake.name('gold_state')} TBLPROPERTIES ('number' = '{number}') AS "
        f"{older}SELECT {columns} FROM {_log(lake)} WHERE number > {number}",
    )


def _state(spark: SparkSession, lake: Lake) -> DataFrame:
    spark.catalog.refreshTable(_log(lake))
    return spark.table(lake.name("gold_state"))


def _last_run(spark: SparkSession, lake: Lake) -> int:
    runs = [int(b.rpartition("-")[2]) for b in logs.batches(spark, _log(lake))]
    return max([int(logs.properties(spark, lake.name("gold_state"))["number"]), *runs])


def taken(spark: SparkSession, lake: Lake, log: str) -> list[str]:
    """Batches of a log, of those that are in it now, that the state has."""
    names = logs.batches(spark, log)
    known = _state(spark, lake).filter((F.col("part") == f"taken {log}") & F.col("value").isin(names)).select("value")
    return sorted(r["value"] for r in known.collect())


# ---------------------------------------------------------------- partial aggregates


def _row(part: str | Column, value: Column, **figures: Column) -> list[Column]:
    """Columns of the state but for the number of the run."""
    types = dict(column.split() for column in _STATE.split(", "))
    made = {"customer_id": F.col("customer_id"), "part": F.lit(part) if isinstance(part, str) else part, "value": value, **figures}
    return [made.get(c, F.lit(None)).cast(types[c]).alias(c) for c in _COLUMNS if c != "number"]


def click_partials(clicks: DataFrame) -> DataFrame:
    """Clicks per customer and session, and per customer and day, of one scan."""
    keys = ["customer_id", "session_id", "event_date"]
    groups = clicks.groupingSets([keys[:2], [keys[0], keys[2]]], *keys).agg(
        F.count("event_id").alias("n"), (F.grouping("event_date") == 1).alias("of_session")
    )
    of_session = F.col("of_session")
    value = F.when(of_session, F.col("session_id")).otherwise(F.col("event_date").cast("string"))
    return groups.select(_row(F.when(of_session, "session").otherwise("day"), value, clicks=F.col("n")))


def order_partials(orders: DataFrame, pairs: DataFrame | None = None, returned: str = "RETURNED") -> DataFrame:
    """Orders per customer and month, of the ``pairs`` if given, which have a row each even without orders."""
    if pairs is not None:
        orders = pairs.join(orders, list(_PAIR), "left")
    sums = orders.groupBy(*_PAIR).agg(
        F.count("order_id").alias("orders"),
        F.sum("total_amount").alias("amount"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.count_if((F.col("status") == returned) & F.col("order_id").isNotNull()).alias("returned"),
    )
    if pairs is not None:
        sums = sums.withColumn("returned", F.when(F.col("orders") > 0, F.col("returned")))
    month = F.format_string("%04d-%02d", "order_year", "order_month")
    return sums.select(_row("month", month, **{c: F.col(c) for c in ("orders", "amount", "first_order", "last_order", "returned")}))


def merged(state: DataFrame) -> DataFrame:
    """The state with one row per customer, part and value: clicks added up, orders of the newest run.

    A run has one row of a customer's month at most, so the newest figures are taken one by one: they are then of
    fixed size and rows are hashed, where a struct of them would have the whole state sorted."""
    figures = ("orders", "amount", "first_order", "last_order", "returned")
    found = state.groupBy("customer_id", "part", "value").agg(
        F.max("number").alias("number"), F.sum("clicks").alias("clicks"), *(F.max_by(c, "number").alias(c) for c in figures)
    )
    return found.select(*_COLUMNS)


def features(state: DataFrame) -> DataFrame:
    """Features per customer of a state, as of no day: the recency comes with the score."""
    part, known = F.col("part"), F.col("value").isNotNull()
    has_clicks, orders = F.count_if(part == "session") > 0, F.sum("orders")
    return (
        merged(state.filter(part.isin("session", "day", "month")))
        .groupBy("customer_id")
        .agg(
            F.when(orders > 0, orders).alias("frequency"),
            F.when(orders > 0, F.round(F.sum("amount"), 2)).alias("monetary_value"),
            F.max("last_order").alias("last_order_date"),
            F.min("first_order").alias("first_order_date"),
            F.when(orders > 0, F.sum("returned")).alias("return_count"),
            F.when(has_clicks, F.sum(F.when(part == "session", F.col("clicks")))).alias("total_clicks"),
            F.when(has_clicks, F.count_if((part == "session") & known)).alias("total_sessions"),
            F.when(has_clicks, F.count_if((part == "day") & known)).alias("active_days"),
        )
    )


# ---------------------------------------------------------------- a run


def _touched_pairs(spark: SparkSession, table: str, view: str, names: Sequence[str]) -> DataFrame:
    """Customers and months that any known version of a changed order is in."""
    log = f"{table}_log"
    changed = logs.read(spark, log, names).select("order_id").distinct()
    versions = spark.table(log).select("order_id", *_PAIR).unionAll(spark.table(current_base(spark, view)).select("order_id", *_PAIR))
    return versions.join(changed, "order_id", "left_semi").filter("customer_id IS NOT NULL").select(*_PAIR).distinct()


def _new_partials(spark: SparkSession, lake: Lake, root: str, orders: tuple[str, str], clicks: str) -> DataFrame | None:
    """Partial aggregates of the batches the state does not have, with a row per batch; of everything for an empty
    state. None where nothing is new. Customers and months of changed orders are looked up once and stored."""
    (table, view), logged = orders, [f"{orders[0]}_log", f"{clicks}_log"]
    first = _last_run(spark, lake) == 0
    names = {log: sorted(set(logs.batches(spark, log)) - set(taken(spark, lake, log))) for log in logged}
    if not first and not any(names.values()):
        return None
    rows = [(log, f"taken {log}", name) for log in logged for name in names[log]]
    partials = spark.createDataFrame(rows, "customer_id string, part string, value string").select(_row(F.col("part"), F.col("value")))
    live = spark.table(view)
    if first:
        partials = partials.unionAll(order_partials(live)).unionAll(click_partials(shown_clicks(spark, clicks, names[logged[1]])))
        return partials
    if names[logged[0]]:
        path = logs.folder(root, "pairs")
        found = _touched_pairs(spark, table, view, names[logged[0]])
        found.write.parquet(path)
        pairs = spark.read.schema(found.schema).parquet(path)
        months = [tuple(r) for r in pairs.select(*_PAIR[1:]).distinct().collect()]  # as many as the table has partitions
        within = F.struct(*_PAIR[1:]).isin(*(F.struct(*(F.lit(v) for v in m)) for m in months)) if months else F.lit(False)
        partials = partials.unionAll(order_partials(live.filter(within), pairs))
    if names[logged[1]]:
        partials = partials.unionAll(click_partials(logs.read(spark, logged[1], names[logged[1]]).filter("kind = 'accepted'")))
    return partials


def run_gold_incremental(
    spark: SparkSession,
    lake: Lake,
    root: str,
    as_of: date,
    run_ts: datetime,
    orders: tuple[str, str] = ("orders_state", "silver_orders_live"),
    clicks: str = "silver_clicks",
) -> tuple[DataFrame, DataFrame]:
    """Profile and export from the state and what is new since the last run; one run at a time.

    What is read of silver are the new batches and, for corrected orders, the months they are in; of the state, the
    customers that are in the new batches. Publishing is that of a full run: stored, checked, moved together.
    """
    create_gold_state(spark, lake, root)
    log, name = _log(lake), lake.name("customer_features")
    sources = (lake.name(orders[0]), lake.name(orders[1])), lake.name(clicks)
    partials = _new_partials(spark, lake, root, *sources)
    if partials is not None:
        number = _last_run(spark, lake) + 1
        path = logs.folder(root, f"gold-{number:09d}")
        with sized_shuffles(spark, *(spark.table(f"{t}_log") for t in (sources[0][0], sources[1]))):
            partials.withColumn("number", F.lit(number).cast("long")).select(*_COLUMNS).write.parquet(path)
        logs.commit(spark, log, f"gold-{number:09d}", path)
    current = refresh_features(spark, lake, run_ts)
    totals = current.agg(F.coalesce(F.sum("frequency"), F.lit(0)).alias("orders"), F.coalesce(F.sum("total_clicks"), F.lit(0)).alias("clicks")).first()
    crm, customers = resolve(spark, lake.name("silver_customers"))
    joined = crm.join(current, "customer_id", "left").withColumn("recency_days", F.datediff(F.lit(as_of), "last_order_date"))
    columns = (
        *crm.columns, "recency_days", "frequency", "monetary_value", "last_order_date", "first_order_date", "return_count",
        "total_clicks", "total_sessions", "active_days",
    )
    profile = rfm_segment(churn_risk(joined.select(*columns))).withColumn("updated_at", at(run_ts))
    rows = {"orders": totals["orders"], "clicks": totals["clicks"], "crm": customers}
    with sized_shuffles(spark, crm, current):
        return publish_gold(spark, lake, profile, rows, run_ts)


def refresh_features(spark: SparkSession, lake: Lake, run_ts: datetime) -> DataFrame:
    """The features up to the last run of the state. Those of customers that no later run touched are taken over; where
    nothing is new, all are."""
    name, number, state = lake.name("customer_features"), _last_run(spark, lake), _state(spark, lake)
    known = spark.catalog.tableExists(name)
    done = int(logs.properties(spark, name)["source"]) if known else 0
    if known and done == number:
        return resolve_features(spark, name)
    if not known:
        fresh = features(state)
    else:
        touched = state.filter((F.col("number") > done) & F.col("part").isin("session", "day", "month")).select("customer_id").distinct()
        fresh = features(state.join(touched, "customer_id", "left_semi"))
        others = resolve_features(spark, name).join(touched, "customer_id", "left_anti")
        fresh = fresh.unionByName(others)
    with sized_shuffles(spark, state):
        version = store(fresh, name, run_ts, fmt=lake.fmt)
    move(spark, {name: version}, source=str(number))
    return spark.table(version)


def resolve_features(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(logs.properties(spark, name)["version"])


def compact_state(spark: SparkSession, lake: Lake) -> None:
    """Merge the runs of the state into one base. The state stays readable and the same between any two statements:
    the view that shows the base leaves out the runs that are in it."""
    names = logs.batches(spark, _log(lake))
    if not names:
        return
    number = _last_run(spark, lake)
    base = f"{lake.name('gold_state')}__{uuid.uuid4().hex}"
    merged(_state(spark, lake).filter(F.col("number") <= number)).write.format(lake.fmt).saveAsTable(base)
    _show(spark, lake, base, number)
    logs.forget(spark, _log(lake), [n for n in names if int(n.rpartition("-")[2]) <= number])
