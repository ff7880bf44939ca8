"""The four flows and their composition, as functions an external scheduler calls.

Every flow is a full refresh and idempotent: run twice with the same input it publishes the same
data twice. Orders can instead be kept up to date by ``streaming.orders``, under a name of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions.cleaning import at, clean_clicks, clean_crm, clean_orders
from ..functions.features import click_features, customer_features, rfm_features
from ..functions.scoring import churn_risk, rfm_segment
from ..operators import quality
from ..operators.sinks import (
    Check,
    conforms,
    create_database,
    dropped_on_error,
    move,
    publish,
    publish_bucketed,
    resolve,
    store,
    to_export,
)
from ..session import sized_shuffles
from ..sources.readers import CORRUPT, split_corrupt


@dataclass(frozen=True)
class Lake:
    """The database all published tables belong to, and their file format."""

    database: str
    fmt: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    @classmethod
    def create(cls, spark: SparkSession, database: str, location: str | None = None, fmt: str = "parquet") -> Lake:
        return cls(create_database(spark, database, location), fmt)


def _quality_check(lake: Lake, rules: Sequence[quality.Rule], context: str, run_ts: datetime) -> Check:
    """Evaluate on the staged rows, keep the report whatever it says, then let it pass or not. The number of rows
    that the report counted is noted on the version."""

    def check(staged: DataFrame) -> dict[str, int]:
        report = quality.record(quality.evaluate(staged, rules, context, run_ts), lake.name("dq_results"))
        quality.gate(report, context)
        line = report.first()
        return {"rows": line["total_rows"]} if line else {}

    return check


# ---------------------------------------------------------------- bronze to silver


def _set_aside(lake: Lake, bronze: DataFrame, rejects: str, context: str, run_ts: datetime, allowed: bool) -> DataFrame:
    """The rows that fitted the schema. The other lines are published as ``rejects`` and reported; unless
    ``allowed`` one of them stops the job."""
    if CORRUPT not in bronze.columns:
        return bronze
    good, corrupt = split_corrupt(bronze)
    kept = publish(corrupt, lake.name(rejects), run_ts, fmt=lake.fmt)
    report = quality.record(quality.evaluate(kept, [quality.Absent(CORRUPT)], context, run_ts), lake.name("dq_results"))
    if not allowed:
        quality.gate(report, context)
    return good


def refresh_orders(
    lake: Lake, bronze: DataFrame, run_ts: datetime, rules: Sequence[quality.Rule] = quality.ORDER_RULES
) -> DataFrame:
    silver = clean_orders(bronze, run_ts)
    check = _quality_check(lake, rules, "orders-silver", run_ts)
    with sized_shuffles(bronze.sparkSession, bronze):
        return publish(silver, lake.name("silver_orders"), run_ts, ["order_year", "order_month"], [check], lake.fmt)


def refresh_clicks(
    lake: Lake,
    bronze: DataFrame,
    run_ts: datetime,
    rules: Sequence[quality.Rule] = quality.CLICK_RULES,
    allow_corrupt: bool = True,
) -> DataFrame:
    """Lines that were no JSON are published as ``rejected_clicks`` and counted in the report."""
    bronze = _set_aside(lake, bronze, "rejected_clicks", "clicks-bronze", run_ts, allow_corrupt)
    silver = clean_clicks(bronze, run_ts)
    check = _quality_check(lake, rules, "clicks-silver", run_ts)
    with sized_shuffles(bronze.sparkSession, bronze):
        return publish(silver, lake.name("silver_clicks"), run_ts, ["event_date"], [check], lake.fmt)


def refresh_crm(
    lake: Lake,
    bronze: DataFrame,
    run_ts: datetime,
    rules: Sequence[quality.Rule] = quality.CRM_RULES,
    allow_corrupt: bool = False,
) -> DataFrame:
    """A line that does not parse may be a customer's newest version, without which an older one would be
    published; so by default it stops the refresh. All such lines are published as ``rejected_customers``."""
    bronze = _set_aside(lake, bronze, "rejected_customers", "crm-bronze", run_ts, allow_corrupt)
    silver = clean_crm(bronze, run_ts)
    check = _quality_check(lake, rules, "crm-silver", run_ts)
    with sized_shuffles(bronze.sparkSession, bronze):
        return publish(silver, lake.name("silver_customers"), run_ts, checks=[check], fmt=lake.fmt)


def run_silver(lake: Lake, orders: DataFrame, clicks: DataFrame, crm: DataFrame, run_ts: datetime) -> None:
    """All three silver tables; meant to run hourly."""
    refresh_orders(lake, orders, run_ts)
    refresh_clicks(lake, clicks, run_ts)
    refresh_crm(lake, crm, run_ts)


# ---------------------------------------------------------------- silver to gold


def customer_profile(
    crm: DataFrame,
    orders: DataFrame,
    clicks: DataFrame,
    as_of: date,
    run_ts: datetime,
    unique_orders: bool = True,
) -> DataFrame:
    """The profile of every CRM customer as of a day. Silver orders have passed the uniqueness rule;
    set ``unique_orders`` to False for orders that have not."""
    rfm = rfm_features(orders, as_of, unique_orders=unique_orders)
    features = customer_features(crm, rfm, click_features(clicks))
    return rfm_segment(churn_risk(features)).withColumn("updated_at", at(run_ts))


def run_gold(
    spark: SparkSession, lake: Lake, as_of: date, run_ts: datetime, orders_table: str = "silver_orders"
) -> tuple[DataFrame, DataFrame]:
    """Profile and typed export; meant to run daily.

    The silver tables are resolved once, so a silver refresh meanwhile does not mix versions, and read once: how many
    rows they have is noted on their versions. ``orders_table`` may be the live view of incremental orders.
    """
    names = {"orders": orders_table, "clicks": "silver_clicks", "crm": "silver_customers"}
    silver = {side: resolve(spark, lake.name(t)) for side, t in names.items()}
    orders, clicks, crm = (silver[side][0] for side in names)
    profile = customer_profile(crm, orders, clicks, as_of, run_ts)
    with sized_shuffles(spark, orders, clicks, crm):
        return publish_gold(spark, lake, profile, {side: rows for side, (_, rows) in silver.items()}, run_ts)


def publish_gold(
    spark: SparkSession, lake: Lake, profile: DataFrame, rows: Mapping[str, int], run_ts: datetime
) -> tuple[DataFrame, DataFrame]:
    """Four jobs: write the profile, check it, write the export from the stored profile, check that. Only then both
    views move, as the last two statements, so a value the export cannot hold keeps the old profile in place too.
    The report of the checks is kept in ``dq_results`` whatever it says."""

    def check(staged: DataFrame) -> None:
        report = quality.gold_report(quality.gold_counts(staged, rows), "profile", run_ts)
        quality.gate(quality.record(report, lake.name("dq_results")), "profile")

    gold_name, export_name = lake.name("customer_profile"), lake.name("profile_export")
    gold = store(profile, gold_name, run_ts, checks=[check], fmt=lake.fmt)
    with dropped_on_error(spark, gold):
        # Plain Parquet whatever the lake's own format is: the readers of the export know nothing else.
        export = store(to_export(spark.table(gold)), export_name, run_ts, checks=[conforms()])
    move(spark, {gold_name: gold, export_name: export}, source=gold)
    return spark.table(gold), spark.table(export)


# ---------------------------------------------------------------- gold to warehouse


def load_warehouse(spark: SparkSession, lake: Lake, buckets: int | None = None) -> DataFrame:
    """The bucketed warehouse table, replaced from the published export."""
    return publish_bucketed(spark, lake.name("profile_export"), lake.name("warehouse_profile"), buckets)
