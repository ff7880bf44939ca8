"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tierflow.functions.features import click_features, rfm_features
from tierflow.operators.dedup import dedup_latest
from tierflow.operators.quality import ORDER_RULES, evaluate
from tierflow.plans import flows, reports
from tierflow.sources import shapes

from .conftest import RUN_TS
from .plans import physical

SF = "/root/testdata/sf0.001"
LAZY = (
    "dedup_latest", "silver_orders", "silver_clickstream", "silver_crm", "cdc_latest_state", "crm_latest_snapshot",
    "dq_orders", "rfm_features", "click_features", "customer_features", "rfm_segment", "churn_cohort_counts",
    "top_customers_by_value", "silver_orders_quality", "monthly_revenue_trend", "segment_breakdown",
)


@pytest.fixture(scope="module")
def silver(spark):
    """A lake with published silver tables of the small data."""
    return entry_points._silver(spark, SF)


def _table(spark, silver, name):
    return spark.table(silver.name(f"silver_{name}"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(entry_points.queries()[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


def test_dedup_prunes_before_the_exchange(spark, silver):
    plan = physical(dedup_latest(_table(spark, silver, "orders"), ["order_id"], ["order_date"]))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_one_scan_of_the_given_tables(spark):
    plan = physical(shapes.bronze_orders(spark, SF, "UDNZBS")).split("\n\n")[0]
    assert plan.count("Scan parquet") == 1 and "Union" not in plan


def test_rfm_needs_one_exchange_on_unique_orders(spark, silver):
    orders = _table(spark, silver, "orders")
    one = physical(rfm_features(orders, dt.date(2001, 8, 1), unique_orders=True)).split("\n\n")[0]
    two = physical(rfm_features(orders, dt.date(2001, 8, 1))).split("\n\n")[0]
    assert (one.count("Exchange"), two.count("Exchange")) == (1, 2)


def test_features_read_only_their_columns(spark, silver):
    plan = physical(click_features(_table(spark, silver, "clicks")))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<event_id:string,customer_id:string,session_id:string>"]
    assert plan.split("\n\n")[0].count("Exchange") == 2


def test_filters_reach_the_scan(spark, silver):
    plan = physical(reports.top_customers_by_value(_table(spark, silver, "orders"), "COMPLETED"))
    assert "EqualTo(status,COMPLETED)" in plan and "TakeOrderedAndProject" in plan


def test_month_filter_prunes_partitions_through_the_view(spark, silver):
    plan = physical(reports.monthly_revenue_trend(_table(spark, silver, "orders").filter("order_year = 2000")))
    assert "order_year" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_rules_share_one_aggregate(spark, silver):
    tree = physical(evaluate(_table(spark, silver, "orders"), ORDER_RULES)).split("\n\n")[0]
    # One scan for all row rules, one of the key for uniqueness.
    assert tree.count("Scan parquet") == 2


def test_profile_joins_sorted_or_broadcast_by_size_only(spark, silver):
    tables = [_table(spark, silver, t) for t in ("customers", "orders", "clicks")]
    profile = flows.customer_profile(*tables, dt.date(2001, 8, 1), RUN_TS)
    assert "ResolvedHint" not in profile._jdf.queryExecution().analyzed().toString()
    tree = physical(profile).split("\n\n")[0]
    assert tree.count("LeftOuter") == 2 or tree.count("Join") == 2


def test_export_is_read_from_the_stored_profile(spark, silver):
    _, export = flows.run_gold(spark, silver, dt.date(2001, 8, 1), RUN_TS)
    plan = physical(spark.table(silver.name("profile_export")))
    assert "Join" not in plan and export.count() == spark.table(silver.name("customer_profile")).count()


def test_gold_run_is_four_jobs(spark, silver):
    """Write profile, check it, write export, check it; catalog commands start no job of their own."""
    from tierflow.operators import quality, sinks

    started = []
    collect, save = quality.gate, sinks._writer
    try:
        quality.gate = lambda *a, **k: started.append("check") or collect(*a, **k)
        sinks.gate = quality.gate
        sinks._writer = lambda *a, **k: started.append("write") or save(*a, **k)
        flows.run_gold(spark, silver, dt.date(2001, 8, 1), RUN_TS)
    finally:
        quality.gate, sinks.gate, sinks._writer = collect, collect, save
    assert started == ["write", "check", "write", "check"]


def test_shuffles_grow_with_the_input(spark):
    from tierflow.session import sized_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    big = spark.range(10**9).select("id", F.lit("x" * 10).alias("s"))
    with sized_shuffles(spark, big, big) as n:
        assert n > 100 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    with sized_shuffles(spark, spark.range(1)) as n:
        assert n == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
