from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tierflow.operators import quality as q
from tierflow.operators.sinks import publish, to_export
from tierflow.plans import flows
from tierflow.schemas import BRONZE_CLICKS, BRONZE_CRM, BRONZE_ORDER_CHANGES, EXPORT, Field

from .conftest import RUN_TS, rows

SILVER = "order_id string, customer_id string, order_date timestamp, total_amount double, status string"
NOW = dt.datetime(2024, 1, 1)
GOOD = [("1", "a", NOW, 1.0, "COMPLETED"), ("2", "b", NOW, 2.0, "RETURNED"), ("3", "b", NOW, 2.0, "PENDING")]


def _outcomes(report):
    return {(r["rule"], r["column"]): (r["outcome"], r["failing_rows"], r["total_rows"]) for r in report.collect()}


def test_good_orders_pass(spark):
    report = q.evaluate(spark.createDataFrame(GOOD, SILVER), q.ORDER_RULES)
    assert set(_outcomes(report).values()) == {("Passed", 0, 3)}
    assert len(_outcomes(report)) == len(q.ORDER_RULES)
    q.gate(report)


@pytest.mark.parametrize(
    "row, rule, failing",
    [
        ((None, "a", NOW, 1.0, "PENDING"), ("complete", "order_id"), 1),
        (("4", None, NOW, 1.0, "PENDING"), ("complete", "customer_id"), 1),
        (("4", "a", None, 1.0, "PENDING"), ("complete", "order_date"), 1),
        (("4", "a", NOW, 0.0, "PENDING"), ("above", "total_amount"), 1),
        (("4", "a", NOW, None, "PENDING"), ("above", "total_amount"), 1),
        (("3", "a", NOW, 1.0, "PENDING"), ("unique", "order_id"), 2),
        (("4", "a", NOW, 1.0, "\tPENDING"), ("one_of", "status"), 1),
        (("4", "a", NOW, 1.0, None), ("one_of", "status"), 1),
    ],
)
def test_each_rule_fails_alone(spark, row, rule, failing):
    report = q.evaluate(spark.createDataFrame([*GOOD, row], SILVER), q.ORDER_RULES)
    bad = {k: v for k, v in _outcomes(report).items() if v[0] == "Failed"}
    assert bad == {rule: ("Failed", failing, 4)}
    with pytest.raises(q.QualityError) as error:
        q.gate(report, "orders")
    assert len(error.value.report) == 6 and len(error.value.failed) == 1


def test_rule_options(spark):
    df = spark.createDataFrame([(None, 0.0)], "status string, value double")
    lenient = [q.OneOf("status", ("X",), nulls="pass"), q.Above("value", 0, inclusive=True), q.Unique("status")]
    assert {v[0] for v in _outcomes(q.evaluate(df, lenient)).values()} == {"Passed"}


def test_empty_table_passes(spark):
    report = q.evaluate(spark.createDataFrame([], SILVER), q.ORDER_RULES)
    assert set(_outcomes(report).values()) == {("Passed", 0, 0)}


def _bronze(spark, status="completed"):
    orders = [(str(i), "abc"[i % 3], "2024-01-02", 5.0, status, 1, "I") for i in range(9)]
    return spark.createDataFrame(orders, BRONZE_ORDER_CHANGES)


def test_refused_refresh_leaves_silver_and_keeps_the_report(spark, lake):
    flows.refresh_orders(lake, _bronze(spark), RUN_TS)
    before = rows(spark.table(lake.name("silver_orders")))
    with pytest.raises(q.QualityError):
        flows.refresh_orders(lake, _bronze(spark, "shipped"), RUN_TS + dt.timedelta(hours=1))
    assert rows(spark.table(lake.name("silver_orders"))) == before
    log = spark.table(lake.name("dq_results"))
    assert log.count() == 12
    assert rows(log.filter("outcome = 'Failed'"), "rule", "column", "failing_rows", "context") == [
        ("one_of", "status", 9, "orders-silver")
    ]


def test_a_repeated_run_replaces_its_report_and_others_stay(spark, lake):
    for status in ("shipped", "completed"):
        try:
            flows.refresh_orders(lake, _bronze(spark, status), RUN_TS)
        except q.QualityError:
            assert status == "shipped"
    log = spark.table(lake.name("dq_results"))
    assert log.count() == 6 and rows(log.select("outcome", "run_ts").distinct()) == [("Passed", RUN_TS)]


def test_reports_of_jobs_at_the_same_time_are_all_kept(spark, lake):
    data = spark.createDataFrame([("a",), (None,)], "email string")

    def job(i):
        for hour in range(3):
            run_ts = RUN_TS + dt.timedelta(hours=hour)
            q.record(q.evaluate(data, [q.Complete("email")], f"job-{i}", run_ts), lake.name("dq_results"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(job, range(4)))
    log = spark.table(lake.name("dq_results"))
    assert log.count() == log.select("context", "run_ts").distinct().count() == 12
    assert rows(log.select("outcome", "failing_rows").distinct()) == [("Failed", 1)]


def test_gold_report_is_kept(spark, lake):
    crm = spark.createDataFrame([("a", "f", "l", "a@x", "1", "VIP", "1", "2024-01-01", True, "2024-01-01")], BRONZE_CRM)
    clicks = spark.createDataFrame([("e", "a", "x", None, None, "s", "2024-01-02T00:00:00Z", None, None)], BRONZE_CLICKS)
    flows.run_silver(lake, _bronze(spark), clicks, crm, RUN_TS)
    flows.run_gold(spark, lake, dt.date(2024, 3, 1), RUN_TS)
    log = spark.table(lake.name("dq_results")).filter("context = 'profile'")
    got = {(r["rule"], r["column"]): (r["outcome"], r["failing_rows"], r["total_rows"]) for r in log.collect()}
    assert len(got) == 13 and {v[0] for v in got.values()} == {"Passed"}
    assert got["rows", "orders"] == ("Passed", 0, 9) and got["rows", "gold"] == ("Passed", 0, 1)
    assert got["null_rate", "email"] == ("Passed", 0, 1) and got["without", "clicks"] == ("Passed", 0, 1)


@pytest.mark.parametrize(
    "row, failed",
    [
        (("e1", "a", "x", None, None, "s", "2024-01-02T00:00:00Z", None, None), None),
        (("e1", "a", "x", None, None, "s", "whenever", None, None), "event_ts"),
        ((None, "a", "x", None, None, "s", "2024-01-02T00:00:00Z", None, None), "event_id"),
    ],
)
def test_click_gate(spark, lake, row, failed):
    bronze = spark.createDataFrame([row], BRONZE_CLICKS)
    if failed is None:
        flows.refresh_clicks(lake, bronze, RUN_TS)
        return
    with pytest.raises(q.QualityError) as error:
        flows.refresh_clicks(lake, bronze, RUN_TS)
    assert [r["column"] for r in error.value.failed] == [failed]


def test_crm_rules(spark, lake):
    crm = spark.createDataFrame([("a", "f", "l", "a@x", "1", "VIP", "-1", "2024-01-01", True, "2024-01-01")], BRONZE_CRM)
    flows.refresh_crm(lake, crm, RUN_TS)
    with pytest.raises(q.QualityError):
        flows.refresh_crm(lake, crm, RUN_TS, (*q.CRM_RULES, q.LIFETIME_VALUE_RULE))
    twice = spark.createDataFrame([("a", None), ("a", "m")], "customer_id string, email string")
    bad = {k for k, v in _outcomes(q.evaluate(twice, q.CRM_RULES)).items() if v[0] == "Failed"}
    assert bad == {("complete", "email"), ("unique", "customer_id")}


# ---------------------------------------------------------------- gold

GOLD = "customer_id string, email string, churn_risk string, rfm_segment string, frequency long, total_clicks long"


def _counts(spark, gold, crm_rows=2):
    return q.gold_counts(spark.createDataFrame(gold, GOLD), {"crm": crm_rows, "orders": 5, "clicks": 7})


def test_gold_counts(spark):
    counts = _counts(spark, [("a", None, "LOW", "x", None, 1), ("b", "m", "LOW", "x", 2, None)])
    assert counts.first().asDict() == {
        "orders_rows": 5, "clicks_rows": 7, "crm_rows": 2, "gold_rows": 2, "null_customer_id": 0, "null_email": 1,
        "null_churn_risk": 0, "null_rfm_segment": 0, "without_orders": 1, "without_clicks": 1,
    }
    assert rows(q.null_rates(counts), "column", "null_percent")[2] == ("email", 50.0)
    q.gate(q.validate_gold(counts))


@pytest.mark.parametrize(
    "gold, failed",
    [
        ([], "not_empty"),
        ([("a", "m", "LOW", "x", 1, 1)] * 3, "no_fanout"),
        ([(None, "m", "LOW", "x", 1, 1)], "complete_customer_id"),
    ],
)
def test_gold_gate(spark, gold, failed):
    counts = _counts(spark, gold)
    with pytest.raises(q.QualityError) as error:
        q.gate(q.validate_gold(counts))
    assert [r["check"] for r in error.value.failed] == [failed]
    assert q.null_rates(counts).count() == 4


def test_bad_profile_is_not_published(spark, lake):
    crm = spark.createDataFrame([("a", "f", "l", "a@x", "1", "VIP", "1", "2024-01-01", True, "2024-01-01")], BRONZE_CRM)
    clicks = spark.createDataFrame([("e", "a", "x", None, None, "s", "2024-01-02T00:00:00Z", None, None)], BRONZE_CLICKS)
    flows.run_silver(lake, _bronze(spark), clicks, crm, RUN_TS)
    flows.run_gold(spark, lake, dt.date(2024, 3, 1), RUN_TS)
    before = rows(spark.table(lake.name("customer_profile")))
    publish(spark.table(lake.name("silver_customers")).filter(F.lit(False)), lake.name("silver_customers"), RUN_TS)
    with pytest.raises(q.QualityError):
        flows.run_gold(spark, lake, dt.date(2024, 3, 1), RUN_TS)
    assert rows(spark.table(lake.name("customer_profile"))) == before


# ---------------------------------------------------------------- conformance


def _export(spark):
    values = ", ".join(f"CAST({'1' if f.type != 'timestamp' else 'NULL'} AS {f.type}) AS {f.name}" for f in EXPORT)
    return spark.sql(f"SELECT {values}")


def test_conformance(spark):
    good = _export(spark)
    q.gate(q.conformance(good, EXPORT))
    names = [f.name for f in EXPORT]
    broken = {
        "type": good.withColumn("frequency", F.lit(1).cast("long")),
        "order": good.select(*reversed(names)),
        "missing": good.drop("updated_at"),
        "extra": good.withColumn("more", F.lit(1)),
        "width": good.withColumn("churn_risk", F.lit("x" * 11)),
        "null": good.withColumn("customer_id", F.lit(None).cast("string")),
    }
    for name, df in broken.items():
        report = q.conformance(df, EXPORT)
        with pytest.raises(q.QualityError):
            q.gate(report, name)
    assert q.conformance(broken["extra"], EXPORT).count() == 18


def test_to_export_declares_types(spark):
    wide = _export(spark).select(*(F.col(f.name).cast("string") for f in reversed(EXPORT)))
    fields = [Field("frequency", "int"), Field("lifetime_value", "decimal(12,2)")]
    assert to_export(wide, fields).dtypes == [("frequency", "int"), ("lifetime_value", "decimal(12,2)")]
