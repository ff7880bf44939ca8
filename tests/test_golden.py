"""The decision tables and the single cases, row by row."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tierflow import session
from tierflow.functions.cleaning import clean_clicks, clean_crm, clean_orders
from tierflow.functions.features import click_features, customer_features, rfm_features
from tierflow.functions.scoring import churn_risk, rfm_segment
from tierflow.operators.sinks import to_export
from tierflow.plans import reports
from tierflow.plans.flows import customer_profile
from tierflow.schemas import BRONZE_CLICKS, BRONZE_CRM, BRONZE_ORDER_CHANGES

from .conftest import RUN_TS, rows

CHURN = [
    (91, 2, "HIGH"), (90, 2, "MEDIUM"), (91, 3, "MEDIUM"), (61, 4, "MEDIUM"), (61, 5, "LOW"), (60, 1, "LOW"),
    (None, None, "LOW"),
]

SEGMENTS = [
    ("VIP", "HIGH", 1, 200, "Champions"),
    ("Regular", "HIGH", 1, 200, "At Risk"),
    ("Regular", "LOW", 10, 5, "Loyal Customers"),
    ("Regular", "LOW", 9, 30, "Recent Customers"),
    ("Regular", "LOW", 9, 31, "Needs Attention"),
    ("Regular", "MEDIUM", 4, 70, "Needs Attention"),
    ("At-Risk", "LOW", 9, 31, "Needs Attention"),
    (None, "LOW", None, None, "Needs Attention"),
    ("VIP", "LOW", None, None, "Champions"),
]


def test_churn_risk(spark):
    df = spark.createDataFrame(CHURN, "recency_days int, frequency long, expected string")
    assert churn_risk(df).filter("churn_risk <> expected").count() == 0
    named = churn_risk(df, no_orders_label="NONE").filter("frequency is null")
    assert rows(named, "churn_risk") == [("NONE",)]
    stricter = churn_risk(df, high=(50, 10), medium=(10, 10)).filter("frequency is not null")
    assert rows(stricter.select("churn_risk").distinct()) == [("HIGH",)]


def test_rfm_segment(spark):
    df = spark.createDataFrame(SEGMENTS, "segment string, churn_risk string, frequency long, recency_days int, expected string")
    assert rfm_segment(df).filter("rfm_segment <> expected").count() == 0
    assert rfm_segment(df, vip="Regular", loyal_min=1).filter("rfm_segment = 'Champions'").count() == 5


def _orders(spark, data):
    return spark.createDataFrame(data, BRONZE_ORDER_CHANGES)


def test_newest_version_decides(spark):
    bronze = _orders(
        spark,
        [("1", "c", "2024-01-02", 5.0, "completed", 1, "I"), ("1", "c", "2024-01-02", -5.0, "completed", 2, "U")],
    )
    assert clean_orders(bronze, RUN_TS).count() == 0
    kept = clean_orders(bronze, RUN_TS, filter_first=F.col("total_amount") > 0)
    assert rows(kept, "order_id", "total_amount") == [("1", 5.0)]


def test_order_cleaning(spark):
    bronze = _orders(
        spark,
        [
            ("date", "c", "not-a-date", 5.0, " pending ", 1, "I"),
            ("tab", "c", "2024-01-02 03:04:05", 5.0, "\tcompleted", 1, "I"),
            ("zero", "c", "2024-01-02", 0.0, "completed", 1, "I"),
            ("none", "c", "2024-01-02", None, "completed", 1, "I"),
            (None, "c", "2024-01-02", 5.0, "completed", 1, "I"),
            ("nobody", None, "2024-01-02", 5.0, "completed", 1, "I"),
            ("gone", "c", "2024-01-02", 5.0, "completed", 1, "I"),
            ("gone", "c", "2024-01-02", 5.0, "completed", 2, "D"),
            ("moved", "c", "2024-01-31", 5.0, "completed", 1, "I"),
            ("moved", "c", "2024-02-01", 5.0, "completed", 2, "U"),
        ],
    )
    silver = clean_orders(bronze, RUN_TS)
    assert silver.columns == [
        "order_id", "customer_id", "order_date", "total_amount", "status", "order_year", "order_month", "processed_at",
    ]
    assert rows(silver, "order_id", "status", "order_year", "order_month") == [
        ("date", "PENDING", None, None),
        ("moved", "COMPLETED", 2024, 2),
        ("tab", "\tCOMPLETED", 2024, 1),
    ]
    assert rows(silver.select("processed_at").distinct()) == [(RUN_TS,)]


def test_amount_as_text_or_decimal(spark):
    text = spark.sql("SELECT '1' order_id, 'c' customer_id, '2024-01-02' order_date, '12.5' total_amount, 'completed' status")
    assert rows(clean_orders(text, RUN_TS), "total_amount") == [(12.5,)]
    odd = text.withColumn("total_amount", F.lit("12,5"))
    assert clean_orders(odd, RUN_TS).count() == 0
    typed = text.withColumns(
        {"total_amount": F.col("total_amount").cast("decimal(10,2)"), "order_date": F.col("order_date").cast("timestamp")}
    )
    assert rows(clean_orders(typed, RUN_TS), "total_amount", "order_month") == [(12.5, 1)]


def _click(event_id, timestamp, customer="c", kind="search", session="s"):
    return (event_id, customer, kind, "/home", "p", session, timestamp, "mobile", "CA")


def test_click_time_is_utc(spark):
    bronze = spark.createDataFrame(
        [
            _click("z", "2024-01-02T02:30:00Z"),
            _click("offset", "2024-01-02T23:30:00.123456-02:00"),
            _click("bad", "soon"),
        ],
        BRONZE_CLICKS,
    )
    silver = clean_clicks(bronze, RUN_TS)
    assert rows(silver, "event_id", "event_date", "event_hour") == [
        ("bad", None, None),
        ("offset", dt.date(2024, 1, 3), 1),
        ("z", dt.date(2024, 1, 2), 2),
    ]


def test_another_zone_is_refused(spark):
    bronze = spark.createDataFrame([_click("z", "2024-01-02T02:30:00Z")], BRONZE_CLICKS)
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        with pytest.raises(ValueError, match="Toronto"):
            clean_clicks(bronze, RUN_TS)
    finally:
        session.pin(spark)
    assert rows(clean_clicks(bronze, RUN_TS), "event_hour") == [(2,)]


def test_first_delivery_wins(spark):
    bronze = spark.createDataFrame(
        [
            _click("1", "2024-01-02T03:00:00Z", kind="late"),
            _click("1", "2024-01-02T02:00:00Z", kind="early"),
            _click("2", "never", kind="untimed"),
            _click("2", "2024-01-02T02:00:00Z", kind="timed"),
            _click("3", "2024-01-02T02:00:00Z", kind=None),
            _click("3", "2024-01-02T03:00:00Z", kind="second"),
        ],
        BRONZE_CLICKS,
    )
    assert rows(clean_clicks(bronze, RUN_TS), "event_id", "event_type") == [("1", "early"), ("2", "timed")]


def _crm(spark, data):
    full = [(c, "F", "L", mail, "1", seg, value, contact, True, day) for c, mail, seg, value, contact, day in data]
    return spark.createDataFrame(full, BRONZE_CRM)


def test_crm_cleaning(spark):
    bronze = _crm(
        spark,
        [
            ("a", " A@X.com ", "Regular", "1.5", "2024-01-01", "2024-02-01"),
            ("a", " A@Y.com ", "VIP", "bad", "once", "2024-02-02"),
            ("b", None, "VIP", "1", "2024-01-01", "2024-02-02"),
            (None, "n@x", "VIP", "1", "2024-01-01", "2024-02-02"),
            ("c", "c@x", "At-Risk", "-2", "2024-01-01", "2024-02-01"),
        ],
    )
    silver = clean_crm(bronze, RUN_TS)
    assert rows(silver, "customer_id", "email", "segment", "lifetime_value", "last_contact_date") == [
        ("a", "a@y.com", "VIP", None, None),
        ("c", "c@x", "At-Risk", -2.0, dt.date(2024, 1, 1)),
    ]


@pytest.fixture
def silver(spark):
    orders = clean_orders(
        _orders(
            spark,
            [
                ("1", "a", "2024-01-02", 5.006, "completed", 1, "I"),
                ("2", "a", "2024-02-20 12:00:00", 7.0, "returned", 1, "I"),
                ("3", "b", "2024-01-02", 1e11, "completed", 1, "I"),
                ("4", "stranger", "2024-01-02", 1.0, "completed", 1, "I"),
            ],
        ),
        RUN_TS,
    )
    clicks = clean_clicks(
        spark.createDataFrame(
            [
                _click("1", "2024-01-02T02:30:00Z", "a", session="s"),
                _click("2", "2024-01-02T02:31:00Z", "a", session="s"),
                _click("3", "2024-01-03T02:31:00Z", "a", session="s"),
                _click("4", "2024-01-03T02:31:00Z", "a", session=None),
            ],
            BRONZE_CLICKS,
        ),
        RUN_TS,
    )
    crm = clean_crm(_crm(spark, [(c, f"{c}@x", "New", "1", "2024-01-01", "2024-02-01") for c in "abc"]), RUN_TS)
    return crm, orders, clicks


def test_features(silver):
    crm, orders, clicks = silver
    as_of = dt.date(2024, 3, 1)
    for unique in (True, False):
        rfm = rfm_features(orders, as_of, unique_orders=unique)
        assert rows(rfm, "customer_id", "recency_days", "frequency", "monetary_value", "return_count") == [
            ("a", 10, 2, 12.01, 1), ("b", 59, 1, 1e11, 0), ("stranger", 59, 1, 1.0, 0),
        ]
    for approximate in (True, False):
        assert rows(click_features(clicks, approximate)) == [("a", 4, 1, 2)]
    wide = customer_features(crm, rfm, click_features(clicks))
    assert rows(wide, "customer_id", "frequency", "return_count", "total_clicks") == [
        ("a", 2, 1, 4), ("b", 1, 0, None), ("c", None, None, None),
    ]


def test_profile_columns(silver):
    crm, orders, clicks = silver
    profile = customer_profile(crm, orders, clicks, dt.date(2024, 3, 1), RUN_TS)
    assert profile.columns == crm.columns + [
        "recency_days", "frequency", "monetary_value", "last_order_date", "first_order_date", "return_count",
        "total_clicks", "total_sessions", "active_days", "churn_risk", "rfm_segment", "updated_at",
    ]
    assert len(profile.columns) == 23
    assert profile.schema["return_count"].dataType.typeName() == "long"


def test_decimal_overflow_stops_the_export(silver):
    crm, orders, clicks = silver
    profile = customer_profile(crm, orders, clicks, dt.date(2024, 3, 1), RUN_TS)
    with pytest.raises(ArithmeticException):
        to_export(profile).collect()
    assert to_export(profile.filter("customer_id <> 'b'")).count() == 2


def test_events_of_one_day(spark):
    bronze = spark.createDataFrame(
        [_click("1", "2024-01-02T02:30:00Z"), _click("2", "2024-01-03T02:30:00Z"), _click("3", "?")], BRONZE_CLICKS
    )
    day = dt.date(2024, 1, 2)
    assert rows(reports.event_counts_by_type(bronze, day)) == [("search", 1)]
    assert rows(reports.event_counts_by_type(clean_clicks(bronze, RUN_TS), day)) == [("search", 1)]
    assert rows(reports.event_counts_by_type(bronze)) == [("search", 3)]


def test_sketches_of_any_range_of_days_merge(spark):
    from datetime import date

    from tierflow.functions import features

    clicks = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("customer_id"),
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("s"), (F.col("id") % 20011))).alias("session_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int")).alias("event_date"),
    )
    daily = features.daily_sessions(clicks)
    for first, last in ((None, None), (date(2024, 1, 5), date(2024, 1, 20)), (None, date(2024, 1, 1))):
        within = clicks.filter((F.col("event_date") >= (first or date(2024, 1, 1))) & (F.col("event_date") <= (last or date(2024, 12, 31))))
        want = {r["customer_id"]: r for r in features.click_features(within).collect()}
        got = {r["customer_id"]: r for r in features.sketched_click_features(daily, first, last).collect()}
        assert set(got) == set(want)
        for c, r in got.items():
            assert (r["total_clicks"], r["active_days"]) == (want[c]["total_clicks"], want[c]["active_days"])
            assert abs(r["total_sessions"] - want[c]["total_sessions"]) <= features.SKETCH_BOUND * want[c]["total_sessions"] + 0.5


@pytest.mark.parametrize(
    "report, by, newest_first",
    [
        ("monthly_revenue_trend", ["order_year", "order_month"], True),
        ("event_counts_by_type", ["event_count"], True),
        ("late_clicks", ["event_date"], False),
    ],
)
def test_sorted_reports_come_in_their_order(spark, report, by, newest_first):
    import __spark_entry__ as entry_points

    found = entry_points.queries()[report](spark, "/root/testdata/sf0.001").collect()
    keys = [tuple(r[c] for c in by) for r in found]
    assert len(set(keys)) > 1 and keys == sorted(keys, reverse=newest_first)
