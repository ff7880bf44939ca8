"""Ready-made reports. Each takes the table it reports on, whatever its layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_customers_by_value(orders: DataFrame, status: str = "completed", limit: int = 10) -> DataFrame:
    """Customers with the highest spend in one order state. Bronze spells states in lower case,
    silver in upper case. Equal spend is ordered by customer."""
    return (
        orders.filter(F.col("status") == status)
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("total_orders"), F.round(F.sum("total_amount"), 2).alias("total_spent"))
        .orderBy(F.desc_nulls_last("total_spent"), F.asc_nulls_last("customer_id"))
        .limit(limit)
    )


def event_counts_by_type(clicks: DataFrame, event_date: date | None = None) -> DataFrame:
    """Events per type, of all days or of one. Bronze clicks are dated by their time stamp text."""
    if event_date is not None:
        if "event_date" in clicks.columns:
            day = F.col("event_date")
        else:
            day = F.to_date(F.try_to_timestamp(F.col("timestamp")))
        clicks = clicks.filter(day == F.lit(event_date))
    counts = clicks.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    return counts.orderBy(F.desc("event_count"), F.asc_nulls_last("event_type"))


def customers_by_segment(crm: DataFrame) -> DataFrame:
    """Rows and mean lifetime value per CRM segment; values that are not numbers count as missing."""
    value = F.col("lifetime_value").try_cast("double")
    counts = crm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.round(F.avg(value), 2).alias("avg_lifetime_value")
    )
    return counts.orderBy(F.desc("customer_count"), F.asc_nulls_last("segment"))


def silver_orders_quality(orders: DataFrame) -> DataFrame:
    """One row: rows, distinct orders and customers, missing amounts and dates.

    Each distinct count is its own narrow scan of one column; counting both at once would send every
    row through the exchange three times over.
    """
    parts = orders.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("total_amount").isNull()).alias("null_amounts"),
        F.count_if(F.col("order_date").isNull()).alias("null_dates"),
    )
    for column, name in (("order_id", "unique_orders"), ("customer_id", "unique_customers")):
        distinct = orders.select(column).distinct().agg(F.count(column).alias(name))
        parts = parts.unionByName(distinct, allowMissingColumns=True)
    names = ("total_rows", "unique_orders", "unique_customers", "null_amounts", "null_dates")
    return parts.agg(*(F.max(n).alias(n) for n in names))


def monthly_revenue_trend(orders: DataFrame) -> DataFrame:
    """Orders and revenue per month, newest first; groups on the partition columns."""
    months = orders.groupBy("order_year", "order_month").agg(
        F.count("order_id").alias("order_count"), F.round(F.sum("total_amount"), 2).alias("total_revenue")
    )
    return months.orderBy(F.desc("order_year"), F.desc("order_month"))


# ---------------------------------------------------------------- on the profile and its export


def export_row_count(export: DataFrame) -> DataFrame:
    return export.agg(F.count(F.lit(1)).alias("total_customers"))


def churn_cohort_counts(export: DataFrame) -> DataFrame:
    """Customers per churn risk, largest first."""
    counts = export.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("customer_count"))
    return counts.orderBy(F.desc("customer_count"), F.asc("churn_risk"))


def export_preview(export: DataFrame, limit: int = 10) -> DataFrame:
    """A few rows to look at, always the same ones."""
    columns = (
        "customer_id", "segment", "churn_risk", "rfm_segment", "recency_days", "frequency", "monetary_value",
    )
    return export.select(*columns).orderBy("customer_id").limit(limit)


def _share(count: str) -> Column:
    """Percent of all groups. Runs over the finished groups, one row per label."""
    return F.round(F.col(count) * 100 / F.sum(count).over(Window.partitionBy()), 2)


def segment_breakdown(profile: DataFrame) -> DataFrame:
    """Customers and share per segment label."""
    counts = profile.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customer_count"))
    return counts.withColumn("share_percent", _share("customer_count"))


def recency_monetary_points(profile: DataFrame) -> DataFrame:
    """One point per customer: recency, monetary value and churn risk."""
    return profile.select("customer_id", "recency_days", "monetary_value", "churn_risk")


def churn_cohort_summary(profile: DataFrame) -> DataFrame:
    """Customers, share and mean recency, frequency and monetary value per churn risk."""
    cohorts = profile.groupBy("churn_risk").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(F.avg("recency_days"), 2).alias("avg_recency_days"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(F.avg("monetary_value"), 2).alias("avg_monetary_value"),
    )
    return cohorts.withColumn("share_percent", _share("customer_count"))


def late_clicks(clicks: DataFrame, hours: float = 24.0) -> DataFrame:
    """Clicks per day, those that reached silver more than ``hours`` after they happened, and the longest delay."""
    delay = (F.unix_timestamp("processed_at") - F.unix_timestamp("event_ts")) / 3600.0
    return (
        clicks.groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("clicks"), F.count_if(delay > hours).alias("late_clicks"), F.round(F.max(delay), 2).alias("max_delay_hours"))
        .orderBy("event_date")
    )
