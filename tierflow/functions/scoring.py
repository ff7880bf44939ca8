"""Rule-based churn risk and segment label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_match(rules: list[tuple[Column, str]], default: str) -> Column:
    """The label of the first rule that holds. A rule that is NULL does not hold."""
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), F.lit(default))


def churn_risk(
    df: DataFrame,
    high: tuple[int, int] = (90, 3),
    medium: tuple[int, int] = (60, 5),
    no_orders_label: str | None = None,
) -> DataFrame:
    """Add ``churn_risk``. A band ``(days, orders)`` holds for customers idle for more than ``days``
    with fewer than ``orders`` orders.

    Customers without orders meet no band and are LOW, unless ``no_orders_label`` names their class.
    """

    def idle(band: tuple[int, int]) -> Column:
        days, orders = band
        return (F.col("recency_days") > days) & (F.col("frequency") < orders)

    rules = [(idle(high), "HIGH"), (idle(medium), "MEDIUM")]
    if no_orders_label is not None:
        rules.insert(0, (F.col("frequency").isNull(), no_orders_label))
    return df.withColumn("churn_risk", _first_match(rules, "LOW"))


def rfm_segment(df: DataFrame, vip: str = "VIP", loyal_min: int = 10, recent_max: int = 30) -> DataFrame:
    """Add ``rfm_segment``; the first matching label wins."""
    rules = [
        (F.col("segment") == vip, "Champions"),
        (F.col("churn_risk") == "HIGH", "At Risk"),
        (F.col("frequency") >= loyal_min, "Loyal Customers"),
        (F.col("recency_days") <= recent_max, "Recent Customers"),
    ]
    return df.withColumn("rfm_segment", _first_match(rules, "Needs Attention"))
