"""Bronze to silver for the three sources.

Order of work is dedup, then filters: the newest version of a key decides, and if it is unusable the
key is gone. Text that does not parse becomes NULL for the quality gate to see, it never aborts a job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import dedup_latest, latest_snapshot
from ..session import require_utc

Dedup = Callable[[DataFrame], DataFrame]


def at(run_ts: datetime | None) -> Column:
    """The run's time stamp; a stream passes None and gets the start of each micro-batch."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")


# ---------------------------------------------------------------- orders


def conform_orders(bronze: DataFrame) -> DataFrame:
    """Types, upper-case status and partition columns; keeps every row."""
    require_utc(bronze.sparkSession)
    ordered_at = F.try_to_timestamp(F.col("order_date"))
    return bronze.withColumns(
        {
            "order_date": ordered_at,
            "total_amount": F.col("total_amount").try_cast("double"),
            "status": F.upper(F.trim(F.col("status"))),
            "order_year": F.year(ordered_at),
            "order_month": F.month(ordered_at),
        }
    )


def usable_order() -> Column:
    """Both keys present and a positive amount. To be used on conformed rows."""
    return F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("total_amount") > 0)


# What decides between rows of one order with the same sequence number, on cleaned values: the larger wins.
ORDER_TIES = ("customer_id", "order_date", "total_amount", "status")


def clean_orders(
    bronze: DataFrame,
    run_ts: datetime,
    sequence: str = "seq",
    op_col: str = "op",
    delete_value: str = "D",
    filter_first: Column | None = None,
) -> DataFrame:
    """Silver orders. A change log (``sequence`` and ``op_col`` present) is reduced to its current
    state in the same exchange that removes duplicates; a plain table works too. ``filter_first`` sees the
    rows as they landed. Ties are broken on cleaned values, as the incremental table does."""
    if filter_first is not None:
        bronze = bronze.filter(filter_first)
    versions = conform_orders(bronze)
    first = [*ORDER_TIES, *(c for c in (op_col,) if c in bronze.columns)]
    others = [c for c in versions.columns if c not in ("order_id", sequence, *first)]
    newest = dedup_latest(
        versions, ["order_id"], [c for c in (sequence,) if c in bronze.columns], tie_break=[*first, *others]
    )
    if op_col in bronze.columns:
        newest = newest.filter(~F.col(op_col).eqNullSafe(F.lit(delete_value)))
    return newest.drop(sequence, op_col).filter(usable_order()).withColumn("processed_at", at(run_ts))


# ---------------------------------------------------------------- clickstream


def first_delivery(keys: Sequence[str] = ("event_id",)) -> Dedup:
    """Batch dedup of clicks: the earliest event of a key stays."""
    return lambda clicks: dedup_latest(clicks, list(keys), [F.col("event_ts").asc_nulls_last()])


def clean_clicks(bronze: DataFrame, run_ts: datetime | None, dedup: Dedup | None = None) -> DataFrame:
    """Silver clickstream, for a table or a stream; only the dedup step differs between the two.

    Date and hour both come from the parsed instant, so they cannot disagree.
    """
    require_utc(bronze.sparkSession)
    timed = bronze.withColumn("event_ts", F.try_to_timestamp(F.col("timestamp")))
    once = (dedup or first_delivery())(timed)
    return once.filter(F.col("customer_id").isNotNull() & F.col("event_type").isNotNull()).withColumns(
        {
            "event_date": F.to_date("event_ts"),
            "event_hour": F.hour("event_ts"),
            "processed_at": at(run_ts),
        }
    )


# ---------------------------------------------------------------- CRM


def clean_crm(bronze: DataFrame, run_ts: datetime) -> DataFrame:
    """Silver customers from the daily exports: newest export per customer, email required."""
    return conform_crm(latest_snapshot(bronze, ["customer_id"], "export_date"), run_ts)


def conform_crm(newest: DataFrame, run_ts: datetime) -> DataFrame:
    """Silver customers from the newest row of each."""
    return newest.filter(F.col("customer_id").isNotNull() & F.col("email").isNotNull()).withColumns(
        {
            "email": F.lower(F.trim(F.col("email"))),
            "lifetime_value": F.col("lifetime_value").try_cast("double"),
            "last_contact_date": F.col("last_contact_date").try_cast("date"),
            "processed_at": at(run_ts),
        }
    )
