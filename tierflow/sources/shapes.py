"""The given tables in the shape of the bronze sources.

The given tables are clean, so each is read whole and once, and rows with the usual defects are added
to it: later versions, deletions, missing keys, bad amounts, dates and states. Key arithmetic only
decides where a row is added; no row of the given tables is left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLICK_FOLDERS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_added(base: DataFrame, columns: Sequence[str], added: Sequence[tuple[int, Mapping[str, Column]]]) -> DataFrame:
    """Every base row, plus for each ``(n, changes)`` a changed copy of every n-th key.

    One scan and one generator, instead of a union that would scan the table once per kind of row.
    """
    own = F.struct(*(F.col(c) for c in columns))
    copies = [own]
    for every, changes in added:
        copy = F.struct(*(changes.get(c, F.col(c)).alias(c) for c in columns))
        copies.append(F.when(F.col("k") % every == 0, copy))
    return base.select(F.inline(F.array_compact(F.array(*copies))))


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


_ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "total_amount", "status", "seq", "op")


def bronze_orders(spark: SparkSession, sf_dir: str, kinds: str) -> DataFrame:
    """Order changes. ``kinds`` picks the added rows:

    U updated amount and state, D deleted, N no customer, Z negative amount, B date that is none,
    S state that is none, E another amount under the sequence number of the first version.
    """
    base = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("string").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("returned")
        .alias("status"),
        F.lit(1).cast("long").alias("seq"),
        F.lit("I").alias("op"),
    )

    def renamed(letter: str, **changes: Column) -> dict[str, Column]:
        return {"order_id": F.concat(F.lit(letter), F.col("order_id")), **changes}

    def change(number: int, op: str, **changes: Column) -> dict[str, Column]:
        return {"seq": F.lit(number).cast("long"), "op": F.lit(op), **changes}

    added = {
        "U": (10, change(2, "U", total_amount=F.col("total_amount") + 1, status=F.lit("  Returned "))),
        "D": (50, change(3, "D")),
        "N": (97, renamed("N", customer_id=_text(None))),
        "Z": (89, renamed("Z", total_amount=-F.col("total_amount"))),
        "B": (101, renamed("B", order_date=F.lit("not-a-date"))),
        "S": (103, renamed("S", status=F.lit("shipped"))),
        "E": (71, change(1, "U", total_amount=F.col("total_amount") + 5)),
    }
    return _with_added(base, _ORDER_COLUMNS, [added[kind] for kind in kinds])


_CRM_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "segment", "lifetime_value",
    "last_contact_date", "opted_in_marketing", "export_date",
)


def bronze_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily exports: everybody on the first day; on the second some customers who became VIP,
    some without email and some whose lifetime value is no number (they have no orders either)."""
    key = F.col("c_custkey").cast("string")
    market = F.col("c_mktsegment")
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        key.alias("customer_id"),
        F.concat(F.lit("F"), key).alias("first_name"),
        F.concat(F.lit("L"), key).alias("last_name"),
        F.concat(F.lit(" User"), key, F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lit("555-"), key).alias("phone"),
        F.when(market == "BUILDING", "VIP")
        .when(market == "AUTOMOBILE", "Regular")
        .when(market == "MACHINERY", "At-Risk")
        .otherwise("New")
        .alias("segment"),
        F.col("c_acctbal").cast("string").alias("lifetime_value"),
        F.lit("2001-07-15").alias("last_contact_date"),
        (F.col("c_custkey") % 2 == 0).alias("opted_in_marketing"),
        F.lit("2001-07-31").alias("export_date"),
    )
    second_day = {"export_date": F.lit("2001-08-01")}
    return _with_added(
        base,
        _CRM_COLUMNS,
        [
            (20, {**second_day, "segment": F.lit("VIP")}),
            (61, {**second_day, "customer_id": F.concat(F.lit("E"), F.col("customer_id")), "email": _text(None)}),
            (67, {**second_day, "customer_id": F.concat(F.lit("V"), F.col("customer_id")), "lifetime_value": F.lit("bad")}),
        ],
    )


_CLICK_COLUMNS = (
    "event_id", "customer_id", "event_type", "page", "product_id", "session_id", "timestamp", "device", "country",
)


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with repeated deliveries, missing customers and missing types. Page, product, device and
    country have no counterpart in the given tables and are NULL."""
    user = F.col("user_id").cast("string")
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("k"),
        F.col("event_id").cast("string").alias("event_id"),
        user.alias("customer_id"),
        "event_type",
        F.concat(user, F.lit("-"), F.get_json_object("props", "$.k")).alias("session_id"),
        F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")).alias("timestamp"),
        *(_text(None).alias(c) for c in ("page", "product_id", "device", "country")),
    )
    return _with_added(
        base,
        _CLICK_COLUMNS,
        [
            (10, {}),
            (97, {"event_id": F.concat(F.lit("N"), F.col("event_id")), "customer_id": _text(None)}),
            (89, {"event_id": F.concat(F.lit("T"), F.col("event_id")), "event_type": _text(None)}),
        ],
    )


# ---------------------------------------------------------------- landing files


def land_clicks(clicks: DataFrame, path: str) -> str:
    """Write clicks as the delivery does: gzip JSON lines in year / month / day / hour folders."""
    instant = F.to_timestamp("timestamp")
    (
        clicks.withColumns(
            {"year": F.year(instant), "month": F.month(instant), "day": F.day(instant), "hour": F.hour(instant)}
        )
        .hint("rebalance", *CLICK_FOLDERS)
        .write.mode("append")
        .partitionBy(*CLICK_FOLDERS)
        .option("compression", "gzip")
        .json(path)
    )
    return path


def land_crm(crm: DataFrame, path: str) -> str:
    """Write the exports as CSV with a header; spaces around values stay."""
    (
        crm.write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def land_orders(orders: DataFrame, path: str) -> str:
    """Write order changes as Parquet."""
    orders.write.mode("append").parquet(path)
    return path
