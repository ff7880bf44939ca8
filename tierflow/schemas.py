"""Schemas of the bronze sources (as DDL, which readers and tables both take) and of the export."""

from __future__ import annotations

from dataclasses import dataclass


# Column names and types of the sources.
BRONZE_CUSTOMERS = "customer_id string, email string, signup_date date, country string"

BRONZE_PRODUCTS = "product_id string, product_name string, category string, price decimal(10,2)"

BRONZE_ORDERS = (
    "order_id string, customer_id string, order_date timestamp, total_amount decimal(10,2), status string"
)

# The change log of the orders: dates as text, amounts as the source delivers them, plus the order of
# the changes and the kind of change (I, U, D).
BRONZE_ORDER_CHANGES = (
    "order_id string, customer_id string, order_date string, total_amount double, status string, "
    "seq long, op string"
)

BRONZE_CLICKS = (
    "event_id string, customer_id string, event_type string, page string, product_id string, "
    "session_id string, timestamp string, device string, country string"
)

BRONZE_CRM = (
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "segment string, lifetime_value string, last_contact_date string, opted_in_marketing boolean, "
    "export_date string"
)

# Folder levels the click delivery writes below its prefix.
CLICK_FOLDERS = ("year", "month", "day", "hour")


@dataclass(frozen=True)
class Field:
    """One column of a typed table: its Spark type, its width if it is text, whether it may be NULL."""

    name: str
    type: str
    width: int | None = None
    required: bool = False

    @property
    def ddl(self) -> str:
        kind = f"varchar({self.width})" if self.width else self.type
        return f"{self.name} {kind}" + (" not null" if self.required else "")


# The 17 columns of the export, in order.
EXPORT = (
    Field("customer_id", "string", 20, required=True),
    Field("first_name", "string", 100),
    Field("last_name", "string", 100),
    Field("email", "string", 200),
    Field("segment", "string", 50),
    Field("lifetime_value", "decimal(12,2)"),
    Field("recency_days", "int"),
    Field("frequency", "int"),
    Field("monetary_value", "decimal(12,2)"),
    Field("return_count", "int"),
    Field("total_clicks", "int"),
    Field("total_sessions", "int"),
    Field("active_days", "int"),
    Field("churn_risk", "string", 10),
    Field("rfm_segment", "string", 50),
    Field("last_order_date", "timestamp"),
    Field("updated_at", "timestamp"),
)
