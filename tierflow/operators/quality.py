"""Data-quality rules, their report, and the gate that stops a publish."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..schemas import Field


class QualityError(Exception):
    """A gate did not pass. ``report`` holds its rows."""

    def __init__(self, context: str, report: Sequence[Row], failed: Sequence[Row]):
        self.report = list(report)
        self.failed = list(failed)
        super().__init__(f"{context}: " + "; ".join(str(row.asDict()) for row in self.failed))


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Complete:
    """No NULL in the column."""

    column: str
    name = "complete"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Absent:
    """Only NULL in the column, as in the column of lines that did not parse."""

    column: str
    name = "absent"

    def fails(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Above:
    """Every value greater than ``bound`` (or equal, if ``inclusive``); NULL fails."""

    column: str
    bound: float
    inclusive: bool = False
    name = "above"

    def fails(self) -> Column:
        value = F.col(self.column)
        holds = value >= self.bound if self.inclusive else value > self.bound
        return ~F.coalesce(holds, F.lit(False))


@dataclass(frozen=True)
class OneOf:
    """Every value in a list. ``nulls`` says whether NULL counts as 'fail' or 'pass'."""

    column: str
    values: tuple[str, ...]
    nulls: str = "fail"
    name = "one_of"

    def fails(self) -> Column:
        return ~F.coalesce(F.col(self.column).isin(*self.values), F.lit(self.nulls == "pass"))


@dataclass(frozen=True)
class Unique:
    """No value twice. NULLs are left to ``Complete``. Exact; see ``evaluate``."""

    column: str
    name = "unique"


Rule = Complete | Absent | Above | OneOf | Unique

# The states an order can have once cleaned.
ORDER_STATES = ("COMPLETED", "PENDING", "RETURNED")

ORDER_RULES: tuple[Rule, ...] = (
    Complete("order_id"),
    Complete("customer_id"),
    Complete("order_date"),
    Above("total_amount", 0),
    Unique("order_id"),
    OneOf("status", ORDER_STATES),
)

CLICK_RULES: tuple[Rule, ...] = (
    Complete("event_id"),
    Complete("customer_id"),
    Complete("event_type"),
    Complete("event_ts"),
    Unique("event_id"),
)

CRM_RULES: tuple[Rule, ...] = (
    Complete("customer_id"),
    Complete("email"),
    Unique("customer_id"),
)

# Off by default: balances may be negative.
LIFETIME_VALUE_RULE = Above("lifetime_value", 0, inclusive=True)


# ---------------------------------------------------------------- report and gate


def _lines(rules: Sequence[Rule], counts: Sequence[Column], total: Column) -> Column:
    """One report line per rule, from a one-row aggregate."""
    return F.inline(
        F.array(
            *(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.column).alias("column"),
                    F.coalesce(count, F.lit(0)).cast("long").alias("failing_rows"),
                    F.coalesce(total, F.lit(0)).cast("long").alias("total_rows"),
                )
                for rule, count in zip(rules, counts)
            )
        )
    )


def evaluate(
    df: DataFrame, rules: Sequence[Rule], context: str | None = None, run_ts: datetime | None = None
) -> DataFrame:
    """The report ``(rule, column, outcome, failing_rows, total_rows)``, one row per rule.

    All rules on single rows share one aggregate without an exchange of rows. A uniqueness rule counts
    per key, with partial counts before the exchange, so only keys and counts move and a key that
    repeats very often stays cheap. Its failing rows are all rows of repeated keys.
    ``context`` and ``run_ts`` are added as columns when given, for a results table.
    """
    row_rules = [r for r in rules if not isinstance(r, Unique)]
    parts = []
    if row_rules:
        counted = df.agg(
            F.count(F.lit(1)).alias("total"),
            *(F.count_if(rule.fails()).alias(f"f{i}") for i, rule in enumerate(row_rules)),
        )
        parts.append(counted.select(_lines(row_rules, [F.col(f"f{i}") for i in range(len(row_rules))], F.col("total"))))
    for rule in rules:
        if isinstance(rule, Unique):
            copies = df.groupBy(F.col(rule.column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            repeated = F.col("key").isNotNull() & (F.col("n") > 1)
            counted = copies.agg(F.sum("n").alias("total"), F.sum(F.when(repeated, F.col("n"))).alias("f"))
            parts.append(counted.select(_lines([rule], [F.col("f")], F.col("total"))))
    return _told(reduce(DataFrame.unionAll, parts), context, run_ts)


def unique_report(
    figures: DataFrame, rule: Unique, context: str | None = None, run_ts: datetime | None = None
) -> DataFrame:
    """The report line of a uniqueness rule from one row of figures known already: ``f`` failing rows of ``total``."""
    return _told(figures.select(_lines([rule], [F.col("f")], F.col("total"))), context, run_ts)


def _told(lines: DataFrame, context: str | None, run_ts: datetime | None) -> DataFrame:
    report = lines.select(
        "rule",
        "column",
        F.when(F.col("failing_rows") == 0, "Passed").otherwise("Failed").alias("outcome"),
        "failing_rows",
        "total_rows",
    )
    if context is not None:
        report = report.withColumn("context", F.lit(context))
    if run_ts is not None:
        report = report.withColumn("run_ts", F.lit(run_ts.isoformat(sep=" ")).cast("timestamp"))
    return report


def record(report: DataFrame, results_table: str) -> DataFrame:
    """Put a report of one context and run into the results table and give back exactly its rows.

    Each context and run is a partition with a folder of its own attempt: jobs that report at the same time do
    not touch each other's files, and a run that is repeated replaces its report. The report is computed once:
    a handful of rows, one per rule.
    """
    spark = report.sparkSession
    lines = report.withColumn("run_ts", F.col("run_ts").cast("string"))
    found = lines.collect()
    fixed = spark.createDataFrame(found, lines.schema).withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    if not found:
        return fixed
    ((context, run_ts),) = {(row["context"], row["run_ts"]) for row in found}
    stored = [f for f in fixed.schema.fields if f.name not in ("context", "run_ts")]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {results_table} ({columns}, context string, run_ts timestamp) "
        "USING parquet PARTITIONED BY (context, run_ts)"
    )
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {results_table}").collect()
    root = next(r["data_type"] for r in described if r["col_name"] == "Location")
    folder = f"{root}/report-{uuid.uuid4().hex}"
    fixed.select(*(f.name for f in stored)).coalesce(1).write.parquet(folder)
    partition = f"PARTITION (context = '{context}', run_ts = '{run_ts}')"
    spark.sql(f"ALTER TABLE {results_table} ADD IF NOT EXISTS {partition} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {results_table} {partition} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(results_table)
    return fixed


def gate(report: DataFrame, context: str = "quality") -> None:
    """Raise ``QualityError`` if any rule failed."""
    rows = report.collect()
    failed = [row for row in rows if row["outcome"] != "Passed"]
    if failed:
        raise QualityError(context, rows, failed)


# ---------------------------------------------------------------- gold validation

# Columns of the profile whose NULLs are counted; the first is fatal.
GOLD_KEYS = ("customer_id", "email", "churn_risk", "rfm_segment")


SIDES = ("orders", "clicks", "crm")


def gold_counts(gold: DataFrame, rows: Mapping[str, int]) -> DataFrame:
    """One row with everything the gold checks need, from one aggregate over the profile; ``rows`` says how many rows
    ``orders``, ``clicks`` and ``crm`` have, which is known since they were published.

    To be run on the staged profile, where the counts are real: on the lazy join Catalyst removes the
    joins from a count, and a guard against fan-out could never fire.
    """
    flags = {
        **{f"null_{c}": F.col(c).isNull() for c in GOLD_KEYS},
        "without_orders": F.col("frequency").isNull(),
        "without_clicks": F.col("total_clicks").isNull(),
    }
    counted = gold.agg(F.count(F.lit(1)).alias("gold_rows"), *(F.count_if(e).alias(n) for n, e in flags.items()))
    return counted.select(*(F.lit(rows[s]).cast("long").alias(f"{s}_rows") for s in SIDES), "*")


def _percent(part: str, whole: str = "gold_rows") -> Column:
    rate = F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 2)
    return F.coalesce(rate, F.lit(0.0))


def null_rates(counts: DataFrame) -> DataFrame:
    """Share of NULLs, in percent, of the four key columns of the profile."""
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"null_{c}").alias("null_rows"),
                        F.col("gold_rows").alias("total_rows"),
                        _percent(f"null_{c}").alias("null_percent"),
                    )
                    for c in GOLD_KEYS
                )
            )
        )
    )


def validate_gold(counts: DataFrame) -> DataFrame:
    """Outcome per check, with the figures behind it. Shares without orders or clicks are only told."""
    checks = [
        ("not_empty", F.col("gold_rows") > 0, F.col("gold_rows")),
        ("no_fanout", F.col("gold_rows") <= F.col("crm_rows"), F.col("gold_rows") - F.col("crm_rows")),
        ("complete_customer_id", F.col("null_customer_id") == 0, F.col("null_customer_id")),
        ("orders_rows", F.lit(True), F.col("orders_rows")),
        ("clicks_rows", F.lit(True), F.col("clicks_rows")),
        ("crm_rows", F.lit(True), F.col("crm_rows")),
        ("without_orders", F.lit(True), F.col("without_orders")),
        ("without_clicks", F.lit(True), F.col("without_clicks")),
    ]
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("check"),
                        F.when(holds, "Passed").otherwise("Failed").alias("outcome"),
                        value.cast("long").alias("value"),
                    )
                    for name, holds, value in checks
                )
            )
        )
    )


def gold_report(counts: DataFrame, context: str, run_ts: datetime) -> DataFrame:
    """The checks of the profile and the NULL rates of its key columns as lines of the results table.

    Lines of ``rows`` and ``null_rate`` tell figures and fail nothing; an id that is NULL fails ``complete``."""

    def line(rule: str, column: str | None, failing, total, holds=None):
        outcome = F.lit("Passed") if holds is None else F.when(holds, "Passed").otherwise("Failed")
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(column).cast("string").alias("column"),
            outcome.alias("outcome"),
            failing.cast("long").alias("failing_rows"),
            total.cast("long").alias("total_rows"),
        )

    gold, none = F.col("gold_rows"), F.lit(0)
    beyond = F.greatest(gold - F.col("crm_rows"), none)
    lines = [
        line("not_empty", None, none, gold, gold > 0),
        line("no_fanout", None, beyond, gold, beyond == 0),
        line("complete", GOLD_KEYS[0], F.col(f"null_{GOLD_KEYS[0]}"), gold, F.col(f"null_{GOLD_KEYS[0]}") == 0),
        *(line("rows", side, none, F.col(f"{side}_rows")) for side in (*SIDES, "gold")),
        *(line("null_rate", c, F.col(f"null_{c}"), gold) for c in GOLD_KEYS),
        *(line("without", side, F.col(f"without_{side}"), gold) for side in ("orders", "clicks")),
    ]
    return counts.select(F.inline(F.array(*lines))).select(
        "*", F.lit(context).alias("context"), F.lit(run_ts.isoformat(sep=" ")).cast("timestamp").alias("run_ts")
    )


# ---------------------------------------------------------------- schema conformance


def _type_name(kind: str) -> str:
    return kind.replace(" ", "").lower()


def conformance(df: DataFrame, expected: Sequence[Field]) -> DataFrame:
    """Compare a table with its declared columns, by position: name, type, text width, NULLs.

    One row per position; widths and NULLs come from one aggregate over the data.
    """
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    checked = [f for f, (name, _) in zip(expected, actual) if f.name == name]
    longest = {f.name: F.max(F.length(F.col(f.name))) for f in checked if f.width}
    nulls = {f.name: F.count_if(F.col(f.name).isNull()) for f in checked if f.required}
    measured = df.agg(
        F.lit(True).alias("always"),
        *(c.alias(f"longest_{n}") for n, c in longest.items()),
        *(c.alias(f"nulls_{n}") for n, c in nulls.items()),
    )
    lines = []
    for i in range(max(len(expected), len(actual))):
        want = expected[i] if i < len(expected) else None
        name, kind = actual[i] if i < len(actual) else (None, None)
        same = want is not None and want.name == name and _type_name(want.type) == kind
        width = F.col(f"longest_{name}") if name in longest else F.lit(None)
        empty = F.col(f"nulls_{name}") if name in nulls else F.lit(None)
        fits = F.lit(same)
        if same and name in longest:
            fits &= F.coalesce(width <= want.width, F.lit(True))
        if same and name in nulls:
            fits &= empty == 0
        lines.append(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(want.name if want else None).cast("string").alias("expected_name"),
                F.lit(_type_name(want.type) if want else None).cast("string").alias("expected_type"),
                F.lit(name).cast("string").alias("actual_name"),
                F.lit(kind).cast("string").alias("actual_type"),
                width.cast("int").alias("longest"),
                empty.cast("long").alias("null_rows"),
                F.when(fits, "Passed").otherwise("Failed").alias("outcome"),
            )
        )
    return measured.select(F.inline(F.array(*lines)))
