"""Entry points: the flagship query, every query, and the SQL each is checked against.

The bronze tables are derived from the given ``orders``, ``customer`` and ``events`` tables, read
whole (see ``tierflow.sources.shapes``). The SQL below builds the same tables with unions and states
every result a second time, in another shape than the Spark code.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import schemas, session
from tierflow.functions.cleaning import clean_clicks, clean_crm, clean_orders
from tierflow.functions.features import (
    SKETCH_BOUND,
    click_features,
    customer_features,
    daily_sessions,
    rfm_features,
    sketched_click_features,
)
from tierflow.functions.scoring import churn_risk, rfm_segment
from tierflow.operators import quality, sinks
from tierflow.operators.dedup import apply_changes, dedup_latest, latest_snapshot
from tierflow.plans import flows, incremental, reports
from tierflow.sources import catalog, readers, shapes
from tierflow.streaming import clicks as click_stream
from tierflow.streaming import crm as crm_stream
from tierflow.streaming import orders as order_stream
from tierflow.streaming import uniqueness

AS_OF = date(2001, 8, 1)
RUN_TS = datetime(2001, 8, 1, 2)
LATE_HOURS = 10000

# Which added rows the order table has: those cleaning deals with, those the gate finds, all of them.
CLEANABLE, FAILING, CHANGES, EVERYTHING = "UNZ", "UNZBS", "UD", "UDNZBS"

Query = Callable[[SparkSession, str], DataFrame]


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        import tierflow.llm.queries as corpus
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "tierflow.llm"):
            raise
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return corpus.QUERIES | {"pipeline": corpus_pipeline.run}, corpus.SQL | pipeline_sql


# ---------------------------------------------------------------- inputs


def _lake(spark: SparkSession) -> flows.Lake:
    """A database of its own for one query, below the shared scratch folder."""
    return flows.Lake.create(spark, f"lake_{uuid.uuid4().hex}", session.scratch(spark, "lake"))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return clean_orders(shapes.bronze_orders(spark, sf, CLEANABLE), RUN_TS)


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return clean_clicks(shapes.bronze_clicks(spark, sf), RUN_TS)


def _crm(spark: SparkSession, sf: str) -> DataFrame:
    return clean_crm(shapes.bronze_crm(spark, sf), RUN_TS)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    rfm = rfm_features(_orders(spark, sf), AS_OF, unique_orders=True)
    return customer_features(_crm(spark, sf), rfm, click_features(_clicks(spark, sf)))


def _profile(spark: SparkSession, sf: str, as_of: date = AS_OF) -> DataFrame:
    return flows.customer_profile(_crm(spark, sf), _orders(spark, sf), _clicks(spark, sf), as_of, RUN_TS)


def _silver(spark: SparkSession, sf: str) -> flows.Lake:
    """A lake with the three silver tables published."""
    lake = _lake(spark)
    bronze = (shapes.bronze_orders(spark, sf, CLEANABLE), shapes.bronze_clicks(spark, sf), shapes.bronze_crm(spark, sf))
    flows.run_silver(lake, *bronze, RUN_TS)
    return lake


def _gold(spark: SparkSession, sf: str) -> tuple[flows.Lake, DataFrame, DataFrame]:
    lake = _silver(spark, sf)
    return lake, *flows.run_gold(spark, lake, AS_OF, RUN_TS)


def click_features_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Features merged from a stored sketch per customer and day, held against the exact ones."""
    path = session.scratch(spark, "sketches")
    clicks = _clicks(spark, sf)
    daily_sessions(clicks).write.parquet(path)
    merged = sketched_click_features(spark.read.parquet(path)).withColumnRenamed("total_sessions", "estimate")
    exact = click_features(clicks).select("customer_id", "total_sessions")
    off = F.abs(F.col("estimate") - F.col("total_sessions"))
    return merged.join(exact, "customer_id").select(
        "customer_id", "total_clicks", "active_days", (off <= SKETCH_BOUND * F.col("total_sessions") + 0.5).alias("within_bound")
    )


# Page, product, device and country are NULL in the derived clicks and left out of results.
_CLICK_RESULT = ("event_id", "customer_id", "event_type", "session_id", "timestamp")
_SILVER_CLICK_RESULT = (*_CLICK_RESULT, "event_ts", "event_date", "event_hour", "processed_at")


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare by value; ``export_conformance`` checks the types."""
    return df.select(
        *(F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema)
    )


# ---------------------------------------------------------------- sources


def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    path = shapes.land_orders(shapes.bronze_orders(spark, sf, EVERYTHING), session.scratch(spark, "orders"))
    catalog.register(spark, lake.name("bronze_orders"), path, schema=schemas.BRONZE_ORDER_CHANGES)
    return catalog.scan(spark, lake.database, "bronze_orders")


def catalog_partitions(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    path = shapes.land_clicks(shapes.bronze_clicks(spark, sf), session.scratch(spark, "clicks"))
    clicks = catalog.register(
        spark, lake.name("bronze_clicks"), path, "json", schema=readers.click_schema(), partition_by=schemas.CLICK_FOLDERS
    )
    return clicks.groupBy(*schemas.CLICK_FOLDERS).agg(F.count("event_id").alias("rows"))


def bronze_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shapes.land_clicks(shapes.bronze_clicks(spark, sf), session.scratch(spark, "clicks"))
    good, _ = readers.split_corrupt(readers.read_clicks(spark, path))
    return good.select(*_CLICK_RESULT, *schemas.CLICK_FOLDERS)


def bronze_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shapes.land_crm(shapes.bronze_crm(spark, sf), session.scratch(spark, "crm"))
    good, _ = readers.split_corrupt(readers.read_crm(spark, path))
    return good


def cdc_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(shapes.bronze_orders(spark, sf, CHANGES), ["order_id"], "seq")


def crm_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return latest_snapshot(shapes.bronze_crm(spark, sf), ["customer_id"], "export_date")


def incremental_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries on one checkpoint, a compaction between: first versions, updates, then deletions and versions
    that come late with the sequence number of the first."""
    lake, root = _lake(spark), session.scratch(spark, "incremental")
    table, view = lake.name("orders_state"), lake.name("silver_orders_live")
    order_stream.create_orders_table(spark, table, root, view)
    changes = shapes.bronze_orders(spark, sf, "UDNZE")
    first, op = F.col("seq") == 1, F.col("op")
    for n, delivery in enumerate((first & (op == "I"), F.col("seq") == 2, (op == "D") | first & (op == "U"))):
        landing = shapes.land_orders(changes.filter(delivery), f"{root}/landing")
        source = order_stream.order_changes(spark, landing)
        order_stream.ingest_orders(source, table, root, f"{root}/checkpoint", RUN_TS).awaitTermination()
        if n == 1:
            order_stream.compact_orders(spark, table, root, view)
    return spark.table(view)


def incremental_crm(spark: SparkSession, sf: str) -> DataFrame:
    """The daily exports in two deliveries, the newest first."""
    lake, root = _lake(spark), session.scratch(spark, "crm")
    exports = shapes.bronze_crm(spark, sf)
    for newer in (True, False):
        shapes.land_crm(exports.filter((F.col("export_date") > "2001-07-31") == newer), f"{root}/landing")
        source = crm_stream.crm_source(spark, f"{root}/landing")
        crm_stream.ingest_crm(source, lake, root, f"{root}/checkpoint", RUN_TS).awaitTermination()
    return spark.table(lake.name("silver_customers"))


def _stream_clicks(spark: SparkSession, sf: str, deliveries: int = 1, max_files: int | None = None) -> str:
    """The click tables after the stream took in whole deliveries of the clicks, a run each; their name."""
    lake, path = _lake(spark), session.scratch(spark, "stream")
    name, root = lake.name("silver_clicks"), f"{path}/silver"
    click_stream.create_click_tables(spark, name, root)
    for _ in range(deliveries):
        shapes.land_clicks(shapes.bronze_clicks(spark, sf), f"{path}/landing")
        raw = click_stream.click_source(spark, f"{path}/landing", max_files=max_files)
        with click_stream.Progress(spark, name, root) as progress:
            progress.finish(click_stream.ingest_clicks(raw, name, root, f"{path}/checkpoint", RUN_TS))
    return name


def stream_clickstream(spark: SparkSession, sf: str) -> DataFrame:
    return spark.table(_stream_clicks(spark, sf)).select(*_SILVER_CLICK_RESULT)


def stream_clickstream_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """The same clicks as a backlog that is taken in many micro-batches, in whatever order the files come."""
    return spark.table(_stream_clicks(spark, sf, max_files=500)).select(*_SILVER_CLICK_RESULT)


def stream_gated(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every delivered click when all are delivered twice; the outcomes add up."""
    return click_stream.balance(spark, _stream_clicks(spark, sf, deliveries=2))


def unique_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The uniqueness rule over all clicks, counted in three deliveries by day of the month, compacted before the last."""
    lake, root = _lake(spark), session.scratch(spark, "unique")
    log, rule, clicks = lake.name("click_ids"), quality.Unique("event_id"), shapes.bronze_clicks(spark, sf)
    uniqueness.create_counts(spark, log, root)
    day = F.coalesce(F.substring("timestamp", 9, 2), F.lit(""))
    for n, delivery in enumerate((day < "11", (day >= "11") & (day < "21"), day >= "21")):
        clicks.filter(delivery).write.mode("append").parquet(f"{root}/landing")
        source = spark.readStream.schema(clicks.schema).parquet(f"{root}/landing")
        uniqueness.count_keys(source, rule, log, root, f"{root}/checkpoint").awaitTermination()
        if n == 1:
            uniqueness.compact_counts(spark, log, root)
    return uniqueness.report(spark, log, rule)


# ---------------------------------------------------------------- silver


def dedup_newest_order(spark: SparkSession, sf: str) -> DataFrame:
    """The newest order row of every customer; ties go by the remaining columns."""
    return dedup_latest(shapes.bronze_orders(spark, sf, EVERYTHING), ["customer_id"], ["order_date"])


def silver_clickstream(spark: SparkSession, sf: str) -> DataFrame:
    return _clicks(spark, sf).select(*_SILVER_CLICK_RESULT)


def silver_orders_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch(spark, "silver_orders")
    sinks.overwrite(_orders(spark, sf), path, ["order_year", "order_month"])
    return readers.read_silver(spark, path)


def silver_clickstream_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = session.scratch(spark, "silver_clicks")
    sinks.overwrite(_clicks(spark, sf), path, ["event_date"])
    return readers.read_silver(spark, path).select(*_SILVER_CLICK_RESULT)


# ---------------------------------------------------------------- quality


def dq_orders(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluate(clean_orders(shapes.bronze_orders(spark, sf, FAILING), RUN_TS), quality.ORDER_RULES)


def dq_clickstream(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluate(_clicks(spark, sf), quality.CLICK_RULES)


def dq_crm(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluate(_crm(spark, sf), (*quality.CRM_RULES, quality.LIFETIME_VALUE_RULE))


def dq_results_table(spark: SparkSession, sf: str) -> DataFrame:
    lake = _silver(spark, sf)
    return spark.table(lake.name("dq_results"))


def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Good orders are published, then a refresh with bad ones is refused: readers keep the good."""
    lake = _lake(spark)
    flows.refresh_orders(lake, shapes.bronze_orders(spark, sf, CLEANABLE), RUN_TS)
    try:
        flows.refresh_orders(lake, shapes.bronze_orders(spark, sf, FAILING), RUN_TS)
    except quality.QualityError:
        return spark.table(lake.name("silver_orders"))
    raise AssertionError("the gate let bad orders pass")


def _gold_counts(spark: SparkSession, sf: str) -> DataFrame:
    lake, gold, _ = _gold(spark, sf)
    names = {"orders": "silver_orders", "clicks": "silver_clicks", "crm": "silver_customers"}
    return quality.gold_counts(gold, {side: sinks.resolve(spark, lake.name(t))[1] for side, t in names.items()})


def gold_validation(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_gold(_gold_counts(spark, sf))


def gold_null_rates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_rates(_gold_counts(spark, sf))


def export_conformance(spark: SparkSession, sf: str) -> DataFrame:
    return quality.conformance(sinks.to_export(_profile(spark, sf)), schemas.EXPORT)


# ---------------------------------------------------------------- gold and warehouse


def gold_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf)[1]


def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of orders and clicks, a run of the incremental gold after each and compactions between; the
    later ones delete, correct and repeat."""
    lake, root = _lake(spark), session.scratch(spark, "gold")
    orders, clicks = (lake.name("orders_state"), lake.name("silver_orders_live")), lake.name("silver_clicks")
    order_stream.create_orders_table(spark, orders[0], f"{root}/orders", orders[1])
    click_stream.create_click_tables(spark, clicks, f"{root}/clicks")
    flows.refresh_crm(lake, shapes.bronze_crm(spark, sf), RUN_TS)
    changes, events = shapes.bronze_orders(spark, sf, CLEANABLE + "D"), shapes.bronze_clicks(spark, sf)
    thirds = F.pmod(F.xxhash64("session_id"), F.lit(3))
    for n in range(3):
        shapes.land_orders(changes.filter(F.col("seq") == n + 1), f"{root}/landing/orders")
        shapes.land_clicks(events.filter(thirds <= n if n == 1 else thirds == n), f"{root}/landing/clicks")
        source = order_stream.order_changes(spark, f"{root}/landing/orders")
        order_stream.ingest_orders(source, orders[0], f"{root}/orders", f"{root}/check/orders", RUN_TS).awaitTermination()
        raw = click_stream.click_source(spark, f"{root}/landing/clicks")
        click_stream.ingest_clicks(raw, clicks, f"{root}/clicks", f"{root}/check/clicks", RUN_TS).awaitTermination()
        gold, _ = incremental.run_gold_incremental(spark, lake, f"{root}/gold", AS_OF, RUN_TS)
        if n == 1:
            order_stream.compact_orders(spark, orders[0], f"{root}/orders", orders[1], only=incremental.taken(spark, lake, f"{orders[0]}_log"))
            click_stream.compact_clicks(spark, clicks, f"{root}/clicks", only=incremental.taken(spark, lake, f"{clicks}_log"))
            incremental.compact_state(spark, lake)
    return gold


def gold_export(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_gold(spark, sf)[2])


def warehouse_load(spark: SparkSession, sf: str) -> DataFrame:
    """Load twice; the second load replaces the first."""
    lake, _, _ = _gold(spark, sf)
    flows.load_warehouse(spark, lake, buckets=8)
    return _plain(flows.load_warehouse(spark, lake, buckets=8))


def publish_versioned(spark: SparkSession, sf: str) -> DataFrame:
    """One version, a refused one, another version: the view shows the last good one."""
    name = _lake(spark).name("silver_customers")
    bronze = shapes.bronze_crm(spark, sf)
    complete = lambda staged: quality.gate(quality.evaluate(staged, quality.CRM_RULES))
    sinks.publish(clean_crm(bronze.filter(F.col("export_date") < "2001-08-01"), RUN_TS), name, RUN_TS, checks=[complete])
    try:
        sinks.publish(bronze, name, RUN_TS, checks=[complete])
        raise AssertionError("a table with repeated keys was published")
    except quality.QualityError:
        pass
    sinks.publish(clean_crm(bronze, RUN_TS), name, RUN_TS, checks=[complete])
    return spark.table(name)


def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files to the warehouse table, through the typed readers and all flows."""
    lake, landing = _lake(spark), session.scratch(spark, "landing")
    orders = shapes.land_orders(shapes.bronze_orders(spark, sf, "UDNZ"), f"{landing}/orders")
    clicks = shapes.land_clicks(shapes.bronze_clicks(spark, sf), f"{landing}/clicks")
    crm = shapes.land_crm(shapes.bronze_crm(spark, sf), f"{landing}/crm")
    flows.run_silver(
        lake,
        readers.read_parquet(spark, orders, schemas.BRONZE_ORDER_CHANGES),
        readers.read_clicks(spark, clicks),
        readers.read_crm(spark, crm),
        RUN_TS,
    )
    flows.run_gold(spark, lake, AS_OF, RUN_TS)
    return _plain(flows.load_warehouse(spark, lake, buckets=8))


def _on(report: Callable[[DataFrame], DataFrame], source: Query) -> Query:
    return lambda spark, sf: report(source(spark, sf))


def _bronze_orders(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.bronze_orders(spark, sf, EVERYTHING)


def _export(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.to_export(_profile(spark, sf))


def _later_profile(spark: SparkSession, sf: str) -> DataFrame:
    """As of a day on which every customer has been idle for long."""
    return _profile(spark, sf, date(2001, 12, 31))


_QUERIES: dict[str, Query] = {
    # sources
    "catalog_scan": catalog_scan,
    "catalog_partitions": catalog_partitions,
    "bronze_json_scan": bronze_json_scan,
    "bronze_csv_scan": bronze_csv_scan,
    "cdc_latest_state": cdc_latest_state,
    "crm_latest_snapshot": crm_latest_snapshot,
    "incremental_orders": incremental_orders,
    "incremental_crm": incremental_crm,
    "stream_clickstream": stream_clickstream,
    "stream_clickstream_backlog": stream_clickstream_backlog,
    "stream_gated": stream_gated,
    "unique_incremental": unique_incremental,
    # silver
    "dedup_latest": dedup_newest_order,
    "silver_orders": _orders,
    "silver_clickstream": silver_clickstream,
    "silver_crm": _crm,
    "silver_orders_roundtrip": silver_orders_roundtrip,
    "silver_clickstream_roundtrip": silver_clickstream_roundtrip,
    # quality
    "dq_orders": dq_orders,
    "dq_clickstream": dq_clickstream,
    "dq_crm": dq_crm,
    "dq_results_table": dq_results_table,
    "dq_gate": dq_gate,
    "gold_validation": gold_validation,
    "gold_null_rates": gold_null_rates,
    "export_conformance": export_conformance,
    # features and gold
    "rfm_features": lambda spark, sf: rfm_features(_orders(spark, sf), AS_OF),
    "rfm_features_unique_orders": lambda spark, sf: rfm_features(_orders(spark, sf), AS_OF, unique_orders=True),
    "click_features": lambda spark, sf: click_features(_clicks(spark, sf)),
    "click_features_sketched": click_features_sketched,
    "customer_features": _features,
    "churn_risk": lambda spark, sf: churn_risk(_features(spark, sf)).select(
        "customer_id", "recency_days", "frequency", "churn_risk"
    ),
    "rfm_segment": lambda spark, sf: rfm_segment(churn_risk(_features(spark, sf))).select(
        "customer_id", "segment", "recency_days", "frequency", "churn_risk", "rfm_segment"
    ),
    "customer_profile_later": _later_profile,
    "gold_profile": gold_profile,
    "gold_incremental": gold_incremental,
    "gold_export": gold_export,
    "warehouse_load": warehouse_load,
    "publish_versioned": publish_versioned,
    "end_to_end": end_to_end,
    # reports
    "top_customers_by_value": _on(reports.top_customers_by_value, _bronze_orders),
    "event_counts_by_type": _on(reports.event_counts_by_type, shapes.bronze_clicks),
    "customers_by_segment": _on(reports.customers_by_segment, shapes.bronze_crm),
    "silver_orders_quality": _on(reports.silver_orders_quality, _orders),
    "monthly_revenue_trend": _on(reports.monthly_revenue_trend, _orders),
    "export_row_count": _on(reports.export_row_count, _export),
    "churn_cohort_counts": _on(reports.churn_cohort_counts, _export),
    "export_preview": lambda spark, sf: _plain(reports.export_preview(_export(spark, sf))),
    "segment_breakdown": _on(reports.segment_breakdown, _profile),
    "recency_monetary_points": _on(reports.recency_monetary_points, _profile),
    "churn_cohort_summary": _on(reports.churn_cohort_summary, _profile),
    "late_clicks": lambda spark, sf: reports.late_clicks(_clicks(spark, sf), hours=LATE_HOURS),
}


def _prepared(query: Query) -> Query:
    return lambda spark, sf_dir: query(session.pin(spark), sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """How many customers there are per churn risk."""
    return queries()["churn_cohort_counts"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in _QUERIES.items()} | _corpus()[0]


# ---------------------------------------------------------------- the same in SQL

_SQL_ORDER_BASE = """order_base AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderdate AS VARCHAR) AS order_date, o_totalprice AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'returned' END AS status
  FROM orders)"""

_SQL_ORDER_KINDS = {
    "U": "SELECT order_id, customer_id, order_date, total_amount + 1, '  Returned ', 2, 'U' FROM order_base WHERE k % 10 = 0",
    "D": "SELECT order_id, customer_id, order_date, total_amount, status, 3, 'D' FROM order_base WHERE k % 50 = 0",
    "N": "SELECT concat('N', order_id), NULL, order_date, total_amount, status, 1, 'I' FROM order_base WHERE k % 97 = 0",
    "Z": "SELECT concat('Z', order_id), customer_id, order_date, -total_amount, status, 1, 'I' FROM order_base WHERE k % 89 = 0",
    "B": "SELECT concat('B', order_id), customer_id, 'not-a-date', total_amount, status, 1, 'I' FROM order_base WHERE k % 101 = 0",
    "S": "SELECT concat('S', order_id), customer_id, order_date, total_amount, 'shipped', 1, 'I' FROM order_base WHERE k % 103 = 0",
    "E": "SELECT order_id, customer_id, order_date, total_amount + 5, status, 1, 'U' FROM order_base WHERE k % 71 = 0",
}


def _sql_orders(kinds: str) -> str:
    """``bronze_orders`` with the given kinds of added rows."""
    first = "SELECT order_id, customer_id, order_date, total_amount, status, CAST(1 AS BIGINT) AS seq, 'I' AS op FROM order_base"
    rows = "\n  UNION ALL ".join([first, *(_SQL_ORDER_KINDS[kind] for kind in kinds)])
    return f"{_SQL_ORDER_BASE},\nbronze_orders AS (\n  {rows})"


_SQL_CRM = """crm_base AS (
  SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS customer_id, concat('F', c_custkey) AS first_name,
         concat('L', c_custkey) AS last_name, concat(' User', c_custkey, '@Example.COM ') AS email,
         concat('555-', c_custkey) AS phone,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'VIP' WHEN 'AUTOMOBILE' THEN 'Regular'
                           WHEN 'MACHINERY' THEN 'At-Risk' ELSE 'New' END AS segment,
         CAST(c_acctbal AS VARCHAR) AS lifetime_value, '2001-07-15' AS last_contact_date,
         (c_custkey % 2 = 0) AS opted_in_marketing, '2001-07-31' AS export_date
  FROM customer),
bronze_crm AS (
  SELECT * EXCLUDE (k) FROM crm_base
  UNION ALL SELECT * EXCLUDE (k) REPLACE ('VIP' AS segment, '2001-08-01' AS export_date) FROM crm_base WHERE k % 20 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE (concat('E', customer_id) AS customer_id, NULL AS email,
                                          '2001-08-01' AS export_date) FROM crm_base WHERE k % 61 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE (concat('V', customer_id) AS customer_id, 'bad' AS lifetime_value,
                                          '2001-08-01' AS export_date) FROM crm_base WHERE k % 67 = 0)"""

_SQL_CLICKS = """click_base AS (
  SELECT event_id AS k, CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id, event_type,
         concat(user_id, '-', json_extract_string(props, '$.k')) AS session_id,
         concat(replace(CAST(ts AS VARCHAR), ' ', 'T'), 'Z') AS timestamp
  FROM events),
bronze_clicks AS (
  SELECT * EXCLUDE (k) FROM click_base
  UNION ALL SELECT * EXCLUDE (k) FROM click_base WHERE k % 10 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE (concat('N', event_id) AS event_id, NULL AS customer_id) FROM click_base WHERE k % 97 = 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE (concat('T', event_id) AS event_id, NULL AS event_type) FROM click_base WHERE k % 89 = 0)"""

_RUN = "CAST('2001-08-01 02:00:00' AS TIMESTAMP)"

# The newest version per order by a join with the highest sequence number; deletions and unusable rows out.
_SQL_SILVER_ORDERS = f"""silver_orders AS (
  SELECT o.order_id, o.customer_id, TRY_CAST(o.order_date AS TIMESTAMP) AS order_date, o.total_amount,
         upper(trim(o.status, ' ')) AS status, CAST(year(TRY_CAST(o.order_date AS TIMESTAMP)) AS INTEGER) AS order_year,
         CAST(month(TRY_CAST(o.order_date AS TIMESTAMP)) AS INTEGER) AS order_month, {_RUN} AS processed_at
  FROM bronze_orders o JOIN (SELECT order_id, max(seq) AS seq FROM bronze_orders GROUP BY order_id) n
    ON o.order_id = n.order_id AND o.seq = n.seq
  WHERE o.op <> 'D' AND o.customer_id IS NOT NULL AND o.total_amount > 0)"""

_SQL_SILVER_CRM = f"""silver_crm AS (
  SELECT c.* REPLACE (lower(trim(c.email, ' ')) AS email, TRY_CAST(c.lifetime_value AS DOUBLE) AS lifetime_value,
                      CAST(c.last_contact_date AS DATE) AS last_contact_date), {_RUN} AS processed_at
  FROM bronze_crm c JOIN (SELECT customer_id, max(export_date) AS export_date FROM bronze_crm GROUP BY customer_id) n
    ON c.customer_id = n.customer_id AND c.export_date = n.export_date
  WHERE c.email IS NOT NULL)"""

_SQL_SILVER_CLICKS = f"""silver_clicks AS (
  SELECT DISTINCT *, CAST(replace(replace(timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_ts,
         CAST(substr(timestamp, 1, 10) AS DATE) AS event_date, CAST(substr(timestamp, 12, 2) AS INTEGER) AS event_hour,
         {_RUN} AS processed_at
  FROM bronze_clicks WHERE customer_id IS NOT NULL AND event_type IS NOT NULL)"""


def _sql_rfm(as_of: date) -> str:
    return f"""rfm AS (
  SELECT customer_id, CAST(date_diff('day', CAST(max(order_date) AS DATE), DATE '{as_of}') AS INTEGER) AS recency_days,
         count(order_id) AS frequency, round(sum(total_amount), 2) AS monetary_value,
         max(order_date) AS last_order_date, min(order_date) AS first_order_date,
         count(DISTINCT order_id) FILTER (status = 'RETURNED') AS return_count
  FROM silver_orders GROUP BY customer_id)"""


_SQL_ENGAGEMENT = """engagement AS (
  SELECT customer_id, count(event_id) AS total_clicks, count(DISTINCT session_id) AS total_sessions,
         count(DISTINCT event_date) AS active_days
  FROM silver_clicks GROUP BY customer_id)"""

_SQL_FEATURES = """features AS (
  SELECT silver_crm.*, recency_days, frequency, monetary_value, last_order_date, first_order_date, return_count,
         total_clicks, total_sessions, active_days
  FROM silver_crm LEFT JOIN rfm USING (customer_id) LEFT JOIN engagement USING (customer_id))"""

# Labels by lookup: an unmatched customer falls through to the last label.
_SQL_PROFILE = f"""risked AS (
  SELECT *, CASE WHEN coalesce(recency_days, 0) <= 60 OR coalesce(frequency, 5) >= 5 THEN 'LOW'
                 WHEN recency_days <= 90 OR frequency >= 3 THEN 'MEDIUM' ELSE 'HIGH' END AS churn_risk
  FROM features),
profile AS (
  SELECT *, CASE WHEN segment = 'VIP' THEN 'Champions' WHEN churn_risk = 'HIGH' THEN 'At Risk'
                 WHEN frequency >= 10 THEN 'Loyal Customers' WHEN recency_days <= 30 THEN 'Recent Customers'
                 ELSE 'Needs Attention' END AS rfm_segment, {_RUN} AS updated_at
  FROM risked)"""

_SQL_EXPORT = """export AS (
  SELECT customer_id, first_name, last_name, email, segment,
         CAST(CAST(lifetime_value AS DECIMAL(12,2)) AS DOUBLE) AS lifetime_value, recency_days,
         CAST(frequency AS INTEGER) AS frequency,
         CAST(CAST(monetary_value AS DECIMAL(12,2)) AS DOUBLE) AS monetary_value,
         CAST(return_count AS INTEGER) AS return_count, CAST(total_clicks AS INTEGER) AS total_clicks,
         CAST(total_sessions AS INTEGER) AS total_sessions, CAST(active_days AS INTEGER) AS active_days,
         churn_risk, rfm_segment, last_order_date, updated_at
  FROM profile)"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _from_profile(select: str, kinds: str = CLEANABLE, as_of: date = AS_OF) -> str:
    return _with(
        select, _sql_orders(kinds), _SQL_CLICKS, _SQL_CRM, _SQL_SILVER_ORDERS, _SQL_SILVER_CLICKS, _SQL_SILVER_CRM,
        _sql_rfm(as_of), _SQL_ENGAGEMENT, _SQL_FEATURES, _SQL_PROFILE, _SQL_EXPORT,
    )


def _from_orders(select: str, kinds: str = CLEANABLE) -> str:
    return _with(select, _sql_orders(kinds), _SQL_SILVER_ORDERS)


def _sql_rule(table: str, rule: str, column: str, failing: str, extra: str = "") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", CASE WHEN f = 0 THEN 'Passed' ELSE 'Failed' END AS outcome, "
        f"CAST(f AS BIGINT) AS failing_rows, CAST(n AS BIGINT) AS total_rows{extra} "
        f"FROM (SELECT ({failing}) AS f, (SELECT count(*) FROM {table}) AS n)"
    )


def _sql_rules(table: str, complete: tuple[str, ...], unique: str, others: tuple[tuple[str, str, str], ...] = (), extra: str = "") -> str:
    """One SELECT per rule: ``others`` are (rule, column, condition of a good row)."""
    parts = [_sql_rule(table, "complete", c, f"SELECT count(*) - count({c}) FROM {table}", extra) for c in complete]
    repeated = f"SELECT {unique} FROM {table} GROUP BY {unique} HAVING count(*) > 1"
    parts.append(_sql_rule(table, "unique", unique, f"SELECT count(*) FROM {table} WHERE {unique} IN ({repeated})", extra))
    for rule, column, good in others:
        parts.append(_sql_rule(table, rule, column, f"SELECT count(*) FROM {table} WHERE ({good}) IS NOT TRUE", extra))
    return "\nUNION ALL ".join(parts)


_ORDER_RULES_SQL = dict(
    table="silver_orders",
    complete=("order_id", "customer_id", "order_date"),
    unique="order_id",
    others=(
        ("above", "total_amount", "total_amount > 0"),
        ("one_of", "status", "status IN ('COMPLETED', 'PENDING', 'RETURNED')"),
    ),
)
_CLICK_RULES_SQL = dict(
    table="silver_clicks", complete=("event_id", "customer_id", "event_type", "event_ts"), unique="event_id"
)
_CRM_RULES_SQL = dict(table="silver_crm", complete=("customer_id", "email"), unique="customer_id")


def _sql_logged(rules: dict, context: str) -> str:
    return _sql_rules(**rules, extra=f", '{context}' AS context, {_RUN} AS run_ts")


# The columns of the warehouse table as its declaration has them: name, type, text width, whether it must be filled.
_WAREHOUSE_COLUMNS = """customer_id varchar 20 required
first_name varchar 100
last_name varchar 100
email varchar 200
segment varchar 50
lifetime_value decimal(12,2)
recency_days int
frequency int
monetary_value decimal(12,2)
return_count int
total_clicks int
total_sessions int
active_days int
churn_risk varchar 10
rfm_segment varchar 50
last_order_date timestamp
updated_at timestamp"""


def _sql_conformance() -> str:
    """The declaration, with the measured text widths and NULLs of the export and what follows from them."""
    lines = []
    for i, line in enumerate(_WAREHOUSE_COLUMNS.split("\n"), 1):
        name, kind, *more = line.split()
        text, required = kind == "varchar", "required" in more
        kind = "string" if text else kind
        longest = f"(SELECT max(length({name})) FROM export)" if text else "NULL"
        nulls = f"(SELECT count(*) - count({name}) FROM export)" if required else "NULL"
        fits = f"coalesce({longest} <= {more[0]}, true)" if text else "true"
        filled = f"{nulls} = 0" if required else "true"
        lines.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS expected_name, '{kind}' AS expected_type, "
            f"'{name}' AS actual_name, '{kind}' AS actual_type, CAST({longest} AS INTEGER) AS longest, "
            f"CAST({nulls} AS BIGINT) AS null_rows, CASE WHEN {fits} AND {filled} THEN 'Passed' ELSE 'Failed' END AS outcome"
        )
    return "\nUNION ALL ".join(lines)


def _sql_validation() -> str:
    gold, crm = "(SELECT count(*) FROM profile)", "(SELECT count(*) FROM silver_crm)"
    empty = "(SELECT count(*) FROM profile WHERE {} IS NULL)".format
    rows = (
        ("not_empty", gold, "v > 0"),
        ("no_fanout", f"{gold} - {crm}", "v <= 0"),
        ("complete_customer_id", empty("customer_id"), "v = 0"),
        ("orders_rows", "(SELECT count(*) FROM silver_orders)", "true"),
        ("clicks_rows", "(SELECT count(*) FROM silver_clicks)", "true"),
        ("crm_rows", crm, "true"),
        ("without_orders", empty("frequency"), "true"),
        ("without_clicks", empty("total_clicks"), "true"),
    )
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS \"check\", CASE WHEN {holds} THEN 'Passed' ELSE 'Failed' END AS outcome, CAST(v AS BIGINT) AS value "
        f"FROM (SELECT {v} AS v)"
        for n, v, holds in rows
    )


def _sql_null_rates() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_rows, count(*) AS total_rows, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS null_percent FROM profile"
        for c in quality.GOLD_KEYS
    )


def oracle_sql() -> dict[str, str]:
    clicks = ", ".join(_SILVER_CLICK_RESULT)
    hours = (
        "CAST(substr(timestamp, 1, 4) AS INTEGER) AS year, CAST(substr(timestamp, 6, 2) AS INTEGER) AS month, "
        "CAST(substr(timestamp, 9, 2) AS INTEGER) AS day, CAST(substr(timestamp, 12, 2) AS INTEGER) AS hour"
    )
    silver_orders = _from_orders("SELECT * FROM silver_orders")
    silver_clicks = _with(f"SELECT {clicks} FROM silver_clicks", _SQL_CLICKS, _SQL_SILVER_CLICKS)
    silver_crm = _with("SELECT * FROM silver_crm", _SQL_CRM, _SQL_SILVER_CRM)
    export = _from_profile("SELECT * FROM export")
    rfm = _with("SELECT * FROM rfm", _sql_orders(CLEANABLE), _SQL_SILVER_ORDERS, _sql_rfm(AS_OF))
    share = "round(count(*) * 100.0 / (SELECT count(*) FROM profile), 2)::DOUBLE AS share_percent"
    return _corpus()[1] | {
        "catalog_scan": _with("SELECT * FROM bronze_orders", _sql_orders(EVERYTHING)),
        "catalog_partitions": _with(
            f"SELECT year, month, day, hour, count(*) AS rows FROM (SELECT {hours} FROM bronze_clicks) GROUP BY ALL", _SQL_CLICKS
        ),
        "bronze_json_scan": _with(f"SELECT *, {hours} FROM bronze_clicks", _SQL_CLICKS),
        "bronze_csv_scan": _with("SELECT * FROM bronze_crm", _SQL_CRM),
        "cdc_latest_state": _with(
            "SELECT * FROM bronze_orders o WHERE op <> 'D' AND NOT EXISTS "
            "(SELECT 1 FROM bronze_orders n WHERE n.order_id = o.order_id AND n.seq > o.seq)",
            _sql_orders(CHANGES),
        ),
        "crm_latest_snapshot": _with(
            "SELECT c.* FROM bronze_crm c JOIN (SELECT customer_id, max(export_date) AS d FROM bronze_crm GROUP BY 1) n "
            "ON c.customer_id = n.customer_id AND c.export_date = n.d",
            _SQL_CRM,
        ),
        # versions that share a sequence number: the larger amount stays, and the amounts are all that differs
        "incremental_orders": _from_orders(
            "SELECT * FROM silver_orders s WHERE NOT EXISTS "
            "(SELECT 1 FROM silver_orders t WHERE t.order_id = s.order_id AND t.total_amount > s.total_amount)",
            "UDNZE",
        ),
        "incremental_crm": silver_crm,
        "stream_clickstream": silver_clicks,
        "stream_clickstream_backlog": silver_clicks,
        "stream_gated": _with(
            "SELECT outcome, CAST(rows AS BIGINT) AS rows FROM (SELECT 'delivered' AS outcome, 2 * count(*) AS rows FROM bronze_clicks "
            "UNION ALL SELECT 'accepted', count(DISTINCT event_id) FROM bronze_clicks WHERE customer_id IS NOT NULL AND event_type IS NOT NULL "
            "UNION ALL SELECT 'rejected: customer_id', count(DISTINCT event_id) FROM bronze_clicks WHERE customer_id IS NULL "
            "UNION ALL SELECT 'rejected: event_type', count(DISTINCT event_id) FROM bronze_clicks WHERE customer_id IS NOT NULL AND event_type IS NULL "
            "UNION ALL SELECT 'duplicate', 2 * count(*) - count(DISTINCT event_id) FROM bronze_clicks)",
            _SQL_CLICKS,
        ),
        "unique_incremental": _with(
            "SELECT 'unique' AS rule, 'event_id' AS \"column\", CASE WHEN f = 0 THEN 'Passed' ELSE 'Failed' END AS outcome, "
            "CAST(f AS BIGINT) AS failing_rows, CAST(n AS BIGINT) AS total_rows FROM (SELECT sum(copies) AS n, "
            "coalesce(sum(copies) FILTER (WHERE copies > 1 AND event_id IS NOT NULL), 0) AS f "
            "FROM (SELECT event_id, count(*) AS copies FROM bronze_clicks GROUP BY event_id))",
            _SQL_CLICKS,
        ),
        "dedup_latest": _with(
            "SELECT * FROM bronze_orders QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, "
            "order_id DESC, total_amount DESC, status DESC, seq DESC, op DESC) = 1",
            _sql_orders(EVERYTHING),
        ),
        "silver_orders": silver_orders,
        "silver_clickstream": silver_clicks,
        "silver_crm": silver_crm,
        "silver_orders_roundtrip": silver_orders,
        "silver_clickstream_roundtrip": silver_clicks,
        "dq_orders": _from_orders(_sql_rules(**_ORDER_RULES_SQL), FAILING),
        "dq_clickstream": _with(_sql_rules(**_CLICK_RULES_SQL), _SQL_CLICKS, _SQL_SILVER_CLICKS),
        "dq_crm": _with(
            _sql_rules(**_CRM_RULES_SQL, others=(("above", "lifetime_value", "lifetime_value >= 0"),)),
            _SQL_CRM,
            _SQL_SILVER_CRM,
        ),
        "dq_results_table": _from_profile(
            "\nUNION ALL ".join(
                (
                    _sql_logged(_ORDER_RULES_SQL, "orders-silver"),
                    _sql_logged(_CLICK_RULES_SQL, "clicks-silver"),
                    _sql_logged(_CRM_RULES_SQL, "crm-silver"),
                )
            )
        ),
        "dq_gate": silver_orders,
        "gold_validation": _from_profile(_sql_validation()),
        "gold_null_rates": _from_profile(_sql_null_rates()),
        "export_conformance": _from_profile(_sql_conformance()),
        "rfm_features": rfm,
        "rfm_features_unique_orders": rfm,
        "click_features": _with("SELECT * FROM engagement", _SQL_CLICKS, _SQL_SILVER_CLICKS, _SQL_ENGAGEMENT),
        "click_features_sketched": _with(
            "SELECT customer_id, total_clicks, active_days, true AS within_bound FROM engagement",
            _SQL_CLICKS,
            _SQL_SILVER_CLICKS,
            _SQL_ENGAGEMENT,
        ),
        "customer_features": _from_profile("SELECT * FROM features"),
        "churn_risk": _from_profile("SELECT customer_id, recency_days, frequency, churn_risk FROM risked"),
        "rfm_segment": _from_profile(
            "SELECT customer_id, segment, recency_days, frequency, churn_risk, rfm_segment FROM profile"
        ),
        "customer_profile_later": _from_profile("SELECT * FROM profile", as_of=date(2001, 12, 31)),
        "gold_profile": _from_profile("SELECT * FROM profile"),
        "gold_incremental": _from_profile("SELECT * FROM profile", CLEANABLE + "D"),
        "gold_export": export,
        "warehouse_load": export,
        "publish_versioned": silver_crm,
        "end_to_end": _from_profile("SELECT * FROM export", "UDNZ"),
        "top_customers_by_value": _with(
            "SELECT customer_id, total_orders, total_spent FROM (SELECT customer_id, count(order_id) AS total_orders, "
            "round(sum(total_amount), 2) AS total_spent FROM bronze_orders WHERE status = 'completed' GROUP BY customer_id) "
            "QUALIFY row_number() OVER (ORDER BY total_spent DESC NULLS LAST, customer_id NULLS LAST) <= 10",
            _sql_orders(EVERYTHING),
        ),
        "event_counts_by_type": _with(
            "SELECT event_type, count(*) AS event_count FROM bronze_clicks GROUP BY event_type", _SQL_CLICKS
        ),
        "customers_by_segment": _with(
            "SELECT segment, count(*) AS customer_count, round(avg(TRY_CAST(lifetime_value AS DOUBLE)), 2) AS avg_lifetime_value "
            "FROM bronze_crm GROUP BY segment",
            _SQL_CRM,
        ),
        "silver_orders_quality": _from_orders(
            "SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders, "
            "count(DISTINCT customer_id) AS unique_customers, count(*) - count(total_amount) AS null_amounts, "
            "count(*) - count(order_date) AS null_dates FROM silver_orders"
        ),
        "monthly_revenue_trend": _from_orders(
            "SELECT order_year, order_month, count(*) AS order_count, round(sum(total_amount), 2) AS total_revenue "
            "FROM silver_orders GROUP BY ALL"
        ),
        "export_row_count": _from_profile("SELECT count(*) AS total_customers FROM export"),
        "churn_cohort_counts": _from_profile("SELECT churn_risk, count(*) AS customer_count FROM export GROUP BY churn_risk"),
        "export_preview": _from_profile(
            "SELECT customer_id, segment, churn_risk, rfm_segment, recency_days, frequency, monetary_value FROM export "
            "QUALIFY row_number() OVER (ORDER BY customer_id) <= 10"
        ),
        "segment_breakdown": _from_profile(
            f"SELECT rfm_segment, count(*) AS customer_count, {share} FROM profile GROUP BY rfm_segment"
        ),
        "recency_monetary_points": _from_profile("SELECT customer_id, recency_days, monetary_value, churn_risk FROM profile"),
        "late_clicks": _with(
            "SELECT event_date, count(*) AS clicks, count(*) FILTER (date_diff('second', date_trunc('second', event_ts), processed_at) "
            f"> {LATE_HOURS * 3600}) AS late_clicks, round(max(date_diff('second', date_trunc('second', event_ts), processed_at)) / 3600.0, 2) "
            "AS max_delay_hours FROM silver_clicks GROUP BY event_date",
            _SQL_CLICKS,
            _SQL_SILVER_CLICKS,
        ),
        "churn_cohort_summary": _from_profile(
            "SELECT churn_risk, count(*) AS customer_count, round(avg(recency_days), 2) AS avg_recency_days, "
            "round(avg(frequency), 2) AS avg_frequency, round(avg(monetary_value), 2) AS avg_monetary_value, "
            f"{share} FROM profile GROUP BY churn_risk"
        ),
    }
