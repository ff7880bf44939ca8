from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import __main__ as command
from tierflow import session
from tierflow.functions.cleaning import clean_orders
from tierflow.operators import quality, sinks
from tierflow.plans import flows
from tierflow.sources import readers, shapes
from tierflow.sources.readers import CORRUPT

from .conftest import RUN_TS, rows
from .plans import physical

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 8, 1)


def _bronze(spark):
    return shapes.bronze_orders(spark, SF, "UDNZ"), shapes.bronze_clicks(spark, SF), shapes.bronze_crm(spark, SF)


def test_rerun_publishes_the_same(spark, lake):
    seen = []
    for _ in range(2):
        flows.run_silver(lake, *_bronze(spark), RUN_TS)
        gold, export = flows.run_gold(spark, lake, AS_OF, RUN_TS)
        loaded = flows.load_warehouse(spark, lake, buckets=2)
        seen.append((rows(gold), rows(export), rows(loaded)))
    assert seen[0] == seen[1]


def test_invariants(spark, lake):
    flows.run_silver(lake, *_bronze(spark), RUN_TS)
    gold, export = flows.run_gold(spark, lake, AS_OF, RUN_TS)
    crm, orders = spark.table(lake.name("silver_customers")), spark.table(lake.name("silver_orders"))
    assert gold.count() == export.count() == crm.count()
    assert gold.agg(F.sum("frequency")).first()[0] <= orders.count()
    assert gold.filter("churn_risk is null or rfm_segment is null").count() == 0
    assert gold.filter("frequency is null").count() > 0
    assert rows(gold.select("updated_at").distinct()) == rows(export.select("updated_at").distinct()) == [(RUN_TS,)]


def test_gold_reads_each_silver_table_once(spark, lake, monkeypatch):
    """Row counts are those noted on the versions; the checks read the profile alone."""
    flows.run_silver(lake, *_bronze(spark), RUN_TS)
    names = {"orders": "silver_orders", "clicks": "silver_clicks", "crm": "silver_customers"}
    counts = {side: spark.table(lake.name(t)).count() for side, t in names.items()}
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("a table was counted again"))
    assert {side: sinks.resolve(spark, lake.name(t))[1] for side, t in names.items()} == counts
    seen, taken = [], quality.gold_counts
    monkeypatch.setattr(quality, "gold_counts", lambda gold, rows: seen.append((taken(gold, rows), rows)) or seen[-1][0])
    profiles, store = [], flows.store
    monkeypatch.setattr(flows, "store", lambda df, *a, **k: profiles.append(df) or store(df, *a, **k))
    flows.run_gold(spark, lake, AS_OF, RUN_TS)
    ((checked, noted),) = seen
    assert noted == counts
    assert physical(checked).count("Location: ") == 1 and "customer_profile__" in physical(checked)
    assert physical(profiles[0]).count("Location: ") == 3


def test_a_value_too_large_for_the_export_publishes_nothing(spark, lake):
    orders, clicks, crm = _bronze(spark)
    flows.run_silver(lake, orders, clicks, crm, RUN_TS)
    names = [lake.name("customer_profile"), lake.name("profile_export")]
    flows.run_gold(spark, lake, AS_OF, RUN_TS)
    before = [rows(spark.table(n)) for n in names]
    flows.refresh_orders(lake, orders.withColumn("total_amount", F.col("total_amount") * 1e9), RUN_TS)
    with pytest.raises(ArithmeticException):
        flows.run_gold(spark, lake, AS_OF, RUN_TS)
    assert [rows(spark.table(n)) for n in names] == before
    assert [len(sinks.versions(spark, n)) for n in names] == [1, 1]


def test_profile_and_export_move_after_both_are_checked(spark, lake, monkeypatch):
    flows.run_silver(lake, *_bronze(spark), RUN_TS)
    steps, store = [], flows.store
    monkeypatch.setattr(flows, "store", lambda *a, **k: steps.append("store") or store(*a, **k))
    monkeypatch.setattr(flows, "move", lambda spark, targets, **k: steps.extend(targets) or sinks.move(spark, targets, **k))
    flows.run_gold(spark, lake, AS_OF, RUN_TS)
    names = [lake.name("customer_profile"), lake.name("profile_export")]
    assert steps == ["store", "store", *names]
    noted = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {names[1]}").collect()}
    assert noted["source"] == sinks.current_version(spark, names[0])


def test_a_corrupt_export_line_stops_the_refresh(spark, lake):
    bad = spark.sql(f"SELECT 'C1,?,Yes' AS {CORRUPT}")
    good = shapes.bronze_crm(spark, SF)
    flows.refresh_crm(lake, good, RUN_TS)
    before = rows(spark.table(lake.name("silver_customers")))
    with pytest.raises(quality.QualityError):
        flows.refresh_crm(lake, good.unionByName(bad, allowMissingColumns=True), RUN_TS)
    assert rows(spark.table(lake.name("silver_customers"))) == before
    assert rows(spark.table(lake.name("rejected_customers")), CORRUPT) == [("C1,?,Yes",)]
    report = spark.table(lake.name("dq_results")).filter("context = 'crm-bronze'")
    assert rows(report, "outcome", "failing_rows") == [("Failed", 1)]
    flows.refresh_crm(lake, good.unionByName(bad, allowMissingColumns=True), RUN_TS, allow_corrupt=True)


def test_orders_are_read_in_the_types_they_landed_in(spark, tmp_path):
    full = "SELECT '1' AS order_id, 'c' AS customer_id, timestamp'2024-01-02 03:04:05' AS order_date, cast(12.50 AS decimal(10,2)) AS total_amount, 'completed' AS status"
    spark.sql(full).write.parquet(str(tmp_path / "orders" / "full"))
    spark.sql(full.replace("12.50", "99.99") + ", 7L AS seq, 'U' AS op").write.parquet(str(tmp_path / "orders" / "changes"))
    landed = readers.read_orders(spark, str(tmp_path / "orders" / "*"))
    assert rows(clean_orders(landed, RUN_TS), "order_id", "total_amount", "order_year", "order_month") == [("1", 99.99, 2024, 1)]


def test_corrupt_lines_are_kept(spark, lake):
    bad = spark.sql(f"SELECT '{{broken' AS {CORRUPT}")
    bronze = shapes.bronze_clicks(spark, SF).unionByName(bad, allowMissingColumns=True)
    flows.refresh_clicks(lake, bronze, RUN_TS)
    assert rows(spark.table(lake.name("rejected_clicks")), CORRUPT) == [("{broken",)]
    assert CORRUPT not in spark.table(lake.name("silver_clicks")).columns


def test_command_line(spark, lake, tmp_path):
    orders, clicks, crm = _bronze(spark)
    paths = {
        "orders": shapes.land_orders(orders, str(tmp_path / "orders")),
        "clicks": shapes.land_clicks(clicks, str(tmp_path / "clicks")),
        "crm": shapes.land_crm(crm, str(tmp_path / "crm")),
    }
    common = ["--database", lake.database, "--run-ts", "2001-08-01T02:00:00"]
    command.main([*common, "silver", *(a for k, v in paths.items() for a in (f"--{k}", v))])
    command.main([*common, "gold", "--as-of", "2001-08-01"])
    command.main([*common, "load", "--buckets", "2"])
    state = ["--changes", paths["orders"], "--root", str(tmp_path / "state"), "--checkpoint", str(tmp_path / "check")]
    command.main([*common, "orders", *state])
    assert spark.table(lake.name("warehouse_profile")).count() == spark.table(lake.name("customer_profile")).count() > 0
    full = rows(spark.table(lake.name("customer_profile")))
    command.main([*common, "gold", "--as-of", "2001-08-01", "--orders-table", "silver_orders_live"])
    assert rows(spark.table(lake.name("customer_profile"))) == full
    live = spark.table(lake.name("silver_orders_live"))
    assert rows(live) == rows(spark.table(lake.name("silver_orders")).select(*live.columns))


def test_scratch_is_below_the_shared_folder(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch(spark, "x").startswith(f"{shared}/tierflow/x-")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    for master in ("yarn", "local-cluster[2,1,1024]"):
        Session.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.scratch(Session(), "x")
    Session.sparkContext.master = "local[2]"
    assert "/x-" in session.scratch(Session(), "x")
