from __future__ import annotations

import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tierflow.__main__ import main
from tierflow.functions.cleaning import clean_orders
from tierflow.operators import logs
from tierflow.schemas import BRONZE_ORDER_CHANGES, BRONZE_ORDERS
from tierflow.streaming import orders as os_

from .conftest import RUN_TS, rows
from .plans import physical


class Orders:
    """Change files, the log and its base, and a full refresh over everything delivered so far."""

    def __init__(self, spark, root, lake):
        self.spark, self.root = spark, str(root)
        self.table, self.view = lake.name("state"), lake.name("live")
        os_.create_orders_table(spark, self.table, self.root, self.view)

    def deliver(self, *changes, schema=BRONZE_ORDER_CHANGES):
        df = self.spark.createDataFrame(list(changes), BRONZE_ORDER_CHANGES)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/landing")

    def run(self, compact=False, **kwargs):
        source = os_.order_changes(self.spark, f"{self.root}/landing")
        os_.ingest_orders(source, self.table, self.root, f"{self.root}/check", RUN_TS, **kwargs).awaitTermination()
        if compact:
            self.compact()

    def compact(self):
        os_.compact_orders(self.spark, self.table, self.root, self.view)

    def live(self, *columns):
        return rows(self.spark.table(self.view), *columns)

    def full(self):
        bronze = self.spark.read.schema(BRONZE_ORDER_CHANGES).parquet(f"{self.root}/landing")
        return rows(clean_orders(bronze, RUN_TS))

    def partitions(self):
        base = os_.current_base(self.spark, self.view)
        return {r.partition for r in self.spark.sql(f"SHOW PARTITIONS {base}").collect()}

    def files(self):
        """Bytes of every file but the landed ones and the stream's own."""
        found = {}
        for folder, _, names in os.walk(self.root):
            if not folder.startswith((f"{self.root}/landing", f"{self.root}/check")):
                found.update({f"{folder}/{n}": os.path.getsize(f"{folder}/{n}") for n in names if n.endswith(".parquet")})
        return found


@pytest.fixture
def orders(spark, tmp_path, lake):
    return Orders(spark, tmp_path / "orders", lake)


def _change(order, date, amount, seq, op="U", status="completed", customer="c"):
    return (order, customer, date, amount, status, seq, op)


@pytest.mark.parametrize("compact", [False, True])
def test_incremental_equals_full_refresh_in_any_order_of_arrival(orders, compact):
    orders.deliver(
        _change("1", "2024-01-05", 1.0, 1, "I"),
        _change("2", "2024-01-06", 2.0, 1, "I"),
        _change("3", "2024-02-06", 3.0, 1, "I"),
        _change(None, "2024-02-06", 3.0, 1, "I"),
        _change("9", "2024-02-06", 3.0, 1, "I", customer=None),
    )
    orders.run(compact)
    assert orders.live() == orders.full()
    # 1 moves to March and empties nothing; 3 is deleted and empties February; 4 comes before its past.
    orders.deliver(
        _change("1", "2024-03-05", 1.5, 3),
        _change("3", "2024-02-06", 3.0, 2, "D"),
        _change("4", "2024-03-01", -4.0, 5),
    )
    orders.run(compact)
    assert orders.live() == orders.full()
    assert orders.live("order_id", "order_month") == [("1", 3), ("2", 1)]
    if compact:
        assert "live=true/order_year=2024/order_month=2" not in orders.partitions()
    # Late: older versions of all of them must change nothing, also of the deleted and the bad one.
    orders.deliver(_change("1", "2024-04-01", 9.0, 2), _change("3", "2024-02-07", 9.0, 1), _change("4", "2024-03-01", 4.0, 4))
    orders.run(compact)
    assert orders.live() == orders.full()
    assert orders.live("order_id", "total_amount") == [("1", 1.5), ("2", 2.0)]
    orders.run(compact)
    assert orders.live() == orders.full()
    orders.compact()
    assert orders.live() == orders.full() and logs.batches(orders.spark, os_._log(orders.table)) == []


@pytest.mark.parametrize("compact", [False, True])
@pytest.mark.parametrize("swapped", [False, True])
def test_ties_of_one_sequence_number_end_as_in_a_full_refresh(orders, swapped, compact):
    pairs = [
        (_change("1", "2024-01-05", 1.0, 1, status="completed"), _change("1", "2024-01-05", 1.0, 1, status="Returned")),
        (_change("2", "2024-01-05", 1.0, 1), _change("2", "2024-02-05", 1.0, 1)),
        (_change("3", "2024-01-05", 1.0, 1), _change("3", "2024-01-05", 1.0, 1, "D")),
        (_change("4", "2024-01-05", 1.0, 1), _change("4", "2024-01-05", 2.0, 1)),
    ]
    for i in (1, 0) if swapped else (0, 1):
        orders.deliver(*(pair[i] for pair in pairs))
        orders.run(compact)
    assert orders.live() == orders.full()
    assert orders.live("order_id", "status")[0] == ("1", "RETURNED")


def test_a_batch_run_again_changes_nothing(orders, spark):
    orders.deliver(*(_change(str(i), f"2024-0{i % 3 + 1}-05", float(i + 1), i) for i in range(12)))
    orders.run()
    before, log = orders.live(), os_._log(orders.table)
    (name,) = logs.batches(spark, log)
    changes = spark.read.schema(BRONZE_ORDER_CHANGES).parquet(f"{orders.root}/landing")
    for again in (name, "under another name"):
        os_.append_changes(changes, orders.table, orders.root, RUN_TS, batch=again)
        assert orders.live() == before
    orders.compact()
    os_.append_changes(changes, orders.table, orders.root, RUN_TS, batch=name)
    assert orders.live() == before


def test_readers_see_every_order_once_between_any_two_statements(orders, spark, monkeypatch):
    """The view is read before and after each statement of a batch and of a compaction."""
    orders.deliver(*(_change(str(i), f"2024-0{i % 3 + 1}-05", float(i + 1), 1, "I") for i in range(9)))
    orders.run(compact=True)
    orders.deliver(_change("1", "2024-05-05", 7.0, 2), _change("4", "2024-02-05", 4.0, 2, "D"), _change("20", "2024-01-01", 1.0, 1, "I"))
    after = sorted([(str(i),) for i in range(9) if i != 4] + [("20",)])
    before = sorted((str(i),) for i in range(9))
    seen, change = [], logs.change

    def watched(session, statement):
        seen.append((rows(spark.table(orders.view), "order_id"), statement.split()[0]))
        change(session, statement)
        seen.append((rows(spark.table(orders.view), "order_id"), statement.split()[0]))

    monkeypatch.setattr(logs, "change", watched)
    orders.run()
    assert [s for s, _ in seen] == [before, after]
    orders.compact()
    assert [s for s, _ in seen[2:]] == [after] * 4 and [k for _, k in seen[2:]] == ["CREATE", "CREATE", "ALTER", "ALTER"]
    monkeypatch.undo()
    assert orders.live() == orders.full()


@pytest.mark.parametrize("statement", ["CREATE", "ALTER"])
def test_a_compaction_that_stopped_half_way_is_completed_by_the_next(orders, spark, monkeypatch, statement):
    orders.deliver(_change("1", "2024-01-05", 1.0, 1, "I"), _change("2", "2024-01-06", 2.0, 1, "I"))
    orders.run(compact=True)
    orders.deliver(_change("1", "2024-02-05", 1.0, 2), _change("2", "2024-03-05", 2.0, 2, "D"))
    orders.run()
    change = logs.change
    monkeypatch.setattr(logs, "change", lambda s, text: 1 / 0 if text.startswith(statement) else change(s, text))
    with pytest.raises(ZeroDivisionError):
        orders.compact()
    monkeypatch.undo()
    assert orders.live() == orders.full()
    orders.compact()
    assert orders.live() == orders.full()


def test_a_batch_writes_no_more_than_its_changes(orders, spark):
    base = spark.range(20000).select(
        F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
        F.concat(F.lit("2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("-05")).alias("order_date"),
        (F.col("id") + 1.0).cast("double").alias("total_amount"), F.lit("completed").alias("status"),
        F.lit(1).cast("long").alias("seq"), F.lit("I").alias("op"),
    )
    base.coalesce(1).write.mode("append").parquet(f"{orders.root}/landing")
    orders.run(compact=True)
    whole = orders.files()
    orders.deliver(_change("3", "2024-12-05", 1.0, 2), _change("17", "2024-01-05", 1.0, 2, "D"))
    orders.run()
    written = {f: n for f, n in orders.files().items() if f not in whole}
    assert all(whole[f] == n for f, n in orders.files().items() if f in whole)
    assert written and all("/batches/" in f for f in written)
    assert sum(written.values()) < sum(whole.values()) / 20
    assert spark.table(orders.view).count() == 19999
    # a compaction rewrites the months of the two orders, old and new, and takes over the others
    orders.compact()
    months = {f.rsplit("/", 2)[1] for f in set(orders.files()) - set(whole) - set(written) if "/compacted/" in f}
    assert months == {"order_month=1", "order_month=4", "order_month=6", "order_month=12"}
    assert spark.table(orders.view).count() == 19999


def test_adding_a_batch_never_reads_the_base(orders, spark, monkeypatch):
    orders.deliver(_change("1", "2024-01-05", 1.0, 1, "I"))
    orders.run(compact=True)
    read = []
    table = spark.__class__.table
    monkeypatch.setattr(spark.__class__, "table", lambda self, name: read.append(name) or table(self, name))
    orders.deliver(_change("2", "2024-01-05", 1.0, 1, "I"))
    orders.run()
    assert read == []


def test_the_view_reads_untouched_months_without_an_exchange(orders, spark):
    orders.deliver(*(_change(str(i), f"2024-0{i % 6 + 1}-05", 1.0, 1, "I") for i in range(60)))
    orders.run(compact=True)
    orders.deliver(_change("1", "2024-02-05", 9.0, 2))
    orders.run()
    plan = physical(spark.table(orders.view).filter("order_month = 2"))
    assert "BroadcastHashJoin LeftAnti" in plan.replace("\n", " ") or "LeftAnti" in plan
    assert "order_month#" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_gate_stops_the_batch_and_leaves_the_table(orders):
    orders.deliver(_change("1", "2024-01-05", 1.0, 1, "I"))
    orders.run()
    before, log = orders.live(), logs.batches(orders.spark, os_._log(orders.table))
    orders.deliver(_change("2", "2024-01-05", 1.0, 1, status="shipped"), _change("3", "no-date", 1.0, 1))
    with pytest.raises(StreamingQueryException, match="status"):
        orders.run()
    assert orders.live() == before and logs.batches(orders.spark, os_._log(orders.table)) == log


@pytest.mark.parametrize("kind", ["typed", "text"])
def test_orders_are_read_in_the_types_they_landed_in(orders, spark, kind):
    """Timestamps and decimals of a full load without a change log, then change files; or text and doubles."""
    if kind == "typed":
        import datetime
        import decimal

        full = [("1", "c", datetime.datetime(2024, 1, 5), decimal.Decimal("1.50"), "completed"), ("2", "c", datetime.datetime(2024, 2, 5), decimal.Decimal("2.25"), "pending")]
        spark.createDataFrame(full, BRONZE_ORDERS).write.parquet(f"{orders.root}/landing")
        orders.run()
        later = [(*full[0][:3], decimal.Decimal("9.00"), "returned", 1, "U"), (*full[1], 2, "D")]
        spark.createDataFrame(later, f"{BRONZE_ORDERS}, seq long, op string").write.mode("append").parquet(f"{orders.root}/landing")
    else:
        orders.deliver(_change("1", "2024-01-05", 1.5, 1, "I"), _change("2", "2024-02-05", 2.25, 1, "I", status="pending"))
        orders.run()
        orders.deliver(_change("1", "2024-01-05", 9.0, 2, status="returned"), _change("2", "2024-02-05", 2.25, 2, "D"))
    orders.run()
    assert orders.live("order_id", "total_amount", "status", "order_month") == [("1", 9.0, "RETURNED", 1)]


def test_orders_and_compaction_from_the_command_line(spark, tmp_path):
    database = f"cli_{uuid.uuid4().hex}"
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/orders"
    made = spark.createDataFrame([_change("1", "2024-01-05", 1.0, 1, "I")], BRONZE_ORDER_CHANGES)
    made.withColumnsRenamed({"seq": "lsn", "op": "Op"}).write.parquet(landing)
    common = ["--database", database, "--location", f"{tmp_path}/lake", "--run-ts", "2024-03-01T02:00:00"]
    main([*common, "orders", "--changes", landing, "--root", root, "--checkpoint", f"{tmp_path}/check", "--seq", "lsn", "--op", "Op"])
    assert rows(spark.table(f"{database}.silver_orders_live"), "order_id") == [("1",)]
    main([*common, "compact-orders", "--root", root])
    assert rows(spark.table(f"{database}.silver_orders_live"), "order_id") == [("1",)]
    assert logs.batches(spark, f"{database}.orders_state_log") == []
