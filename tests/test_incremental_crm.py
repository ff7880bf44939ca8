from __future__ import annotations

import itertools
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from tierflow.__main__ import main
from tierflow.functions.cleaning import clean_crm
from tierflow.operators import logs, sinks
from tierflow.sources.readers import CORRUPT, read_crm, split_corrupt
from tierflow.streaming import crm

from .conftest import RUN_TS, rows

HEADER = "customer_id,first_name,last_name,email,phone,segment,lifetime_value,last_contact_date,opted_in_marketing,export_date"


class Exports:
    def __init__(self, spark, root, lake):
        self.spark, self.root, self.lake, self.files = spark, root, lake, 0
        (root / "landing").mkdir()

    def deliver(self, *lines):
        self.files += 1
        (self.root / "landing" / f"f{self.files}.csv").write_text("\n".join([HEADER, *lines]) + "\n")

    def run(self, max_files=None, **kwargs):
        source = crm.crm_source(self.spark, str(self.root / "landing"), max_files)
        crm.ingest_crm(source, self.lake, f"{self.root}/crm", f"{self.root}/check", RUN_TS, **kwargs).awaitTermination()

    def silver(self, *columns):
        return rows(self.spark.table(self.lake.name("silver_customers")), *columns)

    def full(self):
        return rows(clean_crm(split_corrupt(read_crm(self.spark, str(self.root / "landing")))[0], RUN_TS))


@pytest.fixture
def exports(spark, tmp_path, lake):
    return Exports(spark, tmp_path, lake)


def _row(customer, day, email="a@x", segment="New"):
    return f"{customer},f,l,{email},1,{segment},1.5,2024-01-01,true,2024-02-{day:02d}"


DAYS = [
    (_row("1", 1), _row("2", 1), _row("3", 1)),
    (_row("1", 2, segment="VIP"), _row("2", 2, email="")),  # 2 has no email any more
    (_row("3", 3, email=" New@X "), _row("4", 3), _row("", 3)),
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_equals_a_full_refresh_in_any_order_of_arrival(exports, order):
    for n in order:
        exports.deliver(*DAYS[n])
        exports.run()
        assert exports.silver() == exports.full()
    assert exports.silver("customer_id", "email", "segment") == [("1", "a@x", "VIP"), ("3", "new@x", "New"), ("4", "a@x", "New")]
    exports.run()
    assert exports.silver() == exports.full()


def test_only_new_files_are_read_and_all_are_in_the_log(exports, spark, monkeypatch):
    seen, fold = [], crm.fold_exports
    monkeypatch.setattr(crm, "fold_exports", lambda batch, *args: seen.append(batch.count()) or fold(batch, *args))
    for day in DAYS:
        exports.deliver(*day)
        exports.run()
    assert seen == [3, 2, 3]
    log = spark.table(exports.lake.name("customer_deliveries"))
    assert [(f.rsplit("/", 1)[1], n) for f, n in rows(log, "file", "rows")] == [("f1.csv", 3), ("f2.csv", 2), ("f3.csv", 3)]
    noted = logs.properties(spark, exports.lake.name("silver_customers"))
    assert noted["source"] == logs.batches(spark, exports.lake.name("customer_deliveries"))[-1]
    assert sinks.resolve(spark, exports.lake.name("silver_customers"))[1] == 3


def test_a_refused_delivery_is_read_again(exports, spark):
    exports.deliver(*DAYS[0])
    exports.run()
    before = exports.silver()
    exports.deliver(_row("1", 2, segment="VIP"), "5,too,short")
    with pytest.raises(StreamingQueryException, match="crm-bronze"):
        exports.run()
    assert exports.silver() == before
    exports.run(allow_corrupt=True)
    assert exports.silver("customer_id", "segment") == [("1", "VIP"), ("2", "New"), ("3", "New")]
    log = spark.table(exports.lake.name("customer_deliveries")).filter("kind = 'corrupt'")
    assert rows(log, CORRUPT) == [("5,too,short",)]


def test_a_delivery_cut_off_between_its_two_moves_is_completed(exports, monkeypatch):
    exports.deliver(*DAYS[0])
    exports.run()
    exports.deliver(*DAYS[1])

    def half(spark, targets, **kwargs):
        sinks.move(spark, dict(itertools.islice(targets.items(), 1)), **kwargs)
        raise ZeroDivisionError

    monkeypatch.setattr(crm, "move", half)
    with pytest.raises(StreamingQueryException):
        exports.run()
    monkeypatch.undo()
    exports.run()
    assert exports.silver() == exports.full()


def test_customers_and_gold_from_the_command_line(spark, tmp_path):
    database = f"cli_{uuid.uuid4().hex}"
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing/f.csv").write_text(HEADER + "\n" + _row("1", 1) + "\n")
    common = ["--database", database, "--location", f"{tmp_path}/lake", "--run-ts", "2024-03-01T02:00:00"]
    main([*common, "customers", "--crm", f"{tmp_path}/landing", "--root", f"{tmp_path}/crm", "--checkpoint", f"{tmp_path}/check"])
    assert rows(spark.table(f"{database}.silver_customers"), "customer_id") == [("1",)]
    from tierflow.streaming import clicks, orders

    orders.create_orders_table(spark, f"{database}.orders_state", f"{tmp_path}/orders", f"{database}.silver_orders_live")
    clicks.create_click_tables(spark, f"{database}.silver_clicks", f"{tmp_path}/clicks")
    main([*common, "gold-incremental", "--root", f"{tmp_path}/gold", "--as-of", "2024-03-01"])
    assert rows(spark.table(f"{database}.customer_profile"), "customer_id", "churn_risk") == [("1", "LOW")]
