from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierflow.operators import logs, quality
from tierflow.plans import flows, incremental
from tierflow.schemas import BRONZE_CLICKS, BRONZE_CRM, BRONZE_ORDER_CHANGES
from tierflow.sources.readers import CORRUPT
from tierflow.streaming import clicks as cs
from tierflow.streaming import orders as os_

from .conftest import RUN_TS, rows

AS_OF = dt.date(2024, 6, 1)


class Gold:
    """Order and click logs, a CRM table, and gold from them both ways."""

    def __init__(self, spark, root, lake, customers="abcde"):
        self.spark, self.root, self.lake, self.files = spark, str(root), lake, 0
        self.orders, self.clicks = (lake.name("orders_state"), lake.name("silver_orders_live")), lake.name("silver_clicks")
        os_.create_orders_table(spark, self.orders[0], f"{root}/orders", self.orders[1])
        cs.create_click_tables(spark, self.clicks, f"{root}/clicks")
        crm = [(c, "f", "l", f"{c}@x", "1", "New", "1", "2024-01-01", True, "2024-01-01") for c in customers]
        flows.refresh_crm(lake, spark.createDataFrame(crm, BRONZE_CRM), RUN_TS)
        (root / "clicks_in").mkdir(parents=True)

    def deliver(self, orders=(), clicks=(), stream=False):
        """Orders as (id, customer, date, amount, seq, op), clicks as (id, customer, session, day); as batches of the logs
        or, with ``stream``, as landed files."""
        made = [(o, c, d, a, "returned" if a == 5.0 else "completed", s, op) for o, c, d, a, s, op in orders]
        if not stream:
            self.files += 1
            if orders:
                changes = self.spark.createDataFrame(made, BRONZE_ORDER_CHANGES)
                os_.append_changes(changes, self.orders[0], f"{self.root}/orders", RUN_TS, batch=f"orders-{self.files:09d}")
            if clicks:
                raw = [(e, c, "x", None, None, s, f"{d}T10:00:00Z", None, None, None) for e, c, s, d in clicks]
                judged = cs.judged(self.spark.createDataFrame(raw, f"{BRONZE_CLICKS}, {CORRUPT} string"))
                cs.append_batch(judged, self.clicks, f"{self.root}/clicks", f"clicks-{self.files:09d}", RUN_TS)
            return
        if orders:
            self.spark.createDataFrame(made, BRONZE_ORDER_CHANGES).coalesce(1).write.mode("append").parquet(f"{self.root}/orders_in")
            source = os_.order_changes(self.spark, f"{self.root}/orders_in")
            os_.ingest_orders(source, self.orders[0], f"{self.root}/orders", f"{self.root}/check_o", RUN_TS).awaitTermination()
        if clicks:
            self.files += 1
            lines = [
                json.dumps({"event_id": e, "customer_id": c, "session_id": s, "event_type": "x", "timestamp": f"{d}T10:00:00Z"})
                for e, c, s, d in clicks
            ]
            with open(f"{self.root}/clicks_in/f{self.files}.json", "w") as file:
                file.write("\n".join(lines) + "\n")
            raw = cs.click_source(self.spark, f"{self.root}/clicks_in", folders=False)
            cs.ingest_clicks(raw, self.clicks, f"{self.root}/clicks", f"{self.root}/check_c", RUN_TS).awaitTermination()

    def run(self):
        return incremental.run_gold_incremental(self.spark, self.lake, f"{self.root}/gold", AS_OF, RUN_TS)

    def full(self):
        crm, orders, clicks = (self.spark.table(t) for t in (self.lake.name("silver_customers"), self.orders[1], self.clicks))
        return flows.customer_profile(crm, orders, clicks, AS_OF, RUN_TS)

    def check(self):
        gold, export = self.run()
        full = self.full()
        assert gold.columns == full.columns and rows(gold) == rows(full) and export.count() == full.count()
        noted = rows(self.spark.table(self.lake.name("dq_results")).filter("context = 'profile' AND rule = 'rows'"), "column", "total_rows")
        assert ("orders", self.spark.table(self.orders[1]).count()) in noted and ("clicks", self.spark.table(self.clicks).count()) in noted
        return {r["customer_id"]: r for r in gold.collect()}

    def compact(self):
        taken = lambda table: incremental.taken(self.spark, self.lake, f"{table}_log")
        os_.compact_orders(self.spark, self.orders[0], f"{self.root}/orders", self.orders[1], only=taken(self.orders[0]))
        cs.compact_clicks(self.spark, self.clicks, f"{self.root}/clicks", only=taken(self.clicks))
        incremental.compact_state(self.spark, self.lake)


@pytest.fixture
def gold(spark, tmp_path, lake):
    return Gold(spark, tmp_path, lake)


FIRST = dict(
    orders=[
        ("1", "a", "2024-01-05", 10.0, 1, "I"), ("2", "a", "2024-03-05", 5.0, 1, "I"), ("3", "b", "2024-02-05", 7.0, 1, "I"),
        ("4", "c", "2024-02-06", 8.0, 1, "I"), ("9", "not in the CRM", "2024-02-06", 8.0, 1, "I"),
    ],
    clicks=[("e1", "a", "s1", "2024-01-01"), ("e2", "a", "s1", "2024-01-02"), ("e3", "b", None, "2024-01-01"), ("e4", "z", "s", "2024-01-01")],
)
SECOND = dict(
    # the newest order of a goes to another customer, the only one of b is deleted, the one of c moves to another month
    orders=[("2", "d", "2024-03-05", 5.0, 2, "U"), ("3", "b", "2024-02-05", 7.0, 2, "D"), ("4", "c", "2024-05-06", 8.5, 2, "U")],
    clicks=[("e5", "a", "s1", "2024-01-02"), ("e6", "a", "s2", "2024-01-03"), ("e7", "e", "s9", "2024-01-03")],
)


@pytest.mark.parametrize("compact", [True])
def test_equals_a_full_run_after_corrections_deletions_and_late_versions(gold, compact):
    gold.deliver(**FIRST, stream=True)
    assert gold.check()["a"]["frequency"] == 2
    if compact:
        gold.compact()
    copied = [("e2", "a", "s1", "2024-01-02")]
    gold.deliver(SECOND["orders"], SECOND["clicks"] + copied, stream=True)
    found = gold.check()
    assert found["b"]["frequency"] is None and found["d"]["return_count"] == 1 and found["a"]["last_order_date"].month == 1
    assert (found["a"]["total_clicks"], found["a"]["total_sessions"], found["a"]["active_days"]) == (4, 2, 3)
    if compact:
        gold.compact()
    # late: older versions of all of them, and one that brings b back
    gold.deliver(orders=[("2", "a", "2024-04-05", 50.0, 1, "U"), ("4", "c", "2024-01-06", 1.0, 1, "U"), ("3", "b", "2024-02-07", 7.5, 3, "U")], stream=True)
    assert gold.check()["b"]["monetary_value"] == 7.5
    gold.check()


def test_a_run_without_news_takes_everything_over(gold, monkeypatch):
    gold.deliver(**FIRST)
    before = rows(gold.run()[0])
    monkeypatch.setattr(incremental, "features", lambda state: pytest.fail("features were computed again"))
    assert rows(gold.run()[0]) == before
    assert len(logs.batches(gold.spark, incremental._log(gold.lake))) == 1


def test_only_touched_customers_are_aggregated_again(gold, monkeypatch):
    gold.deliver(**FIRST)
    gold.run()
    seen, features = [], incremental.features
    monkeypatch.setattr(incremental, "features", lambda state: seen.append(state) or features(state))
    gold.deliver(orders=[("2", "d", "2024-03-05", 5.0, 2, "U")], clicks=[("e9", "e", "s", "2024-01-01")])
    gold.check()
    (state,) = seen
    # the customer that lost an order, the one that has it now, the one that clicked
    assert {r["customer_id"] for r in state.select("customer_id").distinct().collect()} == {"a", "d", "e"}


def test_what_a_run_writes_follows_the_news(gold):
    """Of a long history only the months and customers of the new batch come into the state."""
    days = [f"2023-{1 + i % 12:02d}-05" for i in range(240)]
    gold.deliver(orders=[(f"o{i}", "abcde"[i % 5], d, 1.0, 1, "I") for i, d in enumerate(days)], clicks=[(f"e{i}", "abcde"[i % 5], f"s{i}", d) for i, d in enumerate(days)])
    gold.check()
    log = incremental._log(gold.lake)
    first = {n: logs.read(gold.spark, log, [n]).count() for n in logs.batches(gold.spark, log)}
    gold.deliver(orders=[("o7", "c", days[7], 2.0, 2, "U")], clicks=[("new", "c", "s2", days[0])])
    gold.check()
    (new,) = set(logs.batches(gold.spark, log)) - set(first)
    assert logs.read(gold.spark, log, [new]).filter("part NOT LIKE 'taken%'").count() == 3 < sum(first.values()) / 50


def test_a_run_cut_off_after_its_state_is_made_up_for(gold, monkeypatch):
    gold.deliver(**FIRST)
    gold.check()
    gold.deliver(**SECOND)
    monkeypatch.setattr(incremental, "refresh_features", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        gold.run()
    monkeypatch.undo()
    gold.deliver(clicks=[("e8", "c", "s8", "2024-01-03")])
    gold.check()


def test_a_run_cut_off_before_its_state_counts_nothing_twice(gold, monkeypatch):
    gold.deliver(**FIRST)
    commit = logs.commit
    monkeypatch.setattr(logs, "commit", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        gold.run()
    monkeypatch.setattr(logs, "commit", commit)
    gold.check()


def test_a_failed_check_publishes_nothing_and_the_next_run_catches_up(gold, monkeypatch):
    gold.deliver(**FIRST)
    before = rows(gold.run()[0])
    gold.deliver(**SECOND)
    gate = quality.gate
    monkeypatch.setattr(quality, "gate", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        gold.run()
    monkeypatch.setattr(quality, "gate", gate)
    assert rows(gold.spark.table(gold.lake.name("customer_profile"))) == before
    gold.check()


def test_the_state_reads_the_same_during_its_compaction(gold, spark, monkeypatch):
    gold.deliver(**FIRST)
    gold.run()
    gold.deliver(**SECOND)
    gold.run()
    read = lambda: rows(incremental.features(spark.table(gold.lake.name("gold_state"))))
    whole, seen, change = read(), [], logs.change

    def watched(session, statement):
        seen.append(read())
        change(session, statement)
        seen.append(read())

    monkeypatch.setattr(logs, "change", watched)
    incremental.compact_state(spark, gold.lake)
    assert len(seen) == 4 and all(s == whole for s in seen)


def test_batches_that_were_not_taken_are_not_compacted_away(gold, spark):
    gold.deliver(**FIRST)
    gold.run()
    gold.deliver(**SECOND)
    gold.compact()
    assert len(logs.batches(spark, f"{gold.orders[0]}_log")) == 1
    gold.check()


def test_sets_of_a_hot_customer_are_rows(gold, spark):
    clicks = spark.range(6000).select(
        F.lit("hot").alias("customer_id"), F.concat(F.lit("s"), F.col("id") % 3000).alias("session_id"),
        F.col("id").cast("string").alias("event_id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 50).cast("int")).alias("event_date"),
    )
    partials = incremental.click_partials(clicks)
    assert partials.count() == 3050 and partials.filter("part = 'session'").agg(F.sum("clicks")).first()[0] == 6000
    again = incremental.click_partials(clicks.limit(100))
    both = partials.withColumn("number", F.lit(1)).unionByName(again.withColumn("number", F.lit(2)))
    (row,) = incremental.features(both).collect()
    assert (row["total_clicks"], row["total_sessions"], row["active_days"], row["frequency"]) == (6100, 3000, 50, None)


def test_the_state_is_merged_by_hashing_and_changed_months_are_looked_up_once(gold, monkeypatch):
    gold.deliver(**FIRST)
    gold.check()
    state = incremental._state(gold.spark, gold.lake)
    plan = incremental.merged(state)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    given, real = [], incremental.order_partials

    def watched(orders, pairs=None):
        given.append(pairs._jdf.queryExecution().executedPlan().toString())
        return real(orders, pairs)

    monkeypatch.setattr(incremental, "order_partials", watched)
    gold.deliver(**SECOND)
    gold.check()
    assert len(given) == 1 and "Exchange" not in given[0] and "Join" not in given[0]
    deleted = state.sparkSession.table(gold.lake.name("gold_state")).filter("customer_id = 'b' AND part = 'month' AND number = 2")
    assert rows(deleted, "value", "orders", "amount", "returned") == [("2024-02", 0, None, None)]
