from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierflow.operators import logs
from tierflow.operators.quality import QualityError, Unique, evaluate, gate, record
from tierflow.streaming import uniqueness

from .conftest import RUN_TS, rows

RULE = Unique("id")


class Keys:
    def __init__(self, spark, root, lake):
        self.spark, self.root, self.log = spark, str(root), lake.name("ids")
        uniqueness.create_counts(spark, self.log, self.root)

    def deliver(self, *ids):
        self.frame(ids).coalesce(1).write.mode("append").parquet(f"{self.root}/landing")

    def frame(self, ids):
        return self.spark.createDataFrame([(i, "x") for i in ids], "id string, other string")

    def run(self, max_files=None):
        reader = self.spark.readStream.schema("id string, other string")
        reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
        uniqueness.count_keys(reader.parquet(f"{self.root}/landing"), RULE, self.log, self.root, f"{self.root}/check").awaitTermination()

    def report(self, *added):
        return uniqueness.report(self.spark, self.log, RULE, *added)

    def full(self, *added):
        return evaluate(self.spark.read.schema("id string, other string").parquet(f"{self.root}/landing"), [RULE], *added)


@pytest.fixture
def keys(spark, tmp_path, lake):
    return Keys(spark, tmp_path, lake)


DELIVERIES = [("a", "b", None, None, "c"), ("d", "e"), ("b", "f", None), ("b", "a", "g", "g")]


def test_report_equals_the_full_check_after_each_delivery(keys):
    for delivery in DELIVERIES:
        keys.deliver(*delivery)
        keys.run()
        assert rows(keys.report()) == rows(keys.full())
    assert rows(uniqueness.repeated_keys(keys.spark, keys.log)) == [("a", 2), ("b", 3), ("g", 2)]


def test_a_key_repeated_in_another_batch_fails_the_gate(keys, lake):
    keys.deliver("a", "b")
    keys.run()
    gate(record(keys.report("ids", RUN_TS), lake.name("dq_results")), "ids")
    keys.deliver("c", "a")
    keys.run()
    line = record(keys.report("ids", RUN_TS), lake.name("dq_results"))
    assert rows(line) == rows(keys.full("ids", RUN_TS))
    with pytest.raises(QualityError) as error:
        gate(line, "ids")
    assert (error.value.failed[0]["failing_rows"], error.value.failed[0]["total_rows"]) == (2, 4)


def test_a_batch_writes_what_it_repeats_and_nothing_old(keys):
    keys.deliver(*(f"k{i}" for i in range(500)), *(f"k{i}" for i in range(200)))
    keys.run()
    for n in range(4):
        keys.deliver(f"new{n}", "k7")
        keys.run()
    sizes = {r["batch"]: r["n"] for r in keys.spark.table(keys.log).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    # the repeated key and the number of rows; the first batch has 200 repeated keys
    assert [sizes[b] for b in sorted(sizes)] == [201, 2, 2, 2, 2]


def test_many_micro_batches_and_compaction_between(keys, monkeypatch):
    for delivery in DELIVERIES * 2:
        keys.deliver(*delivery)
    keys.run(max_files=1)
    want, seen, change = rows(keys.full()), [], logs.change

    def watched(spark, statement):
        change(spark, statement)
        spark.catalog.refreshTable(keys.log)
        seen.append(rows(keys.report()))

    monkeypatch.setattr(logs, "change", watched)
    before = logs.batches(keys.spark, keys.log)
    uniqueness.compact_counts(keys.spark, keys.log, keys.root)
    assert len(before) == 8 and len(logs.batches(keys.spark, keys.log)) == 2
    # between any two statements a reader finds the same figures
    assert seen == [want, want] and rows(keys.report()) == want
    keys.deliver("a", "z")
    keys.run()
    uniqueness.compact_counts(keys.spark, keys.log, keys.root)
    assert rows(keys.report()) == rows(keys.full())


def test_a_repeated_batch_changes_nothing(keys, tmp_path):
    keys.deliver(*DELIVERIES[0])
    keys.run()
    keys.deliver(*DELIVERIES[3])
    keys.run()
    # the checkpoint forgets that the last batch ended, as after a crash behind the commit of its folder
    for name in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    keys.run()
    assert rows(keys.report()) == rows(keys.full())


def test_nothing_delivered(keys):
    assert rows(keys.report()) == [("unique", "id", "Passed", 0, 0)]
    keys.deliver()
    keys.run()
    assert rows(keys.report()) == rows(keys.full())

