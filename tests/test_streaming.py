from __future__ import annotations

import json
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tierflow.__main__ import main
from tierflow.functions.cleaning import clean_clicks
from tierflow.operators import logs
from tierflow.operators.quality import OneOf
from tierflow.plans import reports
from tierflow.sources.readers import CORRUPT, read_clicks, split_corrupt
from tierflow.streaming import clicks as cs

from .conftest import RUN_TS, rows


def _line(event_id, time, customer="c", kind="search"):
    return json.dumps({"event_id": event_id, "customer_id": customer, "event_type": kind, "session_id": "s", "timestamp": time})


class Clicks:
    """A landing folder, the stream that reads it, and its tables."""

    def __init__(self, spark, root, lake):
        self.spark, self.landing, self.root, self.check = spark, root / "landing", f"{root}/clicks", f"{root}/check"
        self.name, self.files = lake.name("silver_clicks"), 0
        self.landing.mkdir()
        cs.create_click_tables(spark, self.name, self.root)

    def deliver(self, *lines):
        self.files += 1
        (self.landing / f"f{self.files}.json").write_text("\n".join(lines) + "\n")

    def start(self, source=None, **kwargs):
        raw = cs.click_source(self.spark, str(self.landing), folders=False, **(source or {}))
        return cs.ingest_clicks(raw, self.name, self.root, self.check, RUN_TS, **kwargs)

    def run(self, **kwargs):
        with cs.Progress(self.spark, self.name, self.root) as progress:
            progress.finish(self.start(**kwargs))

    def bronze(self):
        return split_corrupt(read_clicks(self.spark, str(self.landing), folders=False))[0]

    def table(self, suffix=""):
        return self.spark.table(self.name + suffix)

    def silver(self, *columns):
        return rows(self.table(), *(columns or ("event_id",)))

    def compact(self):
        cs.compact_clicks(self.spark, self.name, self.root)

    def balance(self):
        found = {r["outcome"]: r["rows"] for r in cs.balance(self.spark, self.name).collect()}
        assert found["delivered"] == sum(n for k, n in found.items() if k != "delivered")
        return found


@pytest.fixture
def clicks(spark, tmp_path, lake):
    return Clicks(spark, tmp_path, lake)


def test_duplicates_within_and_across_runs(clicks):
    clicks.deliver(_line("1", "2024-01-02T10:00:00Z"), _line("1", "2024-01-02T10:00:00Z"), _line("2", "2024-01-02T11:00:00Z"))
    clicks.run()
    clicks.deliver(_line("2", "2024-01-02T11:00:00Z"), _line("3", "2024-01-02T12:00:00Z"))
    clicks.run()
    clicks.run()
    assert clicks.silver() == [("1",), ("2",), ("3",)]
    assert clicks.balance() == {"delivered": 5, "duplicate": 2, "accepted": 3}


def test_late_rows_are_kept_however_late_and_counted(clicks):
    clicks.deliver(_line("now", "2024-02-29T10:00:00Z"))
    clicks.run()
    clicks.deliver(_line("nine days", "2024-02-11T10:00:00Z"), _line("twelve hours", "2024-02-29T22:00:00Z"))
    clicks.run()
    assert clicks.silver() == [("nine days",), ("now",), ("twelve hours",)]
    assert rows(reports.late_clicks(clicks.table(), hours=6), "clicks", "late_clicks", "max_delay_hours") == [(1, 1, 448.0), (2, 1, 16.0)]
    progress = clicks.table("_progress").orderBy("batch").collect()
    assert [(r["batch"], r["delivered"], r["late_rows"]) for r in progress] == [(0, 1, 1), (1, 2, 2)]
    assert all(r["max_lateness_hours"] > 24 for r in progress)


def test_a_backlog_in_any_order_of_files_is_kept_whole(clicks):
    """Files of forty days, newest and oldest mixed, four to a micro-batch, some lines delivered twice."""
    days = sorted(range(40), key=lambda d: (d * 17) % 40)
    stamp = lambda d: f"2024-0{1 + d // 28}-{1 + d % 28:02d}T10:00:00Z"
    for n, d in enumerate(days):
        again = [_line(f"{days[n - 3]}-0", stamp(days[n - 3]))] if n % 4 == 3 else []
        clicks.deliver(*(_line(f"{d}-{i}", stamp(d)) for i in range(5)), *again)
    clicks.run(source={"max_files": 4})
    assert clicks.silver() == sorted((f"{d}-{i}",) for d in days for i in range(5))
    assert clicks.balance() == {"delivered": 210, "duplicate": 10, "accepted": 200}
    clicks.compact()
    assert clicks.silver() == sorted((f"{d}-{i}",) for d in days for i in range(5))


def test_copies_on_different_days_are_one_event_in_any_micro_batch(clicks):
    clicks.deliver(_line("1", "2024-01-02T23:59:59Z"), _line("2", "2024-01-02T11:00:00Z"))
    clicks.deliver(_line("1", "2024-01-03T00:00:01Z"), _line("3", "2024-01-03T11:00:00Z"))
    clicks.run(source={"max_files": 1})
    assert clicks.silver() == [("1",), ("2",), ("3",)]


def test_rows_that_break_a_rule_are_kept_with_the_reason_and_counted(clicks):
    bad = ["{broken", _line("2", "soon"), _line("3", None), _line(None, "2024-01-02T10:00:00Z"), _line("4", "2024-01-02T10:00:00Z", None), _line("5", "2024-01-02T10:00:00Z", "c", None)]
    clicks.deliver(_line("1", "2024-01-02T10:00:00Z"), *bad)
    clicks.run()
    clicks.deliver(*bad, _line("4", "2024-01-02T10:00:00Z"))
    clicks.run()
    assert clicks.silver() == [("1",), ("4",)]
    kept = [(None, "corrupt", "{broken"), (None, "event_id", None), ("2", "event_ts", None), ("3", "event_ts", None), ("4", "customer_id", None), ("5", "event_type", None)]
    assert rows(clicks.table("_rejected"), "event_id", "reason", CORRUPT) == kept
    assert clicks.balance() == {
        "delivered": 14, "duplicate": 6, "accepted": 2, "rejected: corrupt": 1, "rejected: event_id": 1,
        "rejected: event_ts": 2, "rejected: customer_id": 1, "rejected: event_type": 1,
    }
    report = rows(clicks.table("_report"), "rule", "column", "outcome", "failing_rows", "total_rows")
    assert ("complete", "customer_id", "Failed", 2, 7) in report and ("complete", "customer_id", "Passed", 0, 1) in report
    assert len(report) == 2 * 5


@pytest.mark.parametrize("compacted", [False, True])
def test_a_micro_batch_run_again_changes_nothing(clicks, spark, compacted):
    for n in range(3):
        clicks.deliver(_line(f"{n}", "2024-01-02T10:00:00Z"), _line(f"x{n}", None))
        clicks.run()
    before, balance, log = clicks.silver(), clicks.balance(), f"{clicks.name}_log"
    newest = logs.batches(spark, log)[-1]
    if compacted:
        clicks.compact()
        assert logs.batches(spark, log) == [newest]  # a stream may repeat it, so it stays
    again = cs.judged(read_clicks(spark, str(clicks.landing / "f3.json"), folders=False))
    cs.append_batch(again, clicks.name, clicks.root, newest, RUN_TS)
    assert clicks.silver() == before and clicks.balance() == balance


def test_a_stream_that_was_cut_off_before_its_checkpoint_repeats_the_batch(clicks, spark, monkeypatch):
    clicks.deliver(_line("1", "2024-01-02T10:00:00Z"), _line("1", "2024-01-02T10:00:00Z"))
    append = cs.append_batch
    monkeypatch.setattr(cs, "append_batch", lambda *args, **kwargs: append(*args, **kwargs) or 1 / 0)
    with pytest.raises(StreamingQueryException):
        clicks.start().awaitTermination()
    monkeypatch.undo()
    clicks.deliver(_line("2", "2024-01-02T10:00:00Z"))
    clicks.run()
    assert clicks.silver() == [("1",), ("2",)]
    assert clicks.balance() == {"delivered": 3, "duplicate": 1, "accepted": 2}


def test_a_gate_that_fails_shows_nothing_of_the_batch(clicks, monkeypatch):
    clicks.deliver(_line("1", "2024-01-02T10:00:00Z"))
    clicks.run()
    clicks.deliver(_line("2", "2024-01-02T10:00:00Z", kind="odd"), "{broken")
    append = cs.append_batch
    only = [OneOf("event_type", ("search",))]
    monkeypatch.setattr(cs, "append_batch", lambda *args, **kwargs: append(*args, **kwargs, rules=only))
    with pytest.raises(StreamingQueryException, match="event_type"):
        clicks.start().awaitTermination()
    assert clicks.silver() == [("1",)] and rows(clicks.table("_rejected")) == [] and clicks.table("_report").count() == 5


def test_stream_equals_batch(clicks):
    for f in range(4):
        times = [f"2024-01-02T{10 + f}:{m:02d}:00Z" for m in range(0, 60, 5)]
        event = lambda i: _line(f"{f}-{i}", times[i], None if i % 5 == 0 else "c", None if i % 7 == 0 else "x")
        clicks.deliver(*(event(i % 9) for i in range(12)))
    clicks.run(source={"max_files": 1}, files_per_batch=2)
    batch = clean_clicks(clicks.bronze(), RUN_TS)
    assert clicks.silver(*batch.columns) == rows(batch)
    clicks.compact()
    assert clicks.silver(*batch.columns) == rows(batch)


def test_a_micro_batch_looks_up_its_own_ids_and_reads_nothing_of_the_table(clicks, spark, monkeypatch):
    """Ten equal batches: the reads of the state follow the batch, not what has been taken in."""
    for n in range(10):
        clicks.deliver(*(_line(f"{n}-{i}", "2024-01-02T10:00:00Z") for i in range(200)), *(_line(f"0-{i}", "2024-01-02T10:00:00Z") for i in range(20)))
    read = []
    table = spark.__class__.table
    monkeypatch.setattr(spark.__class__, "table", lambda self, name: read.append(name) or table(self, name))
    query = clicks.start(source={"max_files": 1})
    query.awaitTermination()
    assert read == []
    monkeypatch.undo()
    progress = sorted(query.recentProgress, key=lambda p: p.batchId)
    reads = [p.stateOperators[0].customMetrics["rocksdbGetCount"] for p in progress if p.numInputRows]
    assert len(reads) == 10 and max(reads) <= 2 * 220 + 50 and max(reads[1:]) <= 1.2 * min(reads[1:])
    assert progress[-1].stateOperators[0].numRowsTotal == 2000 == clicks.table().count()


def test_flushes_by_time_and_bytes(clicks, spark):
    """A processing-time trigger really run: every flush is a batch of at most so many bytes, in the files asked for."""
    for n in range(6):
        clicks.deliver(*(_line(f"{n}-{i}", f"2024-01-0{n + 1}T10:00:00Z") for i in range(50)))
    size = (clicks.landing / "f1.json").stat().st_size
    query = clicks.start(source={"max_bytes": 2 * size + 10}, interval="1 second", files_per_batch=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    names = logs.batches(spark, f"{clicks.name}_log")
    assert len(names) == 3
    for name in names:
        flushed = logs.read(spark, f"{clicks.name}_log", [name])
        assert flushed.filter("kind = 'accepted'").count() == 100
        # one file of rows and one of the report
        assert len(flushed.inputFiles()) == 2
    assert clicks.table().count() == 300


def test_readers_see_every_click_once_during_a_compaction(clicks, spark, monkeypatch):
    for n in range(3):
        clicks.deliver(*(_line(f"{n}-{i}", f"2024-01-0{i + 1}T10:00:00Z") for i in range(3)), _line(f"bad {n}", None))
        clicks.run()
        if n == 1:
            clicks.compact()
    whole, seen, change = (clicks.silver(), rows(clicks.table("_rejected"), "event_id"), clicks.table("_report").count()), [], logs.change

    def look():
        seen.append((clicks.silver(), rows(clicks.table("_rejected"), "event_id"), clicks.table("_report").count()))

    def watched(session, statement):
        look()
        change(session, statement)
        look()

    monkeypatch.setattr(logs, "change", watched)
    clicks.compact()
    assert len(seen) == 10 and all(s == whole for s in seen)


@pytest.mark.parametrize("stop_at", range(1, 6))
def test_a_compaction_cut_off_anywhere_is_completed_by_the_next(clicks, spark, monkeypatch, stop_at):
    for n in range(2):
        clicks.deliver(_line(f"{n}", f"2024-01-0{n + 1}T10:00:00Z"), _line(f"bad {n}", None))
        clicks.run()
    whole, change, done = (clicks.silver(), clicks.balance()), logs.change, []

    def cut_off(session, statement):
        done.append(statement)
        if len(done) == stop_at:
            raise ZeroDivisionError
        change(session, statement)

    monkeypatch.setattr(logs, "change", cut_off)
    with pytest.raises(ZeroDivisionError):
        clicks.compact()
    monkeypatch.undo()
    assert (clicks.silver(), clicks.balance()) == whole
    clicks.compact()
    assert (clicks.silver(), clicks.balance()) == whole
    assert len(logs.batches(spark, f"{clicks.name}_log")) == 1


def test_a_fully_refreshed_table_is_not_mixed_with_the_stream(spark, tmp_path, lake):
    from tierflow.operators.sinks import publish

    publish(spark.range(3), lake.name("silver_clicks"), RUN_TS)
    with pytest.raises(ValueError, match="full refresh"):
        cs.create_click_tables(spark, lake.name("silver_clicks"), str(tmp_path))


def test_clicks_and_compaction_from_the_command_line(spark, tmp_path):
    database, root = f"cli_{uuid.uuid4().hex}", f"{tmp_path}/clicks"
    folder = tmp_path / "landing/year=2024/month=1/day=2/hour=10"
    folder.mkdir(parents=True)
    common = ["--database", database, "--location", f"{tmp_path}/lake"]
    for n in range(2):
        (folder / f"f{n}.json").write_text(_line("1", "2024-01-02T10:00:00Z") + "\n" + _line(f"2{n}", "2024-01-02T10:00:00Z") + "\n")
        main([*common, "clicks", "--clicks", f"{tmp_path}/landing", "--root", root, "--checkpoint", f"{tmp_path}/check", "--files", "1"])
    main([*common, "compact-clicks", "--root", root])
    assert rows(spark.table(f"{database}.silver_clicks"), "event_id") == [("1",), ("20",), ("21",)]
    assert len(logs.batches(spark, f"{database}.silver_clicks_log")) == 1
