from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.functions.cleaning import clean_orders
from tierflow.operators.dedup import apply_changes, dedup_latest, latest_snapshot
from tierflow.schemas import BRONZE_ORDER_CHANGES

from .conftest import RUN_TS, rows

SCHEMA = "k string, seq long, op string, v double"
changes = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.one_of(st.none(), st.integers(0, 4)),
        st.sampled_from(["I", "U", "D", None]),
        st.sampled_from([1.0, 2.0, None]),
    ),
    min_size=1,
    max_size=25,
)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _best(data):
    """Brute force: largest row per key, NULL smallest."""
    rank = lambda row: [(v is not None, v) for v in row[1:]]
    best = {}
    for row in data:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    return best


@few
@given(data=changes, parts=st.integers(1, 5), seed=st.randoms(use_true_random=False))
def test_dedup_depends_on_rows_alone(spark, data, parts, seed):
    shuffled = list(data)
    seed.shuffle(shuffled)
    expected = sorted(_best(data).values(), key=str)
    for given_rows, n in ((data, 1), (shuffled, parts)):
        df = spark.createDataFrame(given_rows, SCHEMA).repartition(n)
        got = sorted((tuple(r) for r in dedup_latest(df, ["k"], ["seq"]).collect()), key=str)
        assert got == expected


@few
@given(data=changes)
def test_changes_against_brute_force(spark, data):
    got = apply_changes(spark.createDataFrame(data, SCHEMA), ["k"], "seq")
    expected = [row for row in _best(data).values() if row[2] != "D"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_full_load_is_older_than_any_change(spark):
    full = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "k string, v double")
    log = spark.createDataFrame([("a", 0, "U", 9.0), ("b", 0, "D", 1.0), ("d", 5, "I", 4.0)], SCHEMA)
    state = apply_changes(log, ["k"], "seq", full_load=full)
    assert rows(state, "k", "v") == [("a", 9.0), ("c", 1.0), ("d", 4.0)]


def test_snapshot_keeps_customers_missing_from_the_newest_export(spark):
    exports = spark.createDataFrame([("a", "d1", 1), ("a", "d2", 2), ("b", "d1", 3)], "c string, day string, v int")
    assert rows(latest_snapshot(exports, ["c"], "day")) == [("a", "d2", 2), ("b", "d1", 3)]


def test_order_by_column_and_own_tie_break(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("a", 2, 1)], "k string, t int, v int")
    assert rows(dedup_latest(df, ["k"], [F.col("t").asc()], ["v"])) == [("a", 1, 6)]
    assert rows(dedup_latest(df, ["k"], [F.col("t").asc()], [F.col("v").asc()])) == [("a", 1, 5)]


def test_silver_is_stable(spark):
    data = [(str(i % 7), f"c{i % 3}", f"2024-01-{i % 28 + 1:02d}", float(i % 5), " Completed", i, "I") for i in range(40)]
    once = clean_orders(spark.createDataFrame(data, BRONZE_ORDER_CHANGES), RUN_TS)
    assert rows(clean_orders(once, RUN_TS)) == rows(once)
