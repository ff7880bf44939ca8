"""One key holding a third of all rows: results stay whole, and little of it crosses the exchange."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow.functions.features import click_features, rfm_features
from tierflow.operators.dedup import dedup_latest
from tierflow.operators.quality import Unique, evaluate
from tierflow.operators.sinks import overwrite
from tierflow.sources.readers import read_silver

from .conftest import rows

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "t")
    hot = F.col("id") % 3 == 0
    (
        spark.range(0, N, 1, 8)
        .select(
            F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 1000)).alias("customer_id"),
            F.col("id").cast("string").alias("order_id"),
            F.col("id").cast("string").alias("event_id"),
            F.concat(F.lit("s"), F.col("id") % 700).alias("session_id"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 50).cast("int")).alias("event_date"),
            F.timestamp_seconds(F.col("id")).alias("order_date"),
            (F.col("id") % 100).cast("double").alias("total_amount"),
            F.when(F.col("id") % 5 == 0, "RETURNED").otherwise("PENDING").alias("status"),
            F.when(hot, 1).otherwise((F.col("id") % 12 + 1).cast("int")).alias("order_month"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def _exchanged(df) -> list[int]:
    """Records written by each exchange of the executed plan."""
    df.collect()
    found = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_dedup_sends_one_row_per_key_and_task(skewed):
    newest = dedup_latest(skewed, ["customer_id"], ["order_date"], ["order_id"])
    (sent,) = _exchanged(newest)
    keys, tasks = 668, 8
    assert sent <= keys * tasks < N / 3
    expected = skewed.toPandas().sort_values("order_date").groupby("customer_id").order_id.last()
    assert dict(rows(newest, "customer_id", "order_id")) == expected.to_dict()


def test_features_of_a_hot_customer(skewed):
    pdf = skewed.toPandas()
    clicks = click_features(skewed)
    got = {r[0]: tuple(r[1:]) for r in clicks.collect()}
    want = pdf.groupby("customer_id").agg(c=("event_id", "count"), s=("session_id", "nunique"), d=("event_date", "nunique"))
    assert got == {k: tuple(v) for k, v in zip(want.index, want.itertuples(index=False))}
    rfm = {r[0]: (r["frequency"], r["return_count"]) for r in rfm_features(skewed, dt.date(2024, 1, 1)).collect()}
    returned = pdf[pdf.status == "RETURNED"].groupby("customer_id").order_id.nunique()
    assert rfm["hot"] == (N // 3, returned["hot"])
    assert rfm == {
        r[0]: (r["frequency"], r["return_count"])
        for r in rfm_features(skewed, dt.date(2024, 1, 1), unique_orders=True).collect()
    }


def test_a_repeated_key_costs_one_count_per_task(skewed):
    report = evaluate(skewed, [Unique("customer_id")])
    assert rows(report, "outcome", "failing_rows", "total_rows") == [("Failed", N, N)]
    assert max(_exchanged(report)) <= 668 * 8


def test_a_hot_partition_is_split_over_files(spark, skewed, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        overwrite(skewed, str(tmp_path / "t"), ["order_month"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = read_silver(spark, str(tmp_path / "t")).inputFiles()
    hot = [f for f in files if "order_month=1/" in f]
    assert len(hot) > 1
    assert read_silver(spark, str(tmp_path / "t")).count() == N
