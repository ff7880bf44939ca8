from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow.operators import sinks
from tierflow.operators.quality import QualityError
from tierflow.schemas import EXPORT, Field
from tierflow.sources.readers import read_silver

from .conftest import RUN_TS, rows
from .plans import physical

LATER = RUN_TS + dt.timedelta(hours=1)


def _months(spark, n=60):
    return spark.range(n).select("id", F.lit(2024).alias("order_year"), (F.col("id") % 6).cast("int").alias("order_month"))


def _refuse(_):
    raise QualityError("no", [], [])


def test_overwrite_replaces_all_or_only_touched_partitions(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["order_year", "order_month"]
    sinks.overwrite(_months(spark), path, by)
    assert read_silver(spark, path).count() == 60
    sinks.overwrite(_months(spark, 1), path, by, only_touched=True)
    assert read_silver(spark, path).count() == 51
    sinks.overwrite(_months(spark, 1), path, by)
    assert read_silver(spark, path).count() == 1
    sinks.overwrite(spark.range(3), path)
    assert read_silver(spark, path).count() == 3


def test_partition_filter_reaches_the_scan(spark, tmp_path, lake):
    sinks.overwrite(_months(spark), str(tmp_path / "t"), ["order_year", "order_month"])
    published = sinks.publish(_months(spark), lake.name("orders"), RUN_TS, ["order_year", "order_month"])
    for df in (read_silver(spark, str(tmp_path / "t")), published, spark.table(lake.name("orders"))):
        plan = physical(df.filter("order_month = 3").select("id"))
        assert "order_month" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_publish_keeps_readers_on_a_good_version(spark, lake):
    name = lake.name("t")
    sinks.publish(spark.range(3), name, RUN_TS)
    reader = spark.table(name)
    with pytest.raises(QualityError):
        sinks.publish(spark.range(9), name, LATER, checks=[_refuse])
    assert spark.table(name).count() == 3
    assert len(sinks.versions(spark, name)) == 1
    sinks.publish(spark.range(4), name, LATER)
    assert spark.table(name).count() == 4
    assert reader.count() == 3


def test_publish_drops_versions_beyond_keep(spark, lake):
    name = lake.name("t")
    sinks.publish(spark.range(1), lake.name("t_other"), RUN_TS)
    for hour in range(4):
        sinks.publish(spark.range(hour), name, RUN_TS + dt.timedelta(hours=hour), keep=2)
    left = sinks.versions(spark, name)
    assert [spark.table(v).count() for v in left] == [2, 3]
    assert sinks.versions(spark, lake.name("t_other"))


def test_publish_same_run_twice(spark, lake):
    for _ in range(2):
        sinks.publish(spark.range(5), lake.name("t"), RUN_TS)
    assert spark.table(lake.name("t")).count() == 5


def test_checks_see_stored_rows_once(spark, lake):
    """The plan runs once: what the checks saw is what is published, even for a plan that differs."""
    seen = []
    rolls = spark.range(50).select(F.rand().alias("x"))
    sinks.publish(rolls, lake.name("t"), RUN_TS, checks=[lambda staged: seen.append(rows(staged))])
    assert rows(spark.table(lake.name("t"))) == seen[0]


@pytest.fixture
def export(spark):
    columns = [F.lit(None).cast(f.type).alias(f.name) for f in EXPORT]
    risks = F.element_at(F.array(*map(F.lit, ("LOW", "MEDIUM", "HIGH"))), (F.col("id") % 3 + 1).cast("int"))
    named = {"customer_id": F.col("id").cast("string"), "churn_risk": risks}
    return spark.range(100).select(*(named.get(f.name, c).alias(f.name) for f, c in zip(EXPORT, columns)))


def test_warehouse_load(spark, lake, export):
    name = lake.name("warehouse")
    sinks.create_bucketed_table(spark, name, buckets=4)
    for _ in range(2):
        assert sinks.load_table(export, name).count() == 100
    assert sinks.load_table(export.limit(10), name, mode="append").count() == 110
    with pytest.raises(ValueError):
        sinks.load_table(export, name, mode="merge")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["customer_id"] == "varchar(20)"
    assert described["Num Buckets"] == "4" and described["Sort Columns"] == "[`churn_risk`, `rfm_segment`]"


def test_warehouse_load_writes_one_file_per_bucket_and_needs_no_exchange(spark, lake, export):
    name = lake.name("warehouse")
    sinks.create_bucketed_table(spark, name, buckets=4)
    table = sinks.load_table(export, name)
    assert len(table.inputFiles()) == 4
    counts = table.groupBy("customer_id").count()
    assert "Exchange" not in physical(counts)
    assert counts.count() == 100


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("customer_id", F.lit(None).cast("string")),
        lambda df: df.withColumn("customer_id", F.repeat(F.lit("x"), 21)),
        lambda df: df.withColumn("frequency", F.lit(1).cast("long")),
        lambda df: df.drop("updated_at"),
    ],
)
def test_warehouse_refuses_what_does_not_fit(spark, lake, export, change):
    name = lake.name("warehouse")
    sinks.create_bucketed_table(spark, name, buckets=2)
    sinks.load_table(export, name)
    with pytest.raises(QualityError):
        sinks.load_table(change(export), name)
    assert spark.table(name).count() == 100


def test_load_into_a_table_without_buckets(spark, lake):
    fields = [Field("a", "bigint")]
    spark.sql(f"CREATE TABLE {lake.name('plain')} (a bigint) USING parquet")
    assert sinks.load_table(spark.range(3).toDF("a"), lake.name("plain"), fields).count() == 3


def test_a_bucketed_table_with_another_layout_is_refused(spark, lake):
    name = lake.name("warehouse")
    sinks.create_bucketed_table(spark, name, buckets=2)
    sinks.create_bucketed_table(spark, name, buckets=2)
    with pytest.raises(ValueError):
        sinks.create_bucketed_table(spark, name, buckets=64)


def test_a_load_that_fails_while_writing_leaves_the_old_table(spark, lake, export, monkeypatch):
    source, name = lake.name("export"), lake.name("warehouse")
    sinks.publish(export, source, RUN_TS)
    first = sinks.publish_bucketed(spark, source, name, buckets=2)
    before = rows(spark.table(name))
    assert first.count() == len(before) == 100
    sinks.publish(export.limit(10), source, LATER)
    load = sinks.load_table
    lost = F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise("")
    monkeypatch.setattr(sinks, "load_table", lambda df, table, mode: df.withColumn("customer_id", lost).write.insertInto(table))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_bucketed(spark, source, name, buckets=2)
    assert rows(spark.table(name)) == before and len(sinks.versions(spark, name)) == 1
    monkeypatch.setattr(sinks, "load_table", load)
    with pytest.raises(ValueError):
        sinks.publish_bucketed(spark, source, name, buckets=4)
    for hour in range(2, 5):
        reader = spark.table(name)
        held = reader.count()
        sinks.publish(export.limit(10 + hour), source, RUN_TS + dt.timedelta(hours=hour))
        assert sinks.publish_bucketed(spark, source, name).count() == 10 + hour
        assert reader.count() == held and len(sinks.versions(spark, name)) <= 2
    counts = spark.table(name).groupBy("customer_id").count()
    assert "Exchange" not in physical(counts) and counts.count() == 14
