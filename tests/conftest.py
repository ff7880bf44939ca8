from __future__ import annotations

import datetime
import uuid

import pytest

from tierflow import session

RUN_TS = datetime.datetime(2024, 3, 1, 2)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    spark = session.build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "scratch"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from tierflow.plans.flows import Lake

    return Lake.create(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "lake"))


def rows(df, *columns):
    """Rows as sorted tuples; NULL sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])
