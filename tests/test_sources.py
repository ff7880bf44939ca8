from __future__ import annotations

import gzip
import json

import pytest

from tierflow.schemas import BRONZE_CUSTOMERS, BRONZE_PRODUCTS, CLICK_FOLDERS
from tierflow.sources import catalog, readers

from .conftest import rows

CLICK = {
    "event_id": "1", "customer_id": "c", "event_type": "search", "page": "/home", "product_id": "p",
    "session_id": "s", "timestamp": "2024-01-02T03:04:05.000006Z", "device": "mobile", "country": "CA",
}


def _land(root, hour, *lines):
    folder = root / "year=2024" / "month=01" / "day=02" / f"hour={hour:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"part-{len(list(folder.iterdir()))}.gz", "wt") as f:
        f.write("".join(line + "\n" for line in lines))


def test_clicks_with_folders_and_corrupt_lines(spark, tmp_path):
    _land(tmp_path, 3, json.dumps(CLICK), "{broken", json.dumps({**CLICK, "event_id": "2", "extra": 1}))
    _land(tmp_path, 13, json.dumps({"event_id": "3"}))
    good, bad = readers.split_corrupt(readers.read_clicks(spark, str(tmp_path)))
    assert rows(good, "event_id", "customer_id", *CLICK_FOLDERS) == [
        ("1", "c", 2024, 1, 2, 3), ("2", "c", 2024, 1, 2, 3), ("3", None, 2024, 1, 2, 13),
    ]
    assert [(r[readers.CORRUPT], r["hour"]) for r in bad.collect()] == [("{broken", 3)]


HEADER = (
    "customer_id,first_name,last_name,email,phone,segment,lifetime_value,last_contact_date,"
    "opted_in_marketing,export_date\n"
)


def test_crm_days_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "export_1.csv").write_text(HEADER + 'a,"Ann, A.",L,a@x,1,VIP,1.5,2024-01-01,True,2024-02-01\n')
    (tmp_path / "export_2.csv").write_text(HEADER + "b,B,L,,1,New,x,,False,2024-02-02\nc,C,L,c@x,1,New,1,,maybe,2024-02-02\n")
    good, bad = readers.split_corrupt(readers.read_crm(spark, str(tmp_path)))
    assert rows(good, "customer_id", "first_name", "email", "lifetime_value", "opted_in_marketing") == [
        ("a", "Ann, A.", "a@x", "1.5", True),
        ("b", "B", None, "x", False),
    ]
    assert bad.collect()[0]["customer_id"] == "c"


def test_crm_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "export.csv").write_text(HEADER.replace("email,phone", "phone,email") + "a,A,L,1,a@x,VIP,1,,True,2024-02-01\n")
    with pytest.raises(Exception, match="header"):
        readers.read_crm(spark, str(tmp_path)).collect()


def test_other_sources(spark, tmp_path):
    for name, schema in (("customers", BRONZE_CUSTOMERS), ("products", BRONZE_PRODUCTS)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        assert readers.read_parquet(spark, str(tmp_path / name), schema).count() == 0


def test_register_discovers_schema_and_partitions(spark, lake, tmp_path):
    landing = tmp_path / "clicks"
    _land(landing, 3, json.dumps(CLICK))
    name = lake.name("bronze_clicks")
    table = catalog.register(spark, name, str(landing), "json", partition_by=CLICK_FOLDERS)
    assert {"event_id", "hour"} <= set(table.columns)
    assert rows(catalog.scan(spark, lake.database, "bronze_clicks"), "event_id", "hour") == [("1", 3)]
    _land(landing, 4, json.dumps({**CLICK, "event_id": "2"}))
    assert spark.table(name).count() == 1
    assert catalog.repair(spark, name).count() == 2
    assert rows(spark.table(name).filter("hour = 4"), "event_id") == [("2",)]


def test_register_with_options(spark, lake, tmp_path):
    (tmp_path / "export.csv").write_text(HEADER + "a,A,L,a@x,1,VIP,1,,True,2024-02-01\n")
    table = catalog.register(spark, lake.name("bronze_crm"), str(tmp_path), "csv", header="true", inferSchema="true")
    assert dict(table.dtypes)["opted_in_marketing"] == "boolean"
    assert table.count() == 1


def test_a_known_name_is_not_given_to_other_files_or_columns(spark, tmp_path, lake):
    from tierflow.sources import catalog

    for folder in ("a", "b"):
        spark.range(3).write.parquet(f"{tmp_path}/{folder}")
    name = lake.name("known")
    catalog.register(spark, name, f"{tmp_path}/a")
    assert catalog.register(spark, name, f"file:{tmp_path}/a/", schema="id long").count() == 3
    with pytest.raises(ValueError, match="registered at"):
        catalog.register(spark, name, f"{tmp_path}/b")
    with pytest.raises(ValueError, match="other columns"):
        catalog.register(spark, name, f"{tmp_path}/a", schema="id long, more string")
