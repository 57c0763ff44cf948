"""Table specifications, catalog, table creation and the 36-table load check."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from adspark.operators.catalog import select_tables, table_catalog
from adspark.operators.load import create_table_from_spec
from adspark.plans.ingest import clean_files
from adspark.sources.files import whole_files
from adspark.specs import get_spec, load_specs


def test_spec_counts():
    specs = load_specs()
    assert len(specs) == 36
    assert sum(s.table_type == "report" for s in specs) == 21
    assert sum(s.table_type == "entity" for s in specs) == 15
    assert sum(len(s.columns) for s in specs) == 1332


def test_spec_keys_and_partitions():
    for s in load_specs():
        assert set(s.merge_columns) <= set(s.column_names), s.name
        assert len(set(s.column_names)) == len(s.column_names)
        if s.table_type == "report":
            assert s.partition_column == "date"
            if s.load_method == "delete_insert":
                assert s.merge_columns == ("profileId", "date")
        else:
            assert s.partition_column is None
            assert s.merge_columns == ("profileId",)
            assert s.load_method == "delete_insert"


def test_unknown_table_raises():
    with pytest.raises(KeyError):
        get_spec("report", "DSP", "campaign")


def test_catalog_and_select(spark):
    cat = table_catalog(spark)
    assert cat.count() == 1332
    sp = select_tables(cat, types=["report"], ad_types=["SP", ""], names=[])
    assert {r["ad_type"] for r in sp.select("ad_type").distinct().collect()} == {"SP"}
    assert sp.select("name").distinct().count() == 8
    assert select_tables(cat, types=[" "], ad_types=[], names=[]).count() == 1332
    keys = cat.filter("table_type = 'report' AND ad_type = 'SB' AND name = 'keyword' AND is_key")
    assert keys.count() == 7


def _value(t: str, i: int):
    return {"INT64": 100 + i, "FLOAT64": 1.5 + i, "STRING": f"s{i}", "TIMESTAMP": f"2024-03-2{i} 10:00:00",
            "BOOLEAN": i % 2 == 0}[t]


def _write_table_file(root: str, spec) -> str:
    stamped = {"marketplace", "profileId", "last_updated"}
    rows = []
    for i in range(3):
        row = {c: _value(t, i) for c, t in spec.columns if c not in stamped}
        if spec.table_type == "entity" and "servingStatus" in row:
            row["extendedData"] = {"creationDateTime": "2024-01-01T00:00:00", "lastUpdateDateTime": None,
                                   "servingStatus": "RUNNING", "servingStatusDetails": [{"name": "OK"}]}
            for k in ("creationDateTime", "lastUpdateDateTime", "servingStatus", "servingStatusDetails"):
                row.pop(k, None)
        rows.append(row)
    if spec.table_type == "report":
        d = os.path.join(root, "reports", spec.ad_type, spec.name, "US", "7", "123", "20240320-20240322")
    else:
        d = os.path.join(root, "entities", spec.ad_type, spec.name, "US", "7", "123")
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, "data.json.gz")
    with gzip.open(path, "wt", encoding="utf-8") as f:
        json.dump(rows, f)
    return path


def test_all_36_tables_load_3_rows(spark, tmpdir_path):
    now = F.lit("2024-04-01 00:00:00").cast("timestamp")
    for spec in load_specs():
        path = _write_table_file(tmpdir_path, spec)
        out = clean_files(whole_files(spark, path), spec, now=now).drop("_file", "_mtime")
        assert out.schema == spec.spark_schema() or [
            (f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in spec.spark_schema().fields], spec
        rows = out.collect()
        assert len(rows) == 3, spec
        assert all(r["profileId"] == "123" for r in rows)
        if spec.table_type == "report":
            assert all(r["marketplace"] == "ATVPDKIKX0DER" for r in rows)
        if "servingStatus" in spec.column_names and spec.table_type == "entity":
            assert rows[0]["servingStatus"] == "RUNNING"
            assert json.loads(rows[0]["servingStatusDetails"]) == [{"name": "OK"}]


def test_create_all_tables(spark, tmpdir_path):
    for spec in load_specs():
        name = create_table_from_spec(spark, spec, location=os.path.join(tmpdir_path, spec.dataset, spec.table_name),
                                      database=f"t_{spec.dataset}")
        cols = spark.table(name).columns
        assert cols[:-2] == spec.column_names
        assert cols[-2:] == ["account_id", "day" if spec.partition_column else "_bucket"]
    # idempotent and droppable
    spec = get_spec("report", "SP", "campaign")
    create_table_from_spec(spark, spec, location=os.path.join(tmpdir_path, "again"), database="t_ads_sp", drop=True)
