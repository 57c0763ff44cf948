"""Normalisation: names, casts (D2, D3), flattening (D4), tokens, sanitisers."""

import datetime
import json

import pytest

from adspark.functions import (normalize_column_name, parse_timestamp, sanitize_string, truncate_with_ellipsis)
from adspark.operators import normalize as N


@pytest.mark.parametrize("raw,want", [
    ("a (b)", "a_b"), ("x-y", "x_y"), ("p.q/r,s", "pqrs"), ("[k]", "_k_"), ("Cost (USD) ", "Cost_USD"),
    ("a b?", "a_b_"), ("{x}", "_x_"),
])
def test_normalize_column_name(raw, want):
    assert normalize_column_name(raw) == want


def test_normalize_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, `a b` int")
    with pytest.raises(ValueError):
        N.normalize_columns(df)
    ok = N.normalize_columns(spark.createDataFrame([(1,)], "`x (y)` int"))
    assert ok.columns == ["x_y"]


def test_cast_edge_rows(spark):
    df = spark.createDataFrame([
        ("", None, "", "none"), (None, "abc", None, "null"), ("abc", "1.5", "x", "2024-03-20"),
        ("5.0", "nan", "y", "2024-03-20 10:11:12"), ("9007199254740993", "2", "z", "1711000000000"),
        ("7", "3", "w", "1711000000"),
    ], "l string, d string, s string, t string")
    spec = [("l", "INT64"), ("d", "FLOAT64"), ("s", "STRING"), ("t", "TIMESTAMP"), ("b", "BOOLEAN")]
    typed, rejects = N.cast_to_schema(df, spec, add_missing=True)
    rows = typed.collect()
    assert [r["l"] for r in rows] == [0, 0, 0, 5, 9007199254740993, 7]
    assert [r["d"] for r in rows] == [0.0, 0.0, 1.5, 0.0, 2.0, 3.0]
    assert [r["s"] for r in rows] == ["", "", "x", "y", "z", "w"]
    ts = [r["t"] for r in rows]
    assert ts[0] is None and ts[1] is None
    assert ts[2] == datetime.datetime(2024, 3, 20)
    assert ts[3] == datetime.datetime(2024, 3, 20, 10, 11, 12)
    assert ts[4] == datetime.datetime(2024, 3, 21, 5, 46, 40)
    assert ts[5] == datetime.datetime(2024, 3, 21, 5, 46, 40)
    assert all(r["b"] is None for r in rows)
    bad = {r["column"]: r["rejected"] for r in rejects.collect()}
    assert bad == {"l": 1, "d": 1}
    with pytest.raises(ValueError):
        N.cast_to_schema(df, spec, fail_fast=True)


def test_parse_timestamp_iso_t(spark):
    df = spark.createDataFrame([("2024-03-20T10:00:00",), ("20240320",), ("03/20/2024",), ("NONE",)], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert got[:3] == [datetime.datetime(2024, 3, 20, 10), datetime.datetime(2024, 3, 20), datetime.datetime(2024, 3, 20)]
    assert got[3] is None


def test_flatten_budget_struct_and_scalar(spark):
    s = spark.createDataFrame([(1, (12.5, "DAILY"))], "id int, budget struct<budget: double, budgetType: string>")
    r = N.flatten_campaign_budget(s).first()
    assert (r["budget"], r["budgetType"]) == (12.5, "DAILY")
    t = spark.createDataFrame([(1, '{"budget": 3, "budgetType": "LIFETIME"}', None), (2, "7.5", "DAILY")],
                              "id int, budget string, budgetType string")
    rows = {r["id"]: (r["budget"], r["budgetType"]) for r in N.flatten_campaign_budget(t).collect()}
    assert rows == {1: (3.0, "LIFETIME"), 2: (7.5, "DAILY")}
    p = spark.createDataFrame([(1, ("CAPPED", "USD"))], "id int, budget struct<policy: string, currencyCode: string>")
    r = N.flatten_portfolio_budget(p).first()
    assert (r["policy"], r["currencyCode"]) == ("CAPPED", "USD") and "budget" not in r.asDict()


def test_flatten_extended_and_stringify(spark):
    df = spark.createDataFrame([(1, ("2024-01-01", None, "RUNNING", [("A", 1)]), ["x", "y"])],
                               "id int, extendedData struct<creationDateTime: string, lastUpdateDateTime: string, "
                               "servingStatus: string, servingStatusDetails: array<struct<name: string, n: int>>>, "
                               "tags array<string>")
    out = N.stringify_nested(N.flatten_extended_data(df), [("tags", "STRING")]).first()
    assert out["servingStatus"] == "RUNNING"
    assert json.loads(out["servingStatusDetails"]) == [{"name": "A", "n": 1}]
    assert out["tags"] == '["x","y"]'


def test_null_tokens_and_filters(spark):
    df = spark.createDataFrame([("",), ("nan",), ("NULL",), (" None ",), (None,), ("x",), ("No",)], "v string")
    assert [r["v"] for r in N.null_tokens(df).collect()] == [None] * 5 + ["x", "No"]
    assert N.filter_push_flag(df, "v").count() == 6
    ids = spark.createDataFrame([("",), ("NOTAVAILABLE",), (None,), ("B000000001",)], "asin string")
    assert [r["asin"] for r in N.filter_identifier(ids, "asin").collect()] == ["B000000001"]


def test_sanitize_and_truncate(spark):
    text = "a\tb\u200bc d\u00a0e" + "x" * 300
    df = spark.createDataFrame([(text,), (None,), ("short",)], "t string")
    rows = df.select(sanitize_string("t", 10).alias("s"), truncate_with_ellipsis("t", 8).alias("u")).collect()
    assert rows[0]["s"] == "abc dexxxx"
    assert rows[0]["u"] == "a\tb\u200bc..."
    assert rows[1]["s"] is None and rows[1]["u"] is None
    assert rows[2]["u"] == "short"
