"""Loads: upsert / snapshot semantics, D8, idempotence, publishing."""

import os

import pytest
from pyspark.sql import functions as F

from adspark.operators import load as L

SCHEMA = "k string, p string, v int, ts int"


def _rows(df, cols=("k", "p", "v")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_merge_upsert_cases(spark):
    target = spark.createDataFrame([("a", "1", 1, 0), ("b", "1", 2, 0), ("c", "1", 3, 0), (None, "1", 9, 0)], SCHEMA)
    stage = spark.createDataFrame([("b", "1", 20, 1), ("c", "1", 3, 0), ("d", "2", 4, 1), ("d", "2", 4, 1),
                                   (None, "1", 8, 1), (None, "1", 7, 1)], SCHEMA)
    out = L.merge_upsert(target, stage, ["k"])
    assert _rows(out) == [("a", "1", 1), ("b", "1", 20), ("c", "1", 3), ("d", "2", 4), (None, "1", 7), (None, "1", 8),
                          (None, "1", 9)]
    again = L.merge_upsert(out, stage, ["k"]).filter(F.col("k").isNotNull())
    assert _rows(again) == _rows(out.filter(F.col("k").isNotNull()))


def test_merge_conflict_raise_and_latest(spark):
    target = spark.createDataFrame([("a", "1", 1, 0)], SCHEMA)
    stage = spark.createDataFrame([("a", "1", 5, 1), ("a", "1", 6, 2)], SCHEMA)
    with pytest.raises(Exception, match="conflicting"):
        L.merge_upsert(target, stage, ["k"]).collect()
    out = L.merge_upsert(target, stage, ["k"], conflict="latest_wins", order_by="ts")
    assert _rows(out) == [("a", "1", 6)]


def test_delete_insert_group_and_idempotent(spark):
    target = spark.createDataFrame([("a", "1", 1, 0), ("b", "1", 2, 0), ("c", "2", 3, 0)], SCHEMA)
    stage = spark.createDataFrame([("x", "1", 7, 0), ("x", "1", 7, 0)], SCHEMA)
    out = L.delete_insert(target, stage, ["p"])
    assert _rows(out) == [("c", "2", 3), ("x", "1", 7), ("x", "1", 7)]
    assert _rows(L.delete_insert(out, stage, ["p"])) == _rows(out)


def test_merge_delete_missing(spark):
    target = spark.createDataFrame([("a", "1", 1, 0), ("b", "1", 2, 0), ("c", "2", 3, 0)], SCHEMA)
    stage = spark.createDataFrame([("a", "1", 10, 0)], SCHEMA)
    assert _rows(L.merge_delete_missing(target, stage, ["k"], scope=["p"])) == [("a", "1", 10), ("c", "2", 3)]


def test_append_and_schema_tools(spark):
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    b = spark.createDataFrame([("b", 2, "x")], "k string, v int, extra string")
    assert L.append_evolving(a, b).count() == 2
    assert L.append_rows(a, a).count() == 2
    added = L.add_missing_columns(a, [("k", "STRING"), ("n", "INT64"), ("t", "TIMESTAMP")])
    assert added.schema["n"].dataType.simpleString() == "bigint"
    assert added.schema["t"].dataType.simpleString() == "timestamp"
    v = {r["column"]: r["verdict"] for r in
         L.schema_compat(b, [("k", "varchar"), ("v", "double"), ("z", "string")]).collect()}
    assert v == {"k": "ok", "v": "mismatch", "z": "add"}
    dup = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [(r["k"], r["n"]) for r in L.assert_unique_key(dup, ["k"]).collect()] == [("a", 2)]


def test_stage_then_publish_switches_the_location(spark, tmpdir_path):
    from adspark.operators import catalog_tables as CT
    table = "t_published.pub"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_published LOCATION '{tmpdir_path}/db'")
    df1 = spark.createDataFrame([("a", 1)], "k string, v int")
    CT.stage_then_publish(df1, table, tmpdir_path, batch_id="b1")
    before = spark.table(table)
    CT.stage_then_publish(L.merge_upsert(spark.table(table), spark.createDataFrame([("a", 2)], "k string, v int"), ["k"]),
                          table, tmpdir_path, batch_id="b2")
    assert CT.table_property(spark, table, "batch") == "b2"
    assert [(r["k"], r["v"]) for r in spark.table(table).collect()] == [("a", 2)]
    assert [(r["k"], r["v"]) for r in before.collect()] in ([("a", 1)], [("a", 2)])  # old or new, whole
    assert CT.remove_unused_loads(spark, table, root=tmpdir_path, older_than_hours=1) == 0
    assert CT.remove_unused_loads(spark, table, root=tmpdir_path, older_than_hours=0) == 1
    assert [(r["k"], r["v"]) for r in spark.table(table).collect()] == [("a", 2)]


def test_catalog_partitions_switch(spark, tmpdir_path):
    """Only touched partitions change; emptied ones are empty; odd values of partition columns."""
    from adspark.operators import catalog_tables as CT
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_parts LOCATION '{tmpdir_path}/db'")
    spark.sql(f"CREATE TABLE t_parts.t (v int, account_id string, day string) USING parquet PARTITIONED BY (account_id, day) LOCATION '{tmpdir_path}/t'")
    odd = "a'b/c=d e:f%"

    def rows():
        return sorted(map(tuple, spark.table("t_parts.t").collect()))

    def load(data, touched):
        CT.publish_partitions_to_catalog(spark.createDataFrame(data, "v int, account_id string, day string"), "t_parts.t", ["account_id", "day"], touched)

    load([(1, "x", "2024-01-01"), (2, "y", "2024-01-01"), (3, odd, "none")], [("x", "2024-01-01"), ("y", "2024-01-01"), (odd, "none")])
    assert rows() == sorted([(1, "x", "2024-01-01"), (2, "y", "2024-01-01"), (3, odd, "none")])
    load([(4, "x", "2024-01-01"), (5, odd, "none")], [("x", "2024-01-01"), ("y", "2024-01-01"), (odd, "none")])
    assert rows() == sorted([(4, "x", "2024-01-01"), (5, odd, "none")])
    load([], [])
    assert CT.remove_unused_loads(spark, "t_parts.t", older_than_hours=0) == 1
    assert rows() == sorted([(4, "x", "2024-01-01"), (5, odd, "none")])


def test_publish_partitions_touches_only_stage_dates(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "p")
    staging = os.path.join(tmpdir_path, "staging")
    base = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2)], "k string, date string, v int")
    L.publish_partitions(base, root, "date", staging_root=staging)
    d1_files = sorted(os.listdir(os.path.join(root, "date=d1")))
    L.publish_partitions(spark.createDataFrame([("c", "d2", 3)], "k string, date string, v int"), root, "date",
                         staging_root=staging)
    assert sorted(os.listdir(os.path.join(root, "date=d1"))) == d1_files
    got = sorted((r["k"], r["date"], r["v"]) for r in spark.read.parquet(root).collect())
    assert got == [("a", "d1", 1), ("c", "d2", 3)]


@pytest.mark.parametrize("partitions", [None, 5])
def test_subset_upsert_dealt_by_key(spark, partitions):
    """dealt over a given number of tasks, the upsert gives the same rows and sorts none before."""
    old = spark.createDataFrame([(1, 1.0, 1), (None, 9.0, 9)], "k int, a double, b int")
    stage = spark.createDataFrame([(1, 5.0, 0, ["k", "a"], 1), (1, 0.0, 6, ["k", "b"], 2), (1, 7.0, 0, ["a", "k"], 0), (2, 4.0, 0, ["k", "a"], 1),
                                   (None, 8.0, 8, ["k", "a", "b"], 1), (None, 8.0, 8, ["k", "a", "b"], 1), (None, 7.0, 8, ["k", "a", "b"], 1)],
                                  "k int, a double, b int, _present array<string>, _order int")
    stage = stage.union(spark.range(400).selectExpr("3", "cast(id as double)", "0", "array('k', 'a')", "cast(id as int)"))
    out = L.merge_upsert_subset(old, stage, ["k"], num_partitions=partitions) if partitions else L.merge_upsert_subset(old, stage, ["k"])
    assert sorted((r["k"] or 0, r["a"], r["b"]) for r in out.collect()) == \
        [(0, 7.0, 8), (0, 8.0, 8), (0, 9.0, 9), (1, 5.0, 6), (2, 4.0, 0), (3, 399.0, 0)]


def test_load_deals_its_stage_by_its_rows(spark, tmpdir_path, monkeypatch):
    """the tasks that reduce a stage follow its number of rows."""
    from adspark.plans import ingest
    from adspark.specs import get_spec
    seen, plain = [], L.merge_upsert_subset
    monkeypatch.setattr(L, "ROWS_PER_TASK", 10, raising=False)
    monkeypatch.setattr(L, "merge_upsert_subset", lambda *a, **kw: seen.append(kw.get("num_partitions")) or plain(*a, **kw))
    spec = get_spec("report", "SP", "campaign")
    rows = spark.range(1000).selectExpr("id", "date '2024-01-01' + cast(id % 3 as int) as day")
    given = {"campaignId": F.col("id"), "date": F.col("day")}
    stage = rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.spark_schema().fields], F.lit("f").alias("_file"),
                        F.current_timestamp().alias("_mtime"), F.array(F.lit("campaignId"), F.lit("date")).alias(ingest.PRESENT))
    ingest.load_stage(spark, stage, spec, tables_root=os.path.join(tmpdir_path, "t"), staging_root=os.path.join(tmpdir_path, "s"))
    assert seen == [100]
    assert ingest.read_table(spark, os.path.join(tmpdir_path, "t"), spec).count() == 1000
