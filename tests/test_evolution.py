"""Schema evolution of catalog tables and error texts of bounded length."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.operators import aggregates as A
from adspark.operators import catalog_tables as CT
from adspark.operators import evolution as E
from adspark.operators import load as L
from adspark.plans import ingest as PI
from adspark.specs import get_spec


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


@pytest.fixture()
def table(spark, tmpdir_path):
    db = "t_evolve_" + os.path.basename(tmpdir_path)[-8:].replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE `{db}` LOCATION '{tmpdir_path}/db'")
    name = f"{db}.t"
    spark.sql(f"CREATE TABLE {name} (k string, n int, price string, f float, p string) USING parquet PARTITIONED BY (p) LOCATION '{tmpdir_path}/t'")
    rows = spark.createDataFrame([("a", 1, "1.5", 0.5, "x y"), ("b", None, None, None, "x y"), ("c", 3, "2", 2.0, "z")], spark.table(name).schema)
    CT.publish_partitions_to_catalog(rows, name, ["p"], [("x y",), ("z",)])
    return name


def test_plan(spark):
    got = E.schema_changes(_schema("a int, b string, c float, gone string"), _schema("A bigint, b double, c float, d boolean"))
    assert [(c.column, c.action) for c in got] == [("a", "widen"), ("b", "rewrite"), ("c", "keep"), ("gone", "keep"), ("d", "add")]


def test_added_and_widened_columns_leave_files(spark, table):
    before = CT.table_partitions(spark, table)
    E.evolve_table(spark, table, _schema("k string, n bigint, f double, extra string, p string"))
    assert CT.table_partitions(spark, table) == before
    assert spark.table(table).schema["n"].dataType == T.LongType() and "price" in spark.table(table).columns
    want = [("a", 1, "1.5", 0.5, None), ("b", None, None, None, None), ("c", 3, "2", 2.0, None)]
    for vectorised in ("true", "false"):
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorised)
        try:
            assert sorted(map(tuple, spark.table(table).select("k", "n", "price", "f", "extra").collect())) == want
        finally:
            spark.conf.unset("spark.sql.parquet.enableVectorizedReader")
    big = spark.createDataFrame([("d", 1 << 40, None, 1e300, "new", "z")], "k string, n long, price string, f double, extra string, p string")
    CT.publish_partitions_to_catalog(big, table, ["p"], [("z",)])
    assert sorted(map(tuple, spark.table(table).select("k", "n", "f", "extra").collect())) == [("a", 1, 0.5, None), ("b", None, None, None), ("d", 1 << 40, 1e300, "new")]


def test_rewrite_on_request_and_only_what_differs(spark, table):
    expected = _schema("k string, n int, price double, f float, p string")
    with pytest.raises(ValueError, match="price"):
        E.evolve_table(spark, table, expected)
    # One partition was switched before a failure: only the other one is written anew
    done = spark.table(table).where("p = 'z'").withColumn("price", F.col("price").cast("double"))
    CT.publish_partitions_to_catalog(done, table, ["p"], [("z",)])
    before = dict(CT.table_partitions(spark, table))
    E.evolve_table(spark, table, expected, rewrite=True)
    after = dict(CT.table_partitions(spark, table))
    assert after[("z",)] == before[("z",)] and after[("x y",)] != before[("x y",)]
    assert sorted(map(tuple, spark.table(table).select("k", "price", "p").collect())) == [("a", 1.5, "x y"), ("b", None, "x y"), ("c", 2.0, "z")]
    assert all(c.action == "keep" for c in E.evolve_table(spark, table, expected))


def test_values_that_do_not_convert(spark, table):
    bad = spark.createDataFrame([("q", 7, "dear", 1.25, "z")], spark.table(table).schema)
    CT.publish_partitions_to_catalog(bad, table, ["p"], [("z",)])
    before = CT.table_partitions(spark, table)
    with pytest.raises(Exception, match="dear"):
        E.evolve_table(spark, table, _schema("price double"), rewrite=True)
    assert CT.table_partitions(spark, table) == before and spark.table(table).where("k = 'q'").first()["price"] == "dear"
    with pytest.raises(Exception, match="is no bigint"):  # a fraction is not cut off silently
        E.evolve_table(spark, table, _schema("f bigint"), rewrite=True)
    E.evolve_table(spark, table, _schema("price double"), rewrite=True, on_bad="null")
    assert sorted(map(tuple, spark.table(table).select("k", "price").collect())) == [("a", 1.5), ("b", None), ("q", None)]


def test_partition_column_and_whole_table(spark, table, tmpdir_path):
    with pytest.raises(ValueError, match="partitioned by"):
        E.evolve_table(spark, table, _schema("p int"))
    name = table + "_whole"
    CT.stage_then_publish(spark.createDataFrame([("1", 2), (None, 3)], "a string, b int"), name, f"{tmpdir_path}/whole")
    changes = E.evolve_table(spark, name, _schema("a bigint, b bigint, c string"), rewrite=True)
    assert sorted(map(tuple, E.changes_frame(spark, changes).select("column", "action").collect())) == [("a", "rewrite"), ("b", "widen"), ("c", "add")]
    assert spark.table(name).schema.simpleString() == "struct<a:bigint,b:bigint,c:string>"
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [(1, 2, None), (None, 3, None)]


def test_load_into_an_older_table(spark, tmpdir_path):
    """A table made by an older specification takes the load of the present one."""
    spec = get_spec("report", "SP", "campaign")
    prefix = "t_old_" + os.path.basename(tmpdir_path)[-6:].replace("-", "_").lower() + "_"
    db = PI.database_name(spec, prefix)
    L.create_table_from_spec(spark, spec, location=PI.table_path(tmpdir_path, spec), database=db)
    name = f"{db}.{spec.table_name}"
    older = [f for f in L.partition_schema(spec) if f.name not in ("clicks", *L.partition_columns(spec))]
    spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {'int' if f.name == 'impressions' else f.dataType.simpleString()}" for f in older)
    spark.sql(f"CREATE TABLE {name} ({columns}, account_id string, day string) USING parquet PARTITIONED BY (account_id, day) LOCATION '{PI.table_path(tmpdir_path, spec)}'")
    row = spark.range(1).select(*[F.lit(None).cast(t.dataType).alias(t.name) for t in spec.spark_schema()])
    row = row.withColumns({"campaignId": F.lit(5).cast("long"), "clicks": F.lit(9).cast("long"), "date": F.lit("2024-01-01").cast("timestamp"),
                           "impressions": F.lit(1 << 40), "_file": F.lit("f"), "_mtime": F.current_timestamp()})
    PI.load_stage(spark, row, spec, tables_root=tmpdir_path, staging_root=f"{tmpdir_path}/s", database=prefix)
    got = PI.read_table(spark, tmpdir_path, spec, database=prefix).select("campaignId", "clicks", "impressions").collect()
    assert [tuple(r) for r in got] == [(5, 9, 1 << 40)]


def test_error_text_is_the_same_with_a_limit(spark):
    import random
    draw = random.Random(5)
    rows = []
    for m in range(6):
        for d in ("f1", "f2", None):
            for pos in draw.sample(range(3000), 900 if m else 3):
                text = None if draw.random() < .1 else "é" * draw.choice((0, 1, 5, 40, 3000 if m == 2 else 7))
                rows.append((m, d, pos, "ERROR" if m != 5 and draw.random() < .6 else draw.choice(("WARNING", None)), text))
    issues = spark.createDataFrame(rows, "messageId int, feed_id string, pos int, severity string, message string").withColumn("attributeName", F.lit(None).cast("string"))
    order = ("feed_id", "pos")
    whole = {r.messageId: r for r in A.feed_result_by_message(issues, group=(), pos=order).collect()}
    for limit in (10, 57, 1000, 65535):
        cut = {r.messageId: r for r in A.feed_result_by_message(issues, group=(), pos=order, limit=limit).collect()}
        assert cut.keys() == whole.keys()
        for m, r in whole.items():
            t = r.errorMessage
            assert (cut[m].status, cut[m].errorMessage) == (r.status, t if len(t) <= limit else t[:limit - 3] + "...")
    none = A.feed_result_by_message(issues.limit(0), group=(), pos=order, limit=10)
    assert none.isEmpty()
