"""Streaming ingestion: stream equals batch, re-delivery changes nothing, latest file wins."""

import gzip
import json
import os
import time

from pyspark.sql import functions as F

from adspark.plans.ingest import clean_files, load_stage, table_path
from adspark.sources.files import whole_files
from adspark.specs import get_spec
from adspark.streaming.ingest import ingest_stream

SPEC = get_spec("report", "SP", "campaign")
ENTITY = get_spec("entity", "SP", "adgroup")


def _now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def _report(root, profile, dates, name, rows):
    d = os.path.join(root, "reports", "SP", "campaign", "US", "7", profile, dates)
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, name), "wt") as f:
        json.dump(rows, f)


def _entity(root, profile, name, rows):
    d = os.path.join(root, "entities", "SP", "adgroup", "US", "7", profile)
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, name), "wt") as f:
        json.dump(rows, f)


def _rows(n0, n, cost=1.0, day="2024-03-20"):
    return [{"date": day, "campaignId": i, "cost": cost + i, "clicks": i} for i in range(n0, n)]


def _table(spark, tables):
    df = spark.read.parquet(table_path(tables, SPEC))
    return sorted((r["profileId"], str(r["date"]), r["campaignId"], r["cost"]) for r in df.collect())


def _run(spark, landing, tables, ckpt, kind="report"):
    q = ingest_stream(spark, landing, tables_root=tables, checkpoint=ckpt, now=_now(), kind=kind)
    q.awaitTermination()


def test_stream_equals_batch_and_redelivery(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _report(landing, "p1", "20240320-20240320", "a.json.gz", _rows(0, 5))
    _run(spark, landing, tables, ckpt)
    _report(landing, "p1", "20240320-20240320", "b.json.gz", _rows(3, 8, cost=10.0))
    _report(landing, "p2", "20240321-20240321", "c.json.gz", _rows(0, 2, day="2024-03-21"))
    _run(spark, landing, tables, ckpt)
    streamed = _table(spark, tables)
    _run(spark, landing, tables, ckpt)  # nothing new: unchanged
    assert _table(spark, tables) == streamed
    # batch: every file at once into a fresh table root
    tables2 = os.path.join(tmpdir_path, "tables2")
    files = whole_files(spark, [os.path.join(landing, "reports")]).withColumn("_file", F.col("_file"))
    stage = clean_files(files.filter(F.col("_file").contains("/p1/") & F.col("_file").endswith("a.json.gz")), SPEC, now=_now())
    load_stage(spark, stage, SPEC, tables_root=tables2, staging_root=os.path.join(tmpdir_path, "st"))
    stage = clean_files(files.filter(~F.col("_file").endswith("a.json.gz")), SPEC, now=_now())
    load_stage(spark, stage, SPEC, tables_root=tables2, staging_root=os.path.join(tmpdir_path, "st"))
    assert _table(spark, tables2) == streamed
    assert len(streamed) == 10
    assert ("p1", "2024-03-20 00:00:00", 4, 14.0) in streamed


def test_latest_file_wins_in_one_batch(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _report(landing, "p1", "20240320-20240320", "old.json.gz", _rows(0, 2, cost=1.0))
    _report(landing, "p1", "20240320-20240320", "new.json.gz", _rows(0, 2, cost=5.0))
    old = os.path.join(landing, "reports/SP/campaign/US/7/p1/20240320-20240320/old.json.gz")
    t = time.time()
    os.utime(old, (t - 100, t - 100))
    _run(spark, landing, tables, ckpt)
    assert [r[3] for r in _table(spark, tables)] == [5.0, 6.0]


def test_entity_snapshot_stream(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _entity(landing, "p1", "e1.json.gz", [{"adGroupId": 1, "campaignId": 1, "name": "a", "state": "ENABLED",
                                           "defaultBid": 0.5, "extendedData": {"servingStatus": "OK"}},
                                          {"adGroupId": 2, "campaignId": 1, "name": "b"}])
    _run(spark, landing, tables, ckpt, kind="entity")
    _entity(landing, "p2", "e0.json.gz", [{"adGroupId": 9, "campaignId": 2, "name": "z"}])
    _run(spark, landing, tables, ckpt, kind="entity")
    _entity(landing, "p1", "e2.json.gz", [{"adGroupId": 3, "campaignId": 1, "name": "c"}])
    _run(spark, landing, tables, ckpt, kind="entity")
    from adspark.plans.ingest import read_table
    snap = read_table(spark, tables, ENTITY)
    assert sorted((r["profileId"], r["adGroupId"]) for r in snap.collect()) == [("p1", 3), ("p2", 9)]


def test_csv_reports_gates_and_status(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "p9", "20240320-20240320")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("date,campaignId,cost,Ad Group (Name)\n2024-03-20,1,2.5,g\n2024-03-20,2,3.5,h\n")
    with open(os.path.join(d, "b.csv"), "w") as f:  # other column order, same table
        f.write("cost,date,campaignId\n9.5,2024-03-20,3\n")
    with open(os.path.join(d, "c.txt"), "w") as f:
        f.write("ignored\n")
    with open(os.path.join(d, "err.csv"), "w") as f:
        f.write("Error,details\nthrottled,x\n")
    u = os.path.join(landing, "reports", "SP", "nosuchtable", "US", "7", "p9", "20240320-20240320")
    os.makedirs(u, exist_ok=True)
    with open(os.path.join(u, "x.json"), "w") as f:
        json.dump([{"a": 1}], f)
    _run(spark, landing, tables, ckpt)
    got = sorted((r["campaignId"], r["cost"], r["profileId"]) for r in
                 spark.read.parquet(table_path(tables, SPEC)).collect())
    assert got == [(1, 2.5, "p9"), (2, 3.5, "p9"), (3, 9.5, "p9")]
    rejects = {os.path.basename(r["_file"]): r["status"] for r in spark.read.parquet(os.path.join(tables, "_rejects")).collect()}
    assert rejects == {"c.txt": "INPUT_FORMAT_UNSUPPORTED", "err.csv": "INVALID_HEADER", "x.json": "UNKNOWN_TABLE"}
    status = {os.path.basename(r["_file"]): r["row_count"] for r in spark.read.parquet(os.path.join(tables, "_file_status")).collect()}
    assert status == {"a.csv": 2, "b.csv": 1}


def test_touched_partitions_are_replaced(spark, tmpdir_path):
    """A second delivery replaces the rows of its dates, rows without a date included."""
    import adspark.plans.ingest as I
    landing = os.path.join(tmpdir_path, "in")
    for day in ("20", "21", "22"):
        _report(landing, "p1", f"202403{day}-202403{day}", f"d{day}.json.gz", _rows(0, 3, day=f"2024-03-{day}"))
    tables = os.path.join(tmpdir_path, "a")
    stage = I.clean_files(whole_files(spark, landing), SPEC, now=_now())
    stage = stage.withColumn("date", F.when(F.col("campaignId") < 2, F.col("date")))
    I.load_stage(spark, stage.filter("campaignId < 2 or profileId is null or date is null"), SPEC, tables_root=tables, staging_root=os.path.join(tmpdir_path, "s1"))
    before = _table(spark, tables)
    again = stage.filter("campaignId < 2").withColumn("cost", F.col("cost") + 100)
    nulls = stage.filter("campaignId = 2").withColumns({"campaignId": F.lit(7).cast(stage.schema["campaignId"].dataType)})
    I.load_stage(spark, again.unionByName(nulls), SPEC, tables_root=tables, staging_root=os.path.join(tmpdir_path, "s2"))
    after = _table(spark, tables)
    dated = [r for r in after if r[1] != "None"]
    assert len(dated) == 6 and min(r[3] for r in dated) >= 100
    # Rows without a date never match as keys: those of the first delivery stay, those of the second insert.
    assert {r[2] for r in after if r[1] == "None"} == {2, 7}
    assert [r for r in before if r[1] == "None"] == [r for r in after if r[1] == "None" and r[2] == 2]


def test_touched_partitions_exactly(spark):
    """The rows read back are those of the stage's (account, day) tuples, not of their ranges."""
    import adspark.plans.ingest as I
    current = spark.createDataFrame([(i, a, d) for i, (a, d) in enumerate([("x", "none"), ("x", "d1"), ("y", "d1"), ("y", "d2"), ("z", "d3"), ("x", "d3")])],
                                    "id int, account_id string, day string")
    def ids(touched):
        return sorted(r.id for r in current.where(I._touched_condition(touched, ["account_id", "day"])).collect())
    assert ids([("x", "none"), ("y", "d2")]) == [0, 3]
    assert ids([("x", "d1"), ("x", "d3"), ("z", "d1"), ("z", "d3")]) == [1, 4, 5]
    assert ids([]) == []


def _accounts(spark, landing, tables, ckpt, **target):
    """Two accounts with the same profile, campaign and day."""
    from adspark.plans.ingest import read_table

    def put(client, name, rows):
        d = os.path.join(landing, "reports", "SP", "campaign", "US", client, "p1", "20240320-20240320")
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, name), "wt") as f:
            json.dump(rows, f)

    def run():
        ingest_stream(spark, landing, tables_root=tables, checkpoint=ckpt, now=_now(), **target).awaitTermination()

    def rows():
        t = read_table(spark, tables, SPEC, partitions=True, **target)
        return sorted((r["account_id"], r["day"], r["date"].hour, r["campaignId"], r["cost"]) for r in t.collect())

    put("c7", "a.json.gz", _rows(0, 2, cost=1.0) + _rows(9, 10, day="2024-03-20 11:00:00"))
    put("c8", "a.json.gz", _rows(0, 2, cost=5.0))
    run()
    both = [("c7", "2024-03-20", 0, 0, 1.0), ("c7", "2024-03-20", 0, 1, 2.0), ("c7", "2024-03-20", 11, 9, 10.0),
            ("c8", "2024-03-20", 0, 0, 5.0), ("c8", "2024-03-20", 0, 1, 6.0)]
    assert rows() == both
    put("c8", "b.json.gz", _rows(0, 1, cost=50.0))
    run()
    assert rows() == [*both[:3], ("c8", "2024-03-20", 0, 0, 50.0), both[4]]
    assert {r["profileId"] for r in read_table(spark, tables, SPEC, account="c8", **target).collect()} == {"p1"}
    assert read_table(spark, tables, SPEC, account="c8", **target).count() == 2


def test_accounts_are_apart_in_folders(spark, tmpdir_path):
    _accounts(spark, *(os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt")))


def test_accounts_are_apart_in_the_catalog(spark, tmpdir_path):
    from adspark.operators import catalog_tables as CT
    tables = os.path.join(tmpdir_path, "tables")
    _accounts(spark, os.path.join(tmpdir_path, "in"), tables, os.path.join(tmpdir_path, "ckpt"), database="t_acc_")
    name = f"t_acc_{SPEC.dataset}.{SPEC.table_name}"
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()) == ["account_id=c7/day=2024-03-20", "account_id=c8/day=2024-03-20"]
    # rows are written once: each load has one folder, and only used ones stay
    assert CT.remove_unused_loads(spark, name, older_than_hours=0) == 0  # the first load still serves c7
    plan = spark.table(name).where("account_id = 'c8' and day = '2024-03-20'")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    spark.sql(f"DROP TABLE {name}")
    import pytest
    with pytest.raises(ValueError, match="does not know"):
        load_stage(spark, clean_files(whole_files(spark, os.path.join(tmpdir_path, "in")), SPEC, now=_now()), SPEC, tables_root=tables,
                   staging_root=os.path.join(tmpdir_path, "st"), database="t_acc_")


def test_entity_snapshots_in_the_catalog(spark, tmpdir_path):
    from adspark.plans.ingest import read_table
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _entity(landing, "p1", "e1.json.gz", [{"adGroupId": 1, "campaignId": 1}, {"adGroupId": 2, "campaignId": 1}])
    _entity(landing, "p2", "e0.json.gz", [{"adGroupId": 9, "campaignId": 2}])
    ingest_stream(spark, landing, tables_root=tables, checkpoint=ckpt, now=_now(), kind="entity", database="t_ent_").awaitTermination()
    _entity(landing, "p1", "e2.json.gz", [{"adGroupId": 3, "campaignId": 1}])
    ingest_stream(spark, landing, tables_root=tables, checkpoint=ckpt, now=_now(), kind="entity", database="t_ent_").awaitTermination()
    snap = read_table(spark, tables, ENTITY, database="t_ent_")
    assert sorted((r["profileId"], r["adGroupId"]) for r in snap.collect()) == [("p1", 3), ("p2", 9)]


def test_two_streams_share_a_table(spark, tmpdir_path):
    """A stream with a checkpoint of its own loads its files although its batch numbers repeat."""
    tables = os.path.join(tmpdir_path, "tables")
    for n in (1, 2):
        landing = os.path.join(tmpdir_path, f"in{n}")
        _report(landing, f"p{n}", "20240320-20240320", "a.json.gz", _rows(0, 2))
        _run(spark, landing, tables, os.path.join(tmpdir_path, f"ckpt{n}"))
    assert {r[0] for r in _table(spark, tables)} == {"p1", "p2"} and len(_table(spark, tables)) == 4


def test_unreadable_files_are_recorded(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _report(landing, "p1", "20240320-20240320", "good.json.gz", _rows(0, 2))
    d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "p1", "20240320-20240320")
    with open(os.path.join(d, "cut.json"), "w") as f:
        f.write(json.dumps(_rows(5, 9))[:-20])
    with open(os.path.join(d, "plain.json"), "w") as f:
        f.write("service unavailable")
    with gzip.open(os.path.join(d, "x.csv.gz"), "wt") as f:
        f.write("date,campaignId\n2024-03-20,1\n")
    with open(os.path.join(d, "none.json"), "w") as f:
        f.write("[]")
    with open(os.path.join(landing, "short.json"), "w") as f:
        f.write("[]")
    _run(spark, landing, tables, ckpt)
    rejects = {os.path.basename(r["_file"]): r["status"] for r in spark.read.parquet(os.path.join(tables, "_rejects")).collect()}
    assert rejects == {"cut.json": "UNREADABLE", "plain.json": "UNREADABLE", "x.csv.gz": "UNREADABLE", "none.json": "EMPTY",
                       "short.json": "UNKNOWN_TABLE"}
    assert len(_table(spark, tables)) == 2


def test_csv_quotes_breaks_and_blank_in_path(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "prof one", "20240320-20240320")
    os.makedirs(d)
    with open(os.path.join(d, "a b.csv"), "w") as f:
        f.write('date,campaignId,cost,campaignName\n2024-03-20,1,2.5,"say ""hi"", you"\n2024-03-20,2,3.5,"two\nlines"\n')
    _run(spark, landing, tables, ckpt)
    got = sorted((r["campaignId"], r["campaignName"], r["profileId"]) for r in spark.read.parquet(table_path(tables, SPEC)).collect())
    assert got == [(1, 'say "hi", you', "prof one"), (2, "two\nlines", "prof one")]


def test_rows_without_snapshot_key_are_kept(spark):
    from adspark.plans.ingest import latest_file_rows
    rows = spark.createDataFrame([(None, 1, 10, "f1"), (None, 2, 20, "f2"), ("p", 3, 10, "f1"), ("p", 4, 20, "f2")],
                                 "profileId string, adGroupId bigint, _mtime bigint, _file string")
    for k in ENTITY.merge_columns:
        if k not in rows.columns:
            rows = rows.withColumn(k, F.lit("x"))
    out = latest_file_rows(rows, ENTITY)
    assert sorted(r["adGroupId"] for r in out.collect()) == [2, 4]


def test_delivery_replaces_only_its_columns(spark, tmpdir_path):
    """A file without a column leaves it as it was; JSON and CSV alike, absent keys included."""
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))

    def rows():
        return sorted((r["campaignId"], r["cost"], r["clicks"], r["campaignName"]) for r in spark.read.parquet(table_path(tables, SPEC)).collect())

    base = {"date": "2024-03-20", "cost": 1.0, "clicks": 7, "campaignName": "n"}
    _report(landing, "p1", "20240320-20240320", "a.json.gz", [base | {"campaignId": 1}, base | {"campaignId": 2}])
    _run(spark, landing, tables, ckpt)
    _report(landing, "p1", "20240320-20240320", "b.json.gz",
            [{"date": "2024-03-20", "cost": 2.0, "campaignId": 1, "campaignName": None}, {"date": "2024-03-20", "cost": 3.0, "campaignId": 3}])
    _run(spark, landing, tables, ckpt)
    assert rows() == [(1, 2.0, 7, ""), (2, 1.0, 7, "n"), (3, 3.0, 0, "")]
    folder = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "p1", "20240320-20240320")
    for name in ("c.csv", "d.csv"):  # the same delivery twice, without campaignName and with an absent key
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as f:
            f.write("date,clicks\n2024-03-20,5\n")
        _run(spark, landing, tables, ckpt)
    assert rows() == [(0, 0.0, 5, ""), (1, 2.0, 7, ""), (2, 1.0, 7, "n"), (3, 3.0, 0, "")]


def test_newest_file_decides_per_column(spark):
    from adspark.operators.load import merge_upsert_subset
    old = spark.createDataFrame([(1, 1, 1), (None, 9, 9)], "k int, a int, b int")
    stage = spark.createDataFrame([(1, 5, 0, ["k", "a"], 1), (1, 0, 6, ["k", "b"], 2), (1, 7, 0, ["k", "a"], 0), (2, 4, 0, ["k", "a"], 1),
                                   (None, 8, 8, ["k", "a", "b"], 1), (None, 8, 8, ["k", "a", "b"], 1), (None, 7, 8, ["k", "a", "b"], 1)],
                                  "k int, a int, b int, _present array<string>, _order int")
    got = sorted((r["k"] or 0, r["a"], r["b"]) for r in merge_upsert_subset(old, stage, ["k"]).collect())
    assert got == [(0, 7, 8), (0, 8, 8), (0, 9, 9), (1, 5, 6), (2, 4, 0)]


def test_written_arrays_grow_with_the_table(spark, tmpdir_path, monkeypatch):
    from adspark.plans import standins
    from adspark.streaming import ingest
    monkeypatch.setattr(ingest, "ROWS_PER_FILE", 20, raising=False)
    rows = spark.range(600).select(F.when(F.col("id") < 590, "hot").otherwise("cold").alias("p"), F.lit("20240101-20241231").alias("d"), "id")
    ingest.write_array_files(rows, f"{tmpdir_path}/a", root="reports", ad_type="SP", name="campaign", country="US", profile="p", dates="d")
    standins.write_json_array_files(rows, f"{tmpdir_path}/b")
    for path in ("a", "b"):
        arrays = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(f"{tmpdir_path}/{path}").collect()]
        assert sorted(x["id"] for a in arrays for x in a) == list(range(600))
        assert len(arrays) >= 25 and max(len(a) for a in arrays) <= 50


def test_trailing_content_is_a_reject(spark, tmpdir_path):
    """Nothing is lost silently: text after the report, a second report, JSON lines."""
    import pytest
    from adspark.sources.files import read_json_report, spec_input_schema
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "p1", "20240320-20240320")
    os.makedirs(d)
    one, two = json.dumps(_rows(0, 1)), json.dumps(_rows(1, 2))
    texts = {"two.json": one + two, "tail.json": one + " trailing", "bracket.json": one + "]", "comma.json": one + "," + two,
             "lines.json": one[1:-1] + "\n" + two[1:-1], "objects.json": one[1:-1] + "," + two[1:-1], "null.json": "null",
             "good.json": "\n " + json.dumps(_rows(5, 7)) + " \n", "object.json": json.dumps(_rows(8, 9)[0])}
    for name, text in texts.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    _run(spark, landing, tables, ckpt)
    assert [r[2] for r in _table(spark, tables)] == [5, 6, 8]
    rejects = {os.path.basename(r["_file"]): r["status"] for r in spark.read.parquet(os.path.join(tables, "_rejects")).collect()}
    assert rejects == {n: "UNREADABLE" for n in texts if n not in ("good.json", "object.json")}
    schema = spec_input_schema(SPEC)
    with pytest.raises(Exception, match="not one whole JSON report"):
        read_json_report(spark, os.path.join(d, "two.json"), schema).collect()
    assert read_json_report(spark, os.path.join(d, "lines.json"), schema, lines=True).count() == 2
    assert read_json_report(spark, os.path.join(d, "good.json"), schema).count() == 2


def test_csv_encodings_and_wildcards_in_paths(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    for i, (profile, text) in enumerate([("p[1]", "café".encode("latin-1")), ("p{1,2}", "café 漢".encode()), ("p*?", b"plain")]):
        d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", profile, "20240320-20240320")
        os.makedirs(d)
        with open(os.path.join(d, f"a{i}.csv"), "wb") as f:
            f.write((b"\xef\xbb\xbf" if i == 1 else b"") + b"date,campaignId,campaign Name,campaignName\r\n2024-03-20,%d,,%s\r\n" % (i, text))
    _run(spark, landing, tables, ckpt)
    got = sorted((r["campaignId"], r["campaignName"], r["profileId"]) for r in spark.read.parquet(table_path(tables, SPEC)).collect())
    assert got == [(0, "café", "p[1]"), (1, "café 漢", "p{1,2}"), (2, "plain", "p*?")]


def test_json_keys_follow_the_naming_rules(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _report(landing, "p1", "20240320-20240320", "a.json.gz",
            [{"date": "2024-03-20", "campaign.Id": 4, "co/st": 1.5, "campaignName": "say \"hi\""}, {"date": "2024-03-20", "campaignId": 5, "campaign,Id": 6}])
    _run(spark, landing, tables, ckpt)
    got = sorted((r["campaignId"], r["cost"], r["campaignName"]) for r in spark.read.parquet(table_path(tables, SPEC)).collect())
    assert got == [(4, 1.5, 'say "hi"'), (5, 0.0, "")]


def test_load_quality_is_kept(spark, tmpdir_path):
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))
    _report(landing, "p1", "20240320-20240320", "a.json.gz", [{"date": "2024-03-20", "campaignId": 1, "cost": "n/a", "clicks": "x", "newMetric": 1},
                                                             {"date": "2024-03-20", "campaignId": 2, "cost": "1.5", "clicks": None, "other one": 2}])
    d = os.path.join(landing, "reports", "SP", "campaign", "US", "7", "p1", "20240320-20240320")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("date,campaignId,cost,csvOnly\n2024-03-20,3,bad,1\n2024-03-20,4,2,1\n")
    _run(spark, landing, tables, ckpt)
    got = sorted((r["column"], r["kind"], r["n"]) for r in spark.read.parquet(os.path.join(tables, "_load_quality")).collect())
    assert got == [("*", "rows", 4), ("clicks", "rejected", 1), ("cost", "rejected", 2), ("csvOnly", "dropped", None), ("newMetric", "dropped", None), ("other_one", "dropped", None)]


def _part(landing, delivery, part, parts, profile, rows):
    d = os.path.join(landing, f"delivery={delivery}", f"part={part}-of-{parts}", "entities", "SP", "adgroup", "US", "7", profile)
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, "a.json.gz"), "wt") as f:
        json.dump(rows, f)


def test_deliveries_of_several_files(spark, tmpdir_path):
    """Whole or not at all, also over several micro-batches; an older one that completes late is not loaded."""
    from adspark.plans.ingest import read_table
    landing, tables, ckpt = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "ckpt"))

    def after():
        _run(spark, landing, tables, ckpt, kind="entity")
        snap = read_table(spark, tables, ENTITY)
        return None if snap is None else sorted((r["profileId"], r["adGroupId"]) for r in snap.collect())

    for k in range(1, 21):
        _part(landing, "d1", k, 20, "p1", [{"adGroupId": k, "campaignId": 1}])
    _part(landing, "d1", 1, 2, "p2", [{"adGroupId": 1, "campaignId": 1}])
    _entity(landing, "p3", "alone.json.gz", [{"adGroupId": 30, "campaignId": 1}])
    first = [("p1", k) for k in range(1, 21)] + [("p3", 30)]
    assert after() == first
    _part(landing, "d2", 2, 2, "p1", [{"adGroupId": 102, "campaignId": 1}])
    _part(landing, "d0", 1, 2, "p1", [{"adGroupId": 201, "campaignId": 1}])
    assert after() == first  # incomplete: nothing changes
    _part(landing, "d2", 1, 2, "p1", [{"adGroupId": 101, "campaignId": 1}])
    _part(landing, "d1", 2, 2, "p2", [{"adGroupId": 2, "campaignId": 1}])
    second = [("p1", 101), ("p1", 102), ("p2", 1), ("p2", 2), ("p3", 30)]
    assert after() == second
    _part(landing, "d0", 2, 2, "p1", [{"adGroupId": 202, "campaignId": 1}])
    assert after() == second  # complete, but older than what is loaded


def test_files_are_judged_once_a_batch(spark, tmpdir_path, monkeypatch):
    from adspark.streaming import ingest as I
    seen, headers = spark.sparkContext.accumulator(0), I._file_headers

    def judged(path):
        seen.add(1)
        return path

    mark = F.udf(judged, "string").asNondeterministic()
    monkeypatch.setattr(I, "_file_headers", lambda files: headers(files).withColumn("_file", mark("_file")))
    landing = os.path.join(tmpdir_path, "landing", "reports", "SP", "campaign", "US", "7", "P1", "20240101-20240131")
    os.makedirs(landing)
    for name, text in (("a.json", '[{"campaignId": 1, "date": "2024-01-02", "cost": 2.5}]'), ("b.json", '[{"campaignId": 2, "date"')):
        with open(os.path.join(landing, name), "w") as f:
            f.write(text)
    root = os.path.join(tmpdir_path, "tables")
    I.ingest_stream(spark, os.path.join(tmpdir_path, "landing"), tables_root=root, checkpoint=os.path.join(tmpdir_path, "ckpt"),
                    now=F.lit("2024-06-01 00:00:00").cast("timestamp")).awaitTermination()
    assert [r["status"] for r in spark.read.parquet(f"{root}/_rejects").collect()] == ["UNREADABLE"]
    assert seen.value == 2
