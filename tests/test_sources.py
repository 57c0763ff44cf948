"""Sources: encoding fallback, gzip, empty files, CSV / TSV, path metadata, gates."""

import gzip
import json
import os

from pyspark.sql import types as T

from adspark.sources import files as SRC
from adspark.sources.paths import object_key_decode, path_metadata


def _w(path, data: bytes, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open(path, "wb") if gz else open(path, "wb")) as f:
        f.write(data)


SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.StringType())])


def test_utf8_latin1_plain_and_gzip(spark, tmpdir_path):
    rows = [{"name": "café", "n": 1}]
    pretty = json.dumps(rows, ensure_ascii=False, indent=2).encode("utf-8")
    _w(f"{tmpdir_path}/a/multiline.json", pretty)
    _w(f"{tmpdir_path}/a/utf8.json", json.dumps(rows, ensure_ascii=False).encode("utf-8"))
    _w(f"{tmpdir_path}/a/latin1.json", json.dumps(rows, ensure_ascii=False).encode("latin-1"))
    _w(f"{tmpdir_path}/a/zipped.json.gz", json.dumps(rows, ensure_ascii=False).encode("utf-8"), gz=True)
    _w(f"{tmpdir_path}/a/empty.json", b"[]")
    df = SRC.read_json_report(spark, f"{tmpdir_path}/a", SCHEMA)
    got = sorted((os.path.basename(r["_file"]), r["name"], r["n"]) for r in df.collect())
    assert got == [("latin1.json", "café", "1"), ("multiline.json", "café", "1"), ("utf8.json", "café", "1"),
                   ("zipped.json.gz", "café", "1")]
    streamed = SRC.read_json_report(spark, f"{tmpdir_path}/a", SCHEMA, mode="multiline")
    got = sorted((os.path.basename(r["_file"]), r["name"]) for r in streamed.collect())
    assert ("multiline.json", "café") in got and ("zipped.json.gz", "café") in got


def test_csv_header_only_and_gate(spark, tmpdir_path):
    _w(f"{tmpdir_path}/c/h.csv", b"a,b\n")
    _w(f"{tmpdir_path}/c/d.csv", b"a,b\n1,x\n2,y\n")
    df = SRC.read_csv_report(spark, f"{tmpdir_path}/c")
    assert sorted(df.drop("_file", "_mtime").collect()) == sorted([("1", "x"), ("2", "y")])
    _w(f"{tmpdir_path}/g/ok.csv", b"a,b\n1,2\n")
    _w(f"{tmpdir_path}/g/err.csv", b"Error,b\n1,2\n")
    _w(f"{tmpdir_path}/g/html.csv", b"< html >,x\n")
    _w(f"{tmpdir_path}/g/empty.csv", b"\n")
    _w(f"{tmpdir_path}/g/zero.csv", b"")
    v = {os.path.basename(r["_file"]): r["verdict"]
         for r in SRC.header_gate(SRC.csv_headers(spark, f"{tmpdir_path}/g")).collect()}
    assert v == {"ok.csv": "valid", "err.csv": "error_column", "html.csv": "html", "empty.csv": "empty"}


def test_file_format_gate(spark):
    files = spark.createDataFrame([("a/x.json.gz",), ("b/y.JSON",), ("c/z.csv",), ("d/w.txt",), ("e/noext",)], "path string")
    ok, bad = SRC.file_format_gate(files)
    assert sorted(r["path"] for r in ok.collect()) == ["a/x.json.gz", "b/y.JSON", "c/z.csv"]
    assert {r["status"] for r in bad.collect()} == {SRC.UNSUPPORTED_STATUS}


def test_listing_tsv(spark, tmpdir_path):
    _w(f"{tmpdir_path}/l/listing.txt.gz", "seller-sku\tprice\nA1\t1\nA1\t2\n\t3\nB\x002\t4\n".encode(), gz=True)
    got = sorted(r["seller-sku"] for r in SRC.read_listing_tsv(spark, f"{tmpdir_path}/l").collect())
    assert got == ["A1", "B2"]


def test_path_metadata_from_end(spark):
    df = spark.createDataFrame(
        [("s3://bucket/prefix/vendor-x/reports/SP/campaign__daily_sum/US/2/1023/20240320-20240321/f.json.gz",),
         ("root/reports/SB/keyword/CA/9/77/20240101-20240101/g.json",)], "_file string")
    rows = path_metadata(df, kind="report").orderBy("_ad_type").collect()
    r = rows[1]
    assert (r["_ad_type"], r["_report_type"], r["_report_options"], r["_country"], r["_client_id"], r["_profile_id"],
            r["_start_date"], r["_end_date"]) == ("SP", "campaign", ["daily", "sum"], "US", "2", "1023",
                                                  "2024-03-20", "2024-03-21")
    assert rows[0]["_report_options"] == []
    ent = spark.createDataFrame([("x/entities/SD/target/UK/4/55/e.json.gz",)], "_file string")
    e = path_metadata(ent, kind="entity").first()
    assert (e["_ad_type"], e["_report_type"], e["_country"], e["_client_id"], e["_profile_id"]) == ("SD", "target", "UK", "4", "55")


def test_object_key_decode(spark):
    ev = spark.createDataFrame([("reports%2FSP%2Fa+b.json",)], "key string")
    assert object_key_decode(ev).first()["key"] == "reports/SP/a b.json"


def test_listing_encoding_is_found_per_value(spark, tmpdir_path):
    for name, charset in (("u.tsv", "utf-8"), ("l.tsv", "latin1")):
        os.makedirs(f"{tmpdir_path}/enc", exist_ok=True)
        with open(f"{tmpdir_path}/enc/{name}", "wb") as f:
            f.write(f"seller-sku\tprice\n{name}-é\t1\nplain\t2\n \t3\n".encode(charset))
    got = sorted(r["seller-sku"] for r in SRC.read_listing_tsv(spark, f"{tmpdir_path}/enc").collect())
    assert got == ["l.tsv-é", "plain", "u.tsv-é"]
