"""Deliveries of several files (T-03): the newest complete delivery wins, not the newest file.

A file below ``.../delivery=<id>/part=<k>-of-<n>/`` is part k of a delivery of n files for its folder
(ad type, table, country, client, profile and, for reports, dates). Ids of a folder sort in time
order. What has been received is kept in ``_deliveries`` next to the tables, one row a file, since
the parts may come in several micro-batches; a delivery loads, whole, in the micro-batch that makes
it complete, unless one with a greater id has been loaded before. An incomplete delivery changes
nothing. Files outside such folders are deliveries of one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.operators.load import _fs
from adspark.sources.files import whole_files

DELIVERY = "_delivery"
_PATH = r"/delivery=([^/]+)/part=([0-9]{1,9})-of-([0-9]{1,9})/(.*)/[^/]*$"
_RECEIVED = "folder string, delivery string, part int, parts int, _file string, _mtime timestamp"
_LOADED = "folder string, delivery string"


def with_delivery(files: DataFrame) -> DataFrame:
    """``files`` (``_file``, ``_mtime``) with ``_delivery``: folder, id (of a file on its own its time
    and name), part and parts."""
    def group(i: int):
        found = F.regexp_extract("_file", _PATH, i)
        return F.when(found != "", found)
    alone = F.concat(F.date_format("_mtime", "yyyyMMdd'T'HHmmss.SSSSSS"), F.lit(" "), F.col("_file"))
    return files.withColumn(DELIVERY, F.struct(group(4).alias("folder"), F.coalesce(group(1), alone).alias("id"), group(2).cast("int").alias("part"), group(3).cast("int").alias("parts")))


def _read(spark: SparkSession, root: str, name: str, schema: str, skip: str) -> DataFrame:
    """The rows that the query's other micro-batches have stored; a replay replaces its own."""
    path = f"{root.rstrip('/')}/{name}"
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, query string, batch_id string").parquet(path)
    return rows.where(F.concat_ws("/", "query", "batch_id") != skip).drop("query", "batch_id")


def complete_deliveries(files: DataFrame, *, tables_root: str, query_id: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Of a micro-batch's ``files`` (with ``_delivery``) those to load now, files that earlier
    micro-batches received for the same deliveries included, and (folder, delivery) of the
    deliveries that are loaded with them (to be stored by ``store_loaded`` after the load)."""
    spark, at = files.sparkSession, f"{query_id}/{batch_id}"
    parted = files.where(F.col(f"{DELIVERY}.folder").isNotNull())
    received = parted.select(f"{DELIVERY}.folder", F.col(f"{DELIVERY}.id").alias("delivery"), f"{DELIVERY}.part", f"{DELIVERY}.parts", "_file", "_mtime")
    here = received.select("folder", "delivery").distinct()
    if here.isEmpty():
        return files, spark.createDataFrame([], _LOADED)
    received.write.mode("overwrite").parquet(f"{tables_root.rstrip('/')}/_deliveries/query={query_id}/batch_id={batch_id}")
    earlier = _read(spark, tables_root, "_deliveries", _RECEIVED, at).join(here, ["folder", "delivery"], "left_semi")
    known = received.withColumn("now", F.lit(True)).unionByName(earlier.withColumn("now", F.lit(False)))
    # of a part that came twice the newer file counts
    known = known.groupBy("folder", "delivery", "part").agg(F.max(F.struct("_mtime", "_file", "now")).alias("f"), F.max("parts").alias("parts"))
    whole = known.where("part between 1 and parts").groupBy("folder", "delivery").agg(F.count("*").alias("have"), F.max("parts").alias("parts")).where("have >= parts")
    newest = whole.groupBy("folder").agg(F.max("delivery").alias("delivery"))
    loaded = _read(spark, tables_root, "_loaded_deliveries", _LOADED, at).groupBy("folder").agg(F.max("delivery").alias("loaded"))
    newest = newest.join(loaded, "folder", "left").where("loaded is null or delivery >= loaded").select("folder", "delivery").persist()
    chosen = known.join(newest, ["folder", "delivery"]).select("folder", "delivery", "f._file", "f.now")
    now = parted.join(chosen.where("now").select("_file"), "_file", "left_semi")
    out = files.where(F.col(f"{DELIVERY}.folder").isNull()).unionByName(now)
    # Files of earlier micro-batches, by name: bounded by the deliveries that this one completes.
    old = [r[0] for r in chosen.where("not now").select("_file").collect()]
    if old:
        again = with_delivery(whole_files(spark, old, recursive=False))
        out = out.unionByName(again.select(again.columns), allowMissingColumns=True)
    return out, newest


def store_loaded(newest: DataFrame, *, tables_root: str, query_id: str, batch_id: int) -> None:
    newest.write.mode("overwrite").parquet(f"{tables_root.rstrip('/')}/_loaded_deliveries/query={query_id}/batch_id={batch_id}")
