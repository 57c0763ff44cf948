"""T-01..T-03: each new file is cleaned and loaded once by its table's method.

``readStream`` of whole files (gzip decompressed transparently) -> ``foreachBatch``: the
micro-batch is split by table (at most the 36 configured tables, a bounded driver-side list), each
table's rows are cleaned by ``clean_files`` and loaded by ``load_stage``. Idempotence (T-02): a
marker per (query, micro-batch, table) is written after publishing; a replayed micro-batch skips
tables already committed, the load methods (upsert / snapshot replacement) are idempotent anyway, and
the audit rows of a micro-batch replace those of its earlier attempt.
Latest file wins inside a micro-batch (T-03, ``latest_file_rows``); a delivery of several files loads
when it is complete (``deliveries``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adspark.functions.text import decode_with_fallback
from adspark.operators import load as L
from adspark.operators import normalize as N
from adspark.operators.aggregates import row_count
from adspark.plans.ingest import LoadQuality, clean_files, clean_rows, load_stage, wants_presence
from adspark.session import scratch_dir
from adspark.sources.files import file_format_gate, header_gate, parse_report, read_csv_files
from adspark.sources.paths import path_metadata, source_path
from adspark.specs import get_spec, load_specs
from adspark.streaming import deliveries as D


def _marker(spark: SparkSession, root: str, query_id: str, batch_id: int, table: str) -> tuple:
    fs, p, _ = L._fs(spark, f"{root.rstrip('/')}/_commits/{query_id}/{batch_id}/{table}")
    return fs, p


def _write_status(df: DataFrame, tables_root: str, name: str, query_id: str, batch_id: int, *more: str) -> None:
    """Audit tables next to the data: ``_rejects`` (files not loaded, with a status), ``_file_status``
    (rows loaded per file, A-01) and ``_load_quality`` (rejected values and dropped columns), one folder per query, micro-batch (and table), so
    that a replay replaces its own rows."""
    df.write.mode("overwrite").parquet("/".join([tables_root.rstrip("/"), name, f"query={query_id}", f"batch_id={batch_id}", *more]))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint; another checkpoint is another query."""
    return spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def _file_headers(files: DataFrame) -> DataFrame:
    """Header names per file: first line split by commas for CSV, keys of the first object for JSON;
    ``unreadable`` marks JSON files that are not one whole value (cut short, or going on after it)."""
    first_line = F.regexp_replace(F.substring_index(F.col("value"), "\n", 1), "\r$", "")
    csv_cols = F.when(F.trim(first_line) == "", F.array().cast("array<string>")).otherwise(F.split(first_line, ","))
    json_cols = F.coalesce(F.json_object_keys(F.get_json_object(F.col("value"), "$[0]")), F.json_object_keys(F.col("value")),
                           F.array().cast("array<string>"))
    parsed = parse_report(F.col("value"), T.StructType([T.StructField("date", T.StringType())]))
    return files.withColumns({"columns": F.when(F.col("extension") == ".csv", csv_cols).otherwise(json_cols),
                              "unreadable": (F.col("extension") != ".csv") & parsed.isNull()})


def read_csv_rows(spark: SparkSession, paths: list[str], header: str) -> DataFrame:
    """CSV report files sharing one header line: every column as text, names normalised (N-01)."""
    return N.normalize_columns(read_csv_files(spark, paths, header))


def process_batch(files: DataFrame, batch_id: int, *, tables_root: str, kind: str, now: Column,
                  staging_root: str, query_id: str = "batch", database: str | None = None) -> None:
    """Load one micro-batch into the catalog tables of ``database``, or the folders of ``tables_root``.

    Files with another extension than ``.gz .json .csv`` (I-13), files for no configured table (also
    those whose path is too short to name one), files without a header or whose header names an
    ``Error`` column or holds ``<html>`` (I-14) and JSON files that do not parse (truncated, plain text,
    compressed CSV) are recorded in ``_rejects`` and not loaded. JSON / gzip files are parsed as JSON arrays; CSV files are read by
    Spark's CSV reader, one read per distinct header (names normalised). The batch's files and each
    table's stage are persisted for the duration of the batch (they are read several times); a lost
    executor recomputes them from the files.
    """
    spark = files.sparkSession
    files = path_metadata(files, kind=kind)
    files, bad_format = file_format_gate(files, path="_file")
    files = files.persist(StorageLevel.MEMORY_AND_DISK)
    bad_header = None
    try:
        named = F.lit(False)
        for spec in load_specs():
            if spec.table_type == kind:
                named = named | ((F.col("_ad_type") == spec.ad_type) & (F.col("_report_type") == spec.name))
        named = F.coalesce(named, F.lit(False))
        gated = header_gate(_file_headers(files.filter(named)), path="_file", keep=("unreadable",))
        status = F.when(F.col("unreadable"), F.lit("UNREADABLE")).when(F.col("verdict") == "empty", F.lit("EMPTY")) \
            .when(F.col("verdict").isin("error_column", "html"), F.lit("INVALID_HEADER"))
        # The verdict parses every file; it is read by all steps below, so it is kept.
        bad_header = gated.select("_file", status.alias("status")).filter("status is not null").persist(StorageLevel.MEMORY_AND_DISK)
        rejects = bad_format.select("_file", "status").unionByName(bad_header) \
            .unionByName(files.filter(~named).select("_file", F.lit("UNKNOWN_TABLE").alias("status")))
        _write_status(rejects, tables_root, "_rejects", query_id, batch_id)
        good = files.filter(named).join(bad_header.select("_file"), "_file", "left_anti")
        good, deliveries = D.complete_deliveries(D.with_delivery(good.select("_file", "_mtime", "value")), tables_root=tables_root, query_id=query_id, batch_id=batch_id)
        good, _ = file_format_gate(path_metadata(good, kind=kind), path="_file")
        good = good.withColumn(D.DELIVERY, F.col(f"{D.DELIVERY}.id"))
        # Bounded: one row per configured table present in this micro-batch (36 at most).
        tables = [(r["_ad_type"], r["_report_type"]) for r in good.select("_ad_type", "_report_type").distinct().collect()]
        for ad_type, name in sorted(tables):
            spec = get_spec(kind, ad_type, name)
            fs, marker = _marker(spark, tables_root, query_id, batch_id, f"{spec.dataset}.{spec.table_name}")
            if fs.exists(marker):
                continue
            part = good.filter((F.col("_ad_type") == ad_type) & (F.col("_report_type") == name))
            quality = LoadQuality()
            stage = clean_files(part.filter(F.col("extension") != ".csv").select("_file", "_mtime", D.DELIVERY, "value"),
                                spec, now=now, presence=wants_presence(spec), account=True, quality=quality)
            # CSV files of this table, grouped by header (bounded by the files of one micro-batch).
            csv = part.filter(F.col("extension") == ".csv")
            csv = csv.select("_file", D.DELIVERY, F.regexp_replace(F.substring_index(F.col("value"), "\n", 1), "\r$", "").alias("_header"))
            groups: dict[str, list[str]] = {}
            for r in csv.collect():
                groups.setdefault(r["_header"], []).append(r["_file"])
            for header, paths in groups.items():
                stage = stage.unionByName(clean_rows(read_csv_rows(spark, paths, header).join(csv.select("_file", D.DELIVERY), "_file"), spec, now=now, presence=wants_presence(spec), account=True, quality=quality))
            stage = stage.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                load_stage(spark, stage, spec, tables_root=tables_root, staging_root=staging_root,
                           batch_id=str(batch_id), database=database)
                counts = row_count(stage, by=("_file",)).select(
                    "_file", "row_count")
                _write_status(counts, tables_root, "_file_status", query_id, batch_id, f"table={spec.dataset}.{spec.table_name}")
                kept = spark.createDataFrame(quality.rows(spec), "column string, kind string, n long")
                _write_status(kept, tables_root, "_load_quality", query_id, batch_id, f"table={spec.dataset}.{spec.table_name}")
            finally:
                stage.unpersist()
            fs.create(marker, True).close()
        D.store_loaded(deliveries, tables_root=tables_root, query_id=query_id, batch_id=batch_id)
    finally:
        if bad_header is not None:
            bad_header.unpersist()
        files.unpersist()


def ingest_stream(spark: SparkSession, landing: str, *, tables_root: str, checkpoint: str,
                  kind: str = "report", now: Column | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = 10_000, database: str | None = None) -> StreamingQuery:
    """Start the file-stream ingestion; with ``available_now`` it processes what is there and stops.
    With ``database`` it fills the tables of Spark's catalog (``create_table_from_spec``; a prefix of
    the dataset names, may be empty), else the table folders of ``tables_root``.
    ``max_files_per_trigger`` bounds a micro-batch (a backlog is split into several batches), which
    also bounds the per-batch driver-side lists (tables present, CSV header groups)."""
    now = F.current_timestamp() if now is None else now
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(landing)
    files = raw.select(source_path().alias("_file"),
                       F.col("_metadata.file_modification_time").alias("_mtime"),
                       decode_with_fallback(F.col("value")).alias("value"))
    staging_root = scratch_dir(spark, "stream-staging")

    def run(df: DataFrame, batch_id: int) -> None:
        process_batch(df, batch_id, tables_root=tables_root, kind=kind, now=now, staging_root=staging_root,
                      query_id=_query_id(spark, checkpoint), database=database)

    writer = files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


#: Rows (expected number) of one written JSON array.
ROWS_PER_FILE = 20_000


def write_array_files(rows: DataFrame, landing: str, *, root: str, ad_type: str, name: str, country: str,
                      profile: str, dates: str | None = None, client: str | None = None, delivery: str | None = None, tail: str | None = None,
                      files_per_group: int = 2) -> None:
    """Write rows as JSON-array files under the report / entity path layout
    (``<part>/<root>/<ad_type>/<name>/<country>/<client>/<profile>[/<dates>]/part-*``). Each group of
    (client, profile, dates) is split by the hash of its rows over at least ``files_per_group`` files, and
    more by its row count, so that an array holds about ROWS_PER_FILE rows (rows equal in all columns
    share one); the first folder carries the file's number in the group, so every folder holds exactly
    one array. ``client``, ``profile`` and ``dates`` are columns; without ``client`` all rows belong to
    client 7. With ``delivery`` the files of a group are the numbered parts of one delivery of that id
    (``deliveries``). ``tail`` is a column of the group (or NULL) that is put behind the array."""
    rows = rows if client else rows.withColumn("_client_key", F.lit("7"))
    keys = [client or "_client_key", profile] + ([dates] if dates else []) + ([tail] if tail else [])
    payload = [c for c in rows.columns if c not in keys]
    files = F.greatest(F.lit(files_per_group), F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE))
    groups = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(files.alias("_files"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    parts = rows.join(groups, same).withColumn("_part", F.pmod(F.xxhash64(*payload), F.col("_files")))
    grouped = parts.repartition(max(2, -(-rows.count() // ROWS_PER_FILE)), *keys, "_part")
    docs = grouped.groupBy(*keys, "_part").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*payload))), ","), F.lit("]")).alias("value"))
    part = F.col("_part").cast("string")
    if delivery:  # numbered without gaps: a part that no row fell into does not exist
        group = Window.partitionBy(*keys)
        docs = docs.withColumns({"_nth": F.row_number().over(group.orderBy("_part")), "_all": F.count("*").over(group)})
        part = F.concat(F.col("_nth").cast("string"), F.lit("-of-"), F.col("_all").cast("string"))
    if tail:
        docs = docs.withColumn("value", F.concat("value", F.coalesce(tail, F.lit(""))))
    layout = ["delivery", "part"] if delivery else ["_part"]
    layout += ["_root", "_ad", "_type", "_country", "_client", "_profile"] + (["_dates"] if dates else [])
    cols = [part.alias("part" if delivery else "_part"), *([F.lit(delivery).alias("delivery")] if delivery else []), F.lit(root).alias("_root"), F.lit(ad_type).alias("_ad"), F.lit(name).alias("_type"),
            F.lit(country).alias("_country"), F.col(keys[0]).cast("string").alias("_client"),
            F.col(profile).alias("_profile")] + ([F.col(dates).alias("_dates")] if dates else [])
    docs.select(*cols, "value").write.mode("overwrite").option("compression", "gzip").partitionBy(*layout).text(landing)


def write_report_files(orders: DataFrame, landing: str, *, files_per_group: int = 2) -> None:
    """Report files made from orders for the stand-in ingestion: monthly SP campaign rows
    (``campaignId`` = order key, ``cost`` = total price, ``date`` = first day of the order month),
    one profile per order status and one date range per order year."""
    year = F.date_format("o_orderdate", "yyyy")
    rows = orders.select(
        F.concat(F.lit("P"), F.col("o_orderstatus")).alias("_profile_key"),
        F.concat(year, F.lit("0101-"), year, F.lit("1231")).alias("_dates_key"),
        F.col("o_orderkey").alias("campaignId"), F.col("o_totalprice").alias("cost"),
        F.date_format("o_orderdate", "yyyy-MM-01").alias("date"), F.col("o_custkey").alias("impressions"),
        F.col("o_orderpriority").alias("campaignName"), F.col("o_orderstatus").alias("campaignStatus"))
    write_array_files(rows, landing, root="reports", ad_type="SP", name="campaign", country="US",
                      profile="_profile_key", dates="_dates_key", files_per_group=files_per_group)
