"""Report / entity file ingestion: files -> typed stage -> keyed load.

``clean_files`` is one lazy plan per table: parse the JSON arrays, take metadata from the path,
normalise names, flatten entity objects, stamp, drop unknown columns, cast. ``load_stage`` applies
the table's load method (merge / delete_insert / append) against the current table content and
publishes the result. One table serves all accounts: rows are told apart and partitioned by account
(the client folder of the path), then by day (reports) or key bucket (entities), and a load reads and
replaces exactly the (account, day) or (account, bucket) partitions of its stage. The target is a
table of Spark's catalog (``database``) or a plain folder below ``tables_root``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adspark.functions.text import normalize_value
from adspark.operators import catalog_tables as CT
from adspark.operators import load as L
from adspark.operators import normalize as N
from adspark.operators.evolution import evolve_table
from adspark.sources.files import parse_report, spec_input_schema
from adspark.sources.paths import path_metadata
from adspark.specs import TableSpec


# Columns of the stage that name the fields a delivery holds, and the order of deliveries.
PRESENT, ORDER, KEYS = "_present", "_order", "_keys"
#: Carried through parsing and cleaning where the rows have it: the id of a file's delivery.
DELIVERY = "_delivery"


def _named(value: Column, keys: Column) -> Column:
    """N-01 on JSON: the report with its keys normalised, as JSON text; untouched where all are. Of
    keys that become equal the first of an object stays."""
    objects = F.from_json(value, "array<map<string,string>>")
    renamed = F.transform(objects, lambda m: F.aggregate(
        F.map_entries(m), F.from_json(F.lit("{}"), "map<string,string>"),
        lambda acc, e: F.when(F.map_contains_key(acc, normalize_value(e["key"])), acc).otherwise(F.map_concat(acc, F.create_map(normalize_value(e["key"]), e["value"])))))
    return F.when(F.exists(keys, lambda k: k != normalize_value(k)), F.to_json(renamed)).otherwise(value)


def parse_files(files: DataFrame, spec: TableSpec, *, presence: bool = False) -> DataFrame:
    """Whole-file rows (``_file``, ``_mtime``, ``value``) to one row per array element, every
    configured field as text, keys by the naming rules (N-01). ``_keys`` lists the fields that any
    object of the file names, known or not (one that is null throughout is there, an absent one is
    not); with ``presence`` also as ``_present``. A file that is not one whole report is an error."""
    schema = spec_input_schema(spec)
    names = F.transform(F.from_json(F.col("value"), "array<map<string,string>>"), lambda m: F.map_keys(m))
    files = files.withColumn(KEYS, F.array_distinct(F.flatten(F.filter(names, lambda n: n.isNotNull()))))
    files = files.withColumn("value", _named(F.col("value"), F.col(KEYS))).withColumn(KEYS, F.array_distinct(F.transform(KEYS, lambda k: normalize_value(k))))
    present = [F.col(KEYS).alias(PRESENT)] if presence else []
    carried = ["_file", "_mtime", *(c for c in (DELIVERY,) if c in files.columns)]
    return files.select(*carried, KEYS, *present, F.inline(parse_report(F.col("value"), schema, file=F.col("_file"))))


class LoadQuality:
    """What a load replaced or left out (N-03, N-05), observed while its stage is made: no pass of
    its own. Each part of the stage (JSON files, CSV files of one header) has its own observation."""

    def __init__(self) -> None:
        self.parts: list[tuple[Observation, list[str], list[str]]] = []

    def watch(self, rows: DataFrame, spec: TableSpec) -> DataFrame:
        types = {f.name: f.dataType for f in rows.schema}
        cast = [(c, t) for c, t in spec.columns if c in types]
        seen, metrics = Observation(), [F.count(F.lit(1)).alias("rows")]
        metrics += [F.count_if(N.bad_value(F.col(f"`{c}`"), types[c], t)).alias(f"bad_{i}") for i, (c, t) in enumerate(cast)]
        extra = []
        if KEYS in rows.columns:
            metrics.append(F.collect_set(KEYS).alias("keys"))  # one entry per set of names
        else:
            extra = [c for c in rows.columns if not c.startswith("_")]
        self.parts.append((seen, [c for c, _ in cast], extra))
        return rows.observe(seen, *metrics)

    def rows(self, spec: TableSpec) -> list[tuple[str, str, int | None]]:
        """(column, kind, n): ``rejected`` values that became the default, ``dropped`` columns (n is
        NULL) and, for the column ``*``, the ``rows`` of the stage. To be called after the load."""
        known = {*spec.column_names, "budget", "extendedData"}
        bad: dict[str, int] = {}
        total, dropped = 0, set()
        for seen, columns, extra in self.parts:
            got = seen.get
            total += got["rows"]
            for i, c in enumerate(columns):
                bad[c] = bad.get(c, 0) + got[f"bad_{i}"]
            dropped |= {k for keys in got.get("keys") or [] for k in keys} | set(extra if got["rows"] else [])
        return [("*", "rows", total), *((c, "rejected", n) for c, n in sorted(bad.items()) if n), *((c, "dropped", None) for c in sorted(dropped - known))]


def clean_rows(rows: DataFrame, spec: TableSpec, *, now: Column, presence: bool = False, account: bool = False,
               quality: LoadQuality | None = None) -> DataFrame:
    """Parsed rows (with ``_file``) of one table to typed columns plus ``_file`` / ``_mtime``: path
    metadata, entity flattening, stamping, unknown columns dropped, cast with type defaults (also for
    columns that the rows lack). With ``account`` also ``account_id``, the client of the path. With ``presence`` also ``_present``, the columns of the delivery: those
    of ``rows`` unless it has its own list, and those that are stamped on every row. ``quality``
    observes what the cast replaces and what is dropped."""
    kind = "report" if spec.table_type == "report" else "entity"
    carried = ["_file", "_mtime", *(c for c in (DELIVERY,) if c in rows.columns)]
    if presence:
        given = F.col(PRESENT) if PRESENT in rows.columns else F.array(*map(F.lit, rows.columns))
        stamped = ["last_updated", *spec.merge_columns]
        rows = rows.withColumn(PRESENT, F.array_union(given, F.array(*map(F.lit, stamped))))
        carried.append(PRESENT)
    absent = [c for c in spec.column_names if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if kind == "report" and absent else rows
    rows = path_metadata(rows, kind=kind)
    if kind == "entity":
        if spec.name == "portfolio":
            rows = N.flatten_portfolio_budget(rows)
        elif spec.name == "campaign":
            rows = N.flatten_campaign_budget(rows)
        else:
            rows = rows.drop("budget")
        rows = N.flatten_extended_data(rows)
    else:
        rows = rows.drop("budget", "extendedData")
        rows = N.default_report_date(rows, spec, F.col("_start_date"))
    rows = N.stamp_columns(rows, kind=kind, ad_type=spec.ad_type, now=now)
    rows = N.stringify_nested(rows, spec)
    if quality is not None:
        rows = quality.watch(rows, spec)
    rows, _ = N.drop_unknown_columns(rows, spec)
    typed, _ = N.cast_to_schema(rows, spec, add_missing=True)
    whose = [F.col("_client_id").alias(L.ACCOUNT)] if account else []
    return typed.select(*spec.column_names, *carried, *whose)


def clean_files(files: DataFrame, spec: TableSpec, *, now: Column, presence: bool = False, account: bool = False,
                quality: LoadQuality | None = None) -> DataFrame:
    """``parse_files`` then ``clean_rows``: one lazy plan per table."""
    return clean_rows(parse_files(files, spec, presence=presence), spec, now=now, presence=presence, account=account, quality=quality)


def wants_presence(spec: TableSpec) -> bool:
    """Upserted tables: a delivery replaces only the columns it holds."""
    return spec.load_method == "merge"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = L._fs(spark, path)
    return fs.exists(p)


def table_path(tables_root: str, spec: TableSpec) -> str:
    return os.path.join(tables_root.rstrip("/"), spec.dataset, spec.table_name)


def latest_file_rows(stage: DataFrame, spec: TableSpec) -> DataFrame:
    """T-03: within one batch, the newest file wins. For merge tables per key row (grouped
    ``max_by``, partial aggregation before the shuffle); for delete_insert tables per key group: the
    rows of the newest delivery holding that group (``_delivery``, its order; without it a file is a
    delivery)."""
    keys = [c for c in (L.ACCOUNT,) if c in stage.columns] + list(spec.merge_columns)
    if spec.load_method == "merge":
        return L.dedupe_stage(stage.drop(DELIVERY).withColumn("_order", F.struct("_mtime", "_file")), keys,
                              conflict="latest_wins", order_by="_order").drop("_order")
    # Null-safe on the keys: rows without a key form a group too.
    order = F.col(DELIVERY) if DELIVERY in stage.columns else F.struct("_mtime", "_file")
    newest = stage.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(order).alias("_newest"))
    same = F.col("_newest").eqNullSafe(order)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
    return stage.join(newest, same, "left_semi")


def _touched_condition(touched: list[tuple], parts: list[str]) -> Column:
    """True for exactly the partitions ``touched``, as comparisons with literals that prune partitions
    at planning. Accounts with the same days (or buckets) share one comparison."""
    of: dict[str, set] = {}
    for account, other in touched:
        of.setdefault(account, set()).add(other)
    sharing: dict[tuple, list[str]] = {}
    for account, others in of.items():
        sharing.setdefault(tuple(sorted(others)), []).append(account)
    cond = F.lit(False)
    for others, accounts in sharing.items():
        cond = cond | (F.col(parts[0]).isin(accounts) & F.col(parts[1]).isin(list(others)))
    return cond


def database_name(spec: TableSpec, database: str) -> str:
    """Each dataset is a database; ``database`` is a prefix that keeps installations apart."""
    return f"{database}{spec.dataset}"


def read_table(spark: SparkSession, tables_root: str, spec: TableSpec, *, database: str | None = None,
               account: str | None = None, partitions: bool = False) -> DataFrame | None:
    """The loaded table (schema columns, with ``partitions`` also the partition columns), of one
    ``account`` or of all, or None before the first load."""
    if database is not None:
        name = f"{database_name(spec, database)}.{spec.table_name}"
        if not spark.catalog.tableExists(name):
            return None
        rows = spark.table(name)
    else:
        path = table_path(tables_root, spec)
        if not _exists(spark, path):
            return None
        rows = spark.read.schema(L.partition_schema(spec)).parquet(path)
    if account is not None:
        rows = rows.where(F.col(L.ACCOUNT) == account)
    return rows.select(*spec.column_names, *(L.partition_columns(spec) if partitions else []))


def _catalog_table(spark: SparkSession, spec: TableSpec, tables_root: str, database: str, buckets: int) -> str:
    """The catalog table that a load fills, with the columns and types that the specification has now
    (added or widened in place; a type that needs files rewritten is an error, see ``evolve_table``). Data that the catalog does not know (its session has
    ended) is refused: a new table would hide it."""
    name, path = f"{database_name(spec, database)}.{spec.table_name}", table_path(tables_root, spec)
    if not spark.catalog.tableExists(name):
        if _exists(spark, path):
            raise ValueError(f"{path} holds data of a table that this catalog does not know: {name}")
        L.create_table_from_spec(spark, spec, location=path, database=database_name(spec, database), buckets=buckets)
    else:
        evolve_table(spark, name, L.partition_schema(spec))
    kept = CT.table_property(spark, name, "buckets")
    if kept is not None and int(kept) != buckets:
        raise ValueError(f"{name} is stored in {kept} buckets, not {buckets}")
    return name


def load_stage(spark: SparkSession, stage: DataFrame, spec: TableSpec, *, tables_root: str,
               staging_root: str, batch_id: str | None = None, buckets: int = L.ENTITY_BUCKETS, database: str | None = None) -> None:
    """Apply the table's load method within each account and publish only the touched partitions: with
    ``database`` into the catalog table (rows are written once, then the partitions' locations
    change), else by dynamic partition overwrite of the table's folder. A stage with ``_present`` is
    upserted column by column (``merge_upsert_subset``); one without ``account_id`` belongs to the
    account ``none``. The touched partitions (of one batch's files) are listed on the driver."""
    subset = PRESENT in stage.columns and spec.load_method == "merge"
    stage = L.with_partitions(stage, spec, buckets=buckets)
    if subset:
        stage = stage.withColumn(ORDER, F.struct("_mtime", "_file")).drop("_file", "_mtime", DELIVERY)
    else:
        stage = latest_file_rows(stage, spec).drop("_file", "_mtime", DELIVERY)
    parts, schema, path = L.partition_columns(spec), L.partition_schema(spec), table_path(tables_root, spec)
    keys = [L.ACCOUNT, *spec.merge_columns]
    counts = stage.groupBy(*parts).count().collect()
    touched = [tuple(r)[:-1] for r in counts]
    if not touched:
        return
    if database is not None:
        name = _catalog_table(spark, spec, tables_root, database, buckets)
        current = spark.table(name)
    else:
        if not spec.partition_column:
            L.keep_bucket_count(spark, path, buckets, store=True)
        exists = L.has_partitions(spark, path)
        current = spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)
    current = current.select(*schema.names).where(_touched_condition(touched, parts))
    stage = stage.select(*schema.names, *([PRESENT, ORDER] if subset else []))
    if subset:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(r["count"] for r in counts) // L.ROWS_PER_TASK))
        new = L.merge_upsert_subset(current, stage, keys, present=PRESENT, order_by=ORDER, num_partitions=tasks)
    elif spec.load_method == "merge":
        new = L.merge_upsert(current, stage, keys, conflict="none")
    elif spec.load_method == "delete_insert":
        new = L.delete_insert(current, stage, keys)
    else:
        new = L.append_rows(current, stage)
    cluster = list(spec.cluster_columns) or None
    if database is not None:
        CT.publish_partitions_to_catalog(new, name, parts, touched, cluster_by=cluster)
    else:
        L.publish_partitions(new, path, parts, staging_root=staging_root, cluster_by=cluster, reads_target=exists)
