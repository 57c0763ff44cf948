"""Warehouse loads and sinks.

Plain Parquet tables refuse MERGE / DELETE and a table cannot overwrite the path it is read from,
so every load computes the new content as a DataFrame (anti join + union: the target is only
streamed, the stage keys are the small side and AQE broadcasts them when small) and publishes the
partitions that the stage touches: into a catalog table by a change of their locations
(``catalog_tables``), or into a plain folder by dynamic partition overwrite (``publish_partitions``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.specs import SPARK_TYPES, TableSpec


def _on(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _q(c: str) -> str:
    return f"`{c}`"


def assert_unique_key(df: DataFrame, keys) -> DataFrame:
    """L-10: key groups with more than one row (the offenders); empty when the key is unique."""
    keys = _on(keys)
    return df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dedupe_stage(stage: DataFrame, keys, *, conflict: str = "raise", order_by: str | None = None) -> DataFrame:
    """D8: exact duplicate rows are removed; rows that share a key but differ either raise
    (``conflict='raise'``) or the one with the greatest ``order_by`` wins (``'latest_wins'``).

    Both are one grouped aggregate per key (partial aggregation before the shuffle, so a hot key
    does not land whole in one task). The conflict check is lazy: ``raise_error`` fails the query
    that uses the stage, no separate pass over the stage is run.
    """
    keys = _on(keys)
    others = [c for c in stage.columns if c not in keys]
    if conflict == "none":
        return stage.dropDuplicates()
    if not others:
        return stage.dropDuplicates()
    row = F.struct(*[_q(c) for c in others])
    # A NULL key never equals anything (it inserts): such a row is a group of its own, by its content.
    names = [f"_k{i}" for i in range(len(keys))]
    rows = stage.select(*[F.col(_q(k)).alias(n) for k, n in zip(keys, names, strict=True)], _lone_row(stage, keys).alias("_lone"), row.alias("_row"))
    groups = rows.groupBy(*names, "_lone")
    if conflict == "raise":
        out = groups.agg(F.min("_row").alias("_lo"), F.max("_row").alias("_hi"))
        out = out.withColumn("_row", F.when(~F.col("_lo").eqNullSafe(F.col("_hi")), F.raise_error(F.lit(f"stage holds conflicting rows for key {keys}"))).otherwise(F.col("_lo")))
    elif conflict == "latest_wins":
        if order_by is None:
            raise ValueError("latest_wins needs order_by")
        out = groups.agg(F.max(F.struct(F.col("_row")[order_by].alias("at"), F.col("_row").alias("row"))).alias("_row")).withColumn("_row", F.col("_row")["row"])
    else:
        raise ValueError(f"unknown conflict mode {conflict!r}")
    kept = {k: F.col(n) for k, n in zip(keys, names, strict=True)}
    return out.select(*[kept.get(c, F.col("_row")[c]).alias(c) for c in stage.columns])


def _lone_row(stage: DataFrame, keys):
    """The whole row where a key is NULL, else NULL."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(_q(k)).isNull()
    return F.when(no_key, F.struct(*[_q(c) for c in stage.columns]))


def merge_upsert(target: DataFrame, stage: DataFrame, keys, *, conflict: str = "raise",
                 order_by: str | None = None) -> DataFrame:
    """L-01: insert new keys, replace all columns of existing keys. NULL keys never match (plain
    equality), so they insert. Stage rows are de-duplicated first (D8)."""
    keys = _on(keys)
    stage = dedupe_stage(stage, keys, conflict=conflict, order_by=order_by)
    stage = stage.select(*[_q(c) for c in target.columns])
    kept = target.join(stage.select(*[_q(k) for k in keys]), keys, "left_anti")
    return kept.unionByName(stage)


#: Tasks that share the stage rows of one key, and rows of a stage for each task that reduces it.
VERSION_SHARES, ROWS_PER_TASK = 8, 100_000


def merge_upsert_subset(target: DataFrame, stage: DataFrame, keys, *, present: str = "_present",
                        order_by: str = "_order", num_partitions: int | None = None) -> DataFrame:
    """L-01 for deliveries that hold some of the columns: each stage row names its columns in the
    array ``present``. Of an existing key only these are replaced; a new key takes the whole stage
    row (the type defaults where a column is absent). Several rows of a key count in the order of
    ``order_by``, so the newest row that holds a column decides it. NULL keys never match (they
    insert; exact duplicates once).

    Stage rows are first reduced per key and column set (partial aggregation before the shuffle), so
    what is collected per key is one row per distinct column set. One full outer join reads each side
    once.

    With ``num_partitions`` (which follows the number of rows) stage rows are dealt over so many tasks
    before anything is sorted: by key and one of ``VERSION_SHARES`` shares of its rows, then by key.
    """
    keys = _on(keys)
    others = [c for c in target.columns if c not in keys]
    values = F.struct(*[_q(c) for c in others])
    lone = _lone_row(stage.select(*[_q(c) for c in target.columns]), keys)
    group = [F.col(_q(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    rows = stage.select(*group, lone.alias("_lone"), F.sort_array(_q(present)).alias("_has"), F.struct(F.col(_q(order_by)).alias("at"), values.alias("v")).alias("_row"))
    names = [f"_k{i}" for i in range(len(keys))] + ["_lone"]
    if num_partitions is not None:
        # A key's rows lie in several shares; rows without a key are told apart by their content.
        rows = rows.withColumns({"_spread": F.xxhash64("_lone"), "_share": F.pmod(F.xxhash64("_row.at"), F.lit(VERSION_SHARES))})
        names.append("_spread")
        dealt = [n for n in names if n != "_lone"]
        rows = rows.repartition(num_partitions, *dealt, "_share").groupBy(*names, "_has", "_share").agg(F.max("_row").alias("_row")) \
            .repartition(num_partitions, *dealt)
    latest = rows.groupBy(*names, "_has").agg(F.max("_row").alias("_row"))
    versions = latest.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("_row", "_has")), asc=False).alias("_versions"))

    def newest(c):
        held = F.get(F.filter("_versions", lambda v: F.array_contains(v["_has"], c)), F.lit(0))
        return F.struct(held["_row"]["v"][c].alias("x"), held.isNotNull().alias("held"))

    picked = versions.select(*names, F.get("_versions", F.lit(0))["_row"]["v"].alias("_first"),
                             *[newest(c).alias(f"_c{i}") for i, c in enumerate(others)])
    old = target.select(F.struct(*[_q(c) for c in target.columns]).alias("_old"))
    same = F.col("_lone").isNull()
    for i, k in enumerate(keys):
        same = same & (F.col("_old")[k] == F.col(f"_k{i}"))
    both = old.join(picked, same, "full_outer")
    out = {k: F.coalesce(F.col("_old")[k], F.col(f"_k{i}")) for i, k in enumerate(keys)}
    for i, c in enumerate(others):
        out[c] = F.when(F.col(f"_c{i}.held"), F.col(f"_c{i}.x")).when(F.col("_old").isNull(), F.col("_first")[c]).otherwise(F.col("_old")[c])
    return both.select(*[out[c].alias(c) for c in target.columns])


def delete_insert(target: DataFrame, stage: DataFrame, keys) -> DataFrame:
    """L-02: delete target rows sharing the key with any staged row, insert all staged rows (no
    de-duplication)."""
    keys = _on(keys)
    stage = stage.select(*[_q(c) for c in target.columns])
    kept = target.join(stage.select(*[_q(k) for k in keys]).distinct(), keys, "left_anti")
    return kept.unionByName(stage)


def append_rows(target: DataFrame, stage: DataFrame) -> DataFrame:
    """L-03: no key columns: plain insert."""
    return target.unionByName(stage)


def append_evolving(target: DataFrame, stage: DataFrame) -> DataFrame:
    """L-05: append allowing new fields on either side (missing ones are NULL)."""
    return target.unionByName(stage, allowMissingColumns=True)


def merge_delete_missing(target: DataFrame, stage: DataFrame, keys, *, scope) -> DataFrame:
    """L-04: upsert, and within the scope values present in the stage (e.g. the profile) delete
    target rows the stage no longer holds."""
    keys, scope = _on(keys), _on(scope)
    stage = dedupe_stage(stage, keys).select(*[_q(c) for c in target.columns])
    kept = target.join(stage.select(*[_q(k) for k in keys]), keys, "left_anti") \
        .join(stage.select(*[_q(s) for s in scope]).distinct(), scope, "left_anti")
    return kept.unionByName(stage)


def add_missing_columns(df: DataFrame, spec) -> DataFrame:
    """L-06: add configured columns the frame lacks (typed NULL); never drops a column."""
    columns = spec.columns if isinstance(spec, TableSpec) else tuple(spec)
    missing = {c: F.lit(None).cast(SPARK_TYPES.get(t, T.StringType())) for c, t in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def select_load_columns(df: DataFrame, spec) -> DataFrame:
    """L-14: the frame's columns that the schema knows, order kept, ``id`` excluded."""
    names = set(spec.column_names if isinstance(spec, TableSpec) else [c for c, _ in spec])
    return df.select(*[_q(c) for c in df.columns if c in names and c != "id"])


# Type families treated as compatible when comparing a live schema to the expected one.
_COMPAT_GROUPS = (
    {"string", "varchar", "text", "char"},
    {"double", "float", "decimal"},
    {"timestamp", "timestamp_ntz", "datetime", "date"},
    {"bigint", "int", "integer", "smallint", "long", "tinyint"},
    {"boolean", "bool"},
)


def _family(type_name: str) -> str:
    return type_name.split("(")[0].strip().lower()


def _compatible(expected: str, actual: str) -> bool:
    e, a = _family(expected), _family(actual)
    return e == a or any(e in g and a in g for g in _COMPAT_GROUPS)


def schema_compat(df: DataFrame, expected) -> DataFrame:
    """L-11: compare the frame's columns with ``expected`` ``[(name, simple_type)]``; verdict per
    column: ``ok``, ``add`` (missing, to be added) or ``mismatch`` (incompatible type)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name, exp in expected:
        act = actual.get(name)
        if act is None:
            verdict = "add"
        else:
            verdict = "ok" if _compatible(exp, act) else "mismatch"
        rows.append((name, exp, act, verdict))
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, verdict string")


def history_upsert(history: DataFrame, stage: DataFrame, keys, *, keep_if_null=("product_hash",)) -> DataFrame:
    """L-15: upsert by key; for ``keep_if_null`` columns a NULL in the stage keeps the old value."""
    keys = _on(keys)
    keep = [c for c in keep_if_null if c in history.columns and c in stage.columns]
    # One full outer join: each side is read and shuffled once.
    h = history.withColumn("_old", F.lit(True)).alias("h")
    s = stage.select(*[_q(c) for c in history.columns]).withColumn("_new", F.lit(True)).alias("s")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"h.`{k}`") == F.col(f"s.`{k}`"))

    def pick(c: str):
        new, old = F.col(f"s.`{c}`"), F.col(f"h.`{c}`")
        return F.when(F.col("s._new"), F.coalesce(new, old) if c in keep else new).otherwise(old).alias(c)
    return h.join(s, on, "full_outer").select(*[pick(c) for c in history.columns])


# ---------------------------------------------------------------------------------------------
# Sinks and publishing
# ---------------------------------------------------------------------------------------------

def write_parquet(df: DataFrame, path: str, *, by=None, single: bool = False, mode: str = "overwrite",
                  compression: str | None = None) -> None:
    """L-12: Parquet files (one file only on request: ``single`` funnels through one task), by the session's
    codec or the one given."""
    w = (df.coalesce(1) if single else df).write.mode(mode)
    if by:
        w = w.partitionBy(*_on(by))
    w.parquet(path, compression=compression)


def write_csv(df: DataFrame, path: str, *, single: bool = False, mode: str = "overwrite") -> None:
    """L-13: CSV with a header line per file."""
    (df.coalesce(1) if single else df).write.mode(mode).option("header", True).csv(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def has_partitions(spark: SparkSession, path: str) -> bool:
    """True if a plain table folder holds a partition folder."""
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p)) and any(s.isDirectory() and "=" in s.getPath().getName() for s in fs.listStatus(p))


def keep_bucket_count(spark: SparkSession, table_root: str, buckets: int, *, store: bool = False) -> None:
    """A bucketed table keeps the bucket count it was written with: another count would leave old
    copies of rows in other folders, so it is refused. ``store`` records the count."""
    fs, p, jvm = _fs(spark, f"{table_root.rstrip('/')}/_bucket_count")
    if fs.exists(p):
        stream = fs.open(p)
        try:
            known = stream.readInt()
        finally:
            stream.close()
        if known != buckets:
            raise ValueError(f"{table_root} is stored in {known} buckets, not {buckets}")
    elif store:
        stream = fs.create(p, True)
        try:
            stream.writeInt(buckets)
        finally:
            stream.close()


# Partition columns of stored tables: the account (one table serves all), then the day of a report
# or the hash bucket of an entity's snapshot key. Values that are absent have a name of their own,
# since a partition value can be neither null nor empty.
ACCOUNT, DAY, BUCKET_COLUMN = "account_id", "day", "_bucket"
NO_ACCOUNT, NO_DAY = "none", "none"
#: Entity tables have no day: replacing one profile's snapshot rewrites one bucket, not the table.
ENTITY_BUCKETS = 64


def partition_columns(spec: TableSpec) -> list[str]:
    return [ACCOUNT, DAY if spec.partition_column else BUCKET_COLUMN]


def partition_schema(spec: TableSpec) -> T.StructType:
    """The table's columns, then its partition columns."""
    schema = T.StructType(spec.spark_schema().fields)
    return schema.add(ACCOUNT, T.StringType()).add(*((DAY, T.StringType()) if spec.partition_column else (BUCKET_COLUMN, T.IntegerType())))


def with_partitions(df: DataFrame, spec: TableSpec, *, buckets: int = ENTITY_BUCKETS) -> DataFrame:
    """``df`` with the partition columns: its own ``account_id`` (if it has one), and the day of the
    partition column whatever the hour, or the bucket of the merge columns."""
    account = F.trim(F.col(ACCOUNT).cast("string")) if ACCOUNT in df.columns else F.lit(None).cast("string")
    if spec.partition_column:
        other = F.coalesce(F.to_date(_q(spec.partition_column)).cast("string"), F.lit(NO_DAY))
    else:
        other = F.pmod(F.xxhash64(*[F.col(_q(k)) for k in spec.merge_columns]), F.lit(buckets)).cast("int")
    return df.withColumns({ACCOUNT: F.coalesce(F.when(account != "", account), F.lit(NO_ACCOUNT)), partition_columns(spec)[1]: other})


def create_table_from_spec(spark: SparkSession, spec: TableSpec, *, location: str | None = None,
                           drop: bool = False, database: str | None = None, buckets: int = ENTITY_BUCKETS) -> str:
    """L-08: database and table from the spec, Parquet, partitioned by account and by day (reports)
    or key bucket (entities). The bucket count is a property of the table.

    Indexes have no Spark form (file statistics and sorted files serve); uniqueness of merge keys is
    checked by ``assert_unique_key`` at load time; no surrogate id.
    """
    db = database or spec.dataset
    name = f"`{db}`.`{spec.table_name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    if drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in partition_schema(spec))
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY ({', '.join(_q(p) for p in partition_columns(spec))})"
    if location:
        ddl += f" LOCATION '{location}'"
    if not spec.partition_column:
        ddl += f" TBLPROPERTIES ('buckets' = '{int(buckets)}')"
    spark.sql(ddl)
    return f"{db}.{spec.table_name}"


def publish_partitions(df: DataFrame, table_root: str, partition_by, *, staging_root: str,
                       cluster_by=None, reads_target: bool = True, touched: DataFrame | None = None,
                       compression: str | None = None) -> None:
    """Partition-scoped publish for partitioned tables: only the partitions present in ``df`` are
    replaced (dynamic partition overwrite), the others are not touched.

    When ``df`` reads the table it replaces (``reads_target``), Spark refuses to overwrite a path it
    reads, so the new partitions are first materialised under ``staging_root`` (a shared folder,
    e.g. under ``spark.checkpoint.dir``); that also cuts the lineage before the overwrite. A first
    load (nothing to read) is written directly. The staged copy goes after the overwrite.

    ``touched`` (partition values the new content is for) makes partitions that have no rows left
    empty: dynamic overwrite alone would leave their old files. Rows are rebalanced by the partition
    columns, so that a partition is one file, or several where adaptive execution splits a large one.
    """
    spark, parts = df.sparkSession, _on(partition_by)
    out = df.hint("rebalance", *[F.col(_q(p)) for p in parts])
    if cluster_by:
        out = out.sortWithinPartitions(*[_q(c) for c in [*parts, *_on(cluster_by)]])
    emptied, stage_path = [], f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}"
    if reads_target:
        write_parquet(out, stage_path, by=parts, compression=compression)
        out = spark.read.schema(df.schema).parquet(stage_path)
        if touched is not None:
            # At most the partitions touched by this load, by folder name.
            gone = touched.select(*parts).dropna().distinct().join(out.select(*parts).distinct(), parts, "left_anti")
            emptied = ["/".join(f"{p}={v}" for p, v in zip(parts, r, strict=True)) for r in gone.collect()]
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(table_root, compression=compression)
    for folder in [f"{table_root.rstrip('/')}/{e}" for e in emptied] + [stage_path] * reads_target:
        fs, p, _ = _fs(spark, folder)
        fs.delete(p, True)
