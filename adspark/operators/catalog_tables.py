"""Tables of Spark's catalog as load targets (L-07, L-08).

A load writes its new content once, into a folder of its own below the table (``load=<id>``), and
then points the table, or each touched partition, at it (``ALTER TABLE ... SET LOCATION``). A reader
sees a partition before or after the switch, never half of it; a load that fails before the switch
has changed nothing, and one that is repeated after a partial switch ends in the same content. What
no partition points at any more is removed by ``remove_unused_loads``.

The catalog must outlive the session (a shared metastore) for tables to be found by later sessions;
Spark's in-memory catalog keeps them for one session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.operators.load import _fs, _on, _q


def _text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(table: str) -> str:
    return ".".join(_q(p) for p in table.split("."))


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0].rstrip("/")


def _new_load(root: str) -> str:
    return f"{root.rstrip('/')}/load={uuid.uuid4().hex}"


def stage_then_publish(df: DataFrame, table: str, root: str, *, batch_id: str | None = None) -> None:
    """L-07: write ``df`` to a new folder below ``root``, then make it the content of the catalog
    table ``table`` (created on first use) in one change of its location. ``batch_id`` is kept as the
    table property ``batch`` so that a re-delivered batch can be recognised (T-02)."""
    spark, path = df.sparkSession, _new_load(root)
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION {_text(path)}")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {_quoted(table)} ({columns}) USING parquet LOCATION {_text(path)}")
    if batch_id is not None:
        spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ('batch' = {_text(batch_id)})")


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").where(F.col("key") == key).select("value").collect()
    return rows[0][0] if rows else None


def publish_partitions_to_catalog(df: DataFrame, table: str, partition_by, touched: list[tuple], *, cluster_by=None) -> None:
    """Replace the partitions ``touched`` (tuples of values of ``partition_by``, never null) of a
    catalog table by ``df``, which holds rows of these partitions only and may read the table. Rows
    are written once, rebalanced by partition, where adaptive execution splits a large partition
    over several tasks; a touched partition without rows becomes empty. One
    statement for all new partitions, one for each that is there."""
    if not touched:
        return
    spark, parts = df.sparkSession, _on(partition_by)
    path = _new_load(table_location(spark, table))
    out = df.hint("rebalance", *[F.col(_q(p)) for p in parts])
    out.sortWithinPartitions(*[_q(c) for c in [*parts, *_on(cluster_by or [])]]).write.partitionBy(*parts).parquet(path)
    fs, _, jvm = _fs(spark, path)
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name, places = _quoted(table), {}
    for values in touched:
        folder = "/".join(f"{p}={escape(str(v))}" for p, v in zip(parts, values, strict=True))
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"))  # for partitions that have become empty
        places[folder] = ", ".join(f"{_q(p)}={_text(v)}" for p, v in zip(parts, values, strict=True))
    known: set[str] = set()
    for first in {v[0] for v in touched}:  # the partitions of the touched accounts only
        known |= {r[0] for r in spark.sql(f"SHOW PARTITIONS {name} PARTITION ({_q(parts[0])}={_text(first)})").collect()}
    new = [f"PARTITION ({p}) LOCATION {_text(f'{path}/{f}')}" for f, p in places.items() if f not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
    for f, p in places.items():
        if f in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({p}) SET LOCATION {_text(f'{path}/{f}')}")
    spark.catalog.refreshTable(table)


def table_partitions(spark: SparkSession, table: str) -> list[tuple[tuple[str, ...], str]]:
    """(partition values, folder) of each partition of a catalog table."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(_quoted(table))
    names = state.catalog().getTableMetadata(ident).partitionColumnNames()
    parts, out = state.catalog().listPartitions(ident, spark._jvm.scala.Option.empty()).iterator(), []
    while parts.hasNext():
        p = parts.next()
        out.append((tuple(p.spec().apply(names.apply(i)) for i in range(names.size())), spark._jvm.org.apache.hadoop.fs.Path(p.location()).toString()))
    return out


def used_locations(spark: SparkSession, table: str) -> list[str]:
    """The folder of each partition, or of the table if it has none."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(_quoted(table))
    if state.catalog().getTableMetadata(ident).partitionColumnNames().isEmpty():
        return [table_location(spark, table)]
    return [location for _, location in table_partitions(spark, table)]


def remove_unused_loads(spark: SparkSession, table: str, *, root: str | None = None, older_than_hours: float = 24) -> int:
    """Delete the ``load=`` folders below ``root`` (the table's location) that no partition points
    at and that were last changed ``older_than_hours`` ago or earlier, so that readers which planned
    on them have ended. Returns their number."""
    fs, p, jvm = _fs(spark, root or table_location(spark, table))
    used = {x.split("/load=")[1].split("/")[0] for x in used_locations(spark, table) if "/load=" in x}
    limit, gone = jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000, 0
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("load=") and name[5:] not in used and s.getModificationTime() <= limit:
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
