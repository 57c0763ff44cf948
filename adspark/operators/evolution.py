"""Schema evolution of catalog tables (L-06, L-11, D9): the stored schema is compared with the
expected one and the difference is acted on. No column and no row is ever dropped.

``add``      the table lacks the column: ``ALTER TABLE ADD COLUMNS``; files stay, old rows read NULL.
``widen``    stored files can be read as the wider type: the table's schema changes, files stay.
``rewrite``  any other type: files that hold the column in another type are written anew, partition by
             partition, and the partitions switched to them; files that lack the column, or have
             the expected type already, stay.
``keep``     same type, or a stored column that the expected schema does not name.

The schema changes after the last partition has been switched, so an evolution that failed half-way
goes on where it stopped when called again. Until its end, reading a column that is being rewritten
fails on the partitions that are switched already; other columns and partitions can be read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.operators.catalog_tables import _quoted, publish_partitions_to_catalog, table_location, table_partitions
from adspark.operators.load import _fs, _q

# Types that Spark reads from Parquet files of a narrower type.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}
#: Partitions that one job rewrites: it bounds the partition filter and the work that a failure repeats.
PARTITIONS_A_JOB = 200


@dataclass(frozen=True)
class Change:
    column: str
    stored: str | None
    expected: str | None
    action: str


def schema_changes(stored: T.StructType, expected: T.StructType) -> list[Change]:
    """One entry per column of either schema, in the order of the table after the change. Names are
    compared without case, as the catalog does."""
    wanted = {f.name.lower(): f for f in expected}
    out = []
    for f in stored:
        old, e = f.dataType.simpleString(), wanted.pop(f.name.lower(), None)
        new = e.dataType.simpleString() if e else None
        action = "keep" if new in (None, old) else "widen" if new in _WIDER.get(old, ()) else "rewrite"
        out.append(Change(f.name, old, new, action))
    return out + [Change(f.name, None, f.dataType.simpleString(), "add") for f in wanted.values()]


def _converted(c: str, old: T.DataType, new: T.DataType, on_bad: str) -> Column:
    """The column in its new type. A value that cannot be converted, or a number that would not come
    back as it was, becomes NULL or raises."""
    value = F.col(_q(c))
    out = value.try_cast(new)
    bad = out.isNull()
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        bad = bad | ~out.try_cast(old).eqNullSafe(value)
    fail = F.raise_error(F.concat(F.lit(f"{c} holds a value that is no {new.simpleString()}: "), value.cast("string"))).cast(new)
    return F.when(value.isNotNull() & bad, fail if on_bad == "raise" else F.lit(None).cast(new)).otherwise(out).alias(c)


def _rewrite_partitions(spark: SparkSession, table: str, parts: list[str], changes: list[Change], types: dict[str, T.DataType], on_bad: str) -> int:
    """Write anew the partitions whose files hold a column of ``changes`` in another type."""
    where = table_partitions(spark, table)
    stale = []
    for values, location in where:  # one footer of each partition is read
        fs, path, _ = _fs(spark, location)
        if not fs.exists(path) or not any(s.getLen() for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet")):
            continue
        held = {f.name.lower(): f.dataType for f in spark.read.parquet(location).schema}
        if any(held.get(c.column.lower(), types[c.column]) != types[c.column] for c in changes):
            stale.append(values)
    rows = spark.table(table)
    old = {f.name: f.dataType for f in rows.schema}
    new = [_converted(c, old[c], types[c], on_bad) if c in types else F.col(_q(c)) for c in rows.columns]
    for a in range(0, len(stale), PARTITIONS_A_JOB):
        block = stale[a:a + PARTITIONS_A_JOB]
        cond = F.lit(False)
        for values in block:
            one = F.lit(True)
            for p, v in zip(parts, values, strict=True):
                one = one & (F.col(_q(p)) == F.lit(v).cast(old[p]))
            cond = cond | one
        publish_partitions_to_catalog(rows.where(cond).select(*new), table, parts, block)
    return len(stale)


def _rewrite_whole(spark: SparkSession, table: str, types: dict[str, T.DataType], on_bad: str) -> str:
    """Rows of a table without partitions, written once in their new types; returns their folder."""
    from adspark.operators.catalog_tables import _new_load
    rows = spark.table(table)
    path = _new_load(table_location(spark, table).split("/load=")[0])
    rows.select(*[_converted(f.name, f.dataType, types[f.name], on_bad) if f.name in types else F.col(_q(f.name)) for f in rows.schema]).write.parquet(path)
    return path


def evolve_table(spark: SparkSession, table: str, expected: T.StructType, *, rewrite: bool = False, on_bad: str = "raise") -> list[Change]:
    """L-06 / L-11: give the Parquet table ``table`` (``database.name``) of the catalog the columns
    and types of ``expected`` and return what was done for each column. Columns are added and
    widened always; files are written anew only with ``rewrite``, else a column that needs it is an
    error and nothing has changed. ``on_bad``: ``raise`` (nothing of the block of partitions at hand
    has changed then) or ``null`` for values that cannot be converted. A partition column of another
    type is an error: its values are folder names."""
    if on_bad not in ("raise", "null"):
        raise ValueError(f"on_bad is raise or null, not {on_bad!r}")
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(_quoted(table))
    names = state.catalog().getTableMetadata(ident).partitionColumnNames()
    parts = [names.apply(i) for i in range(names.size())]
    schema = spark.table(table).schema
    keyed = {p.lower(): schema[p].dataType for p in parts}
    for f in expected:
        if keyed.get(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{table} is partitioned by {f.name}, whose type cannot change")
    data = T.StructType([f for f in schema if f.name.lower() not in keyed])
    changes = schema_changes(data, T.StructType([f for f in expected if f.name.lower() not in keyed]))
    redo = [c for c in changes if c.action == "rewrite"]
    if redo and not rewrite:
        raise ValueError(f"{table} must be rewritten for " + ", ".join(f"{c.column} ({c.stored} to {c.expected})" for c in redo))
    wanted = {f.name.lower(): f.dataType for f in expected}
    added = [f"{_q(c.column)} {c.expected}" for c in changes if c.action == "add"]
    if added:
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD COLUMNS ({', '.join(added)})")
    types = {c.column: wanted[c.column.lower()] for c in redo}
    whole = None
    if redo and parts:
        _rewrite_partitions(spark, table, parts, redo, types, on_bad)
    elif redo:
        whole = _rewrite_whole(spark, table, types, on_bad)
    if redo or any(c.action == "widen" for c in changes):
        moved = T.StructType([T.StructField(c.column, wanted[c.column.lower()] if c.action != "keep" else data[c.column].dataType) for c in changes])
        state.catalog().alterTableDataSchema(ident, spark._jvm.org.apache.spark.sql.types.DataType.fromJson(moved.json()))
    if whole:
        spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{whole}'")
    spark.catalog.refreshTable(table)
    return changes


def changes_frame(spark: SparkSession, changes: list[Change]) -> DataFrame:
    """What ``evolve_table`` did, as rows."""
    return spark.createDataFrame([(c.column, c.stored, c.expected, c.action) for c in changes], "column string, stored string, expected string, action string")
