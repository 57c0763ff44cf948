"""Catalog of configured tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.specs import SPARK_TYPES, load_specs

_CATALOG_SCHEMA = ("table_type string, ad_type string, name string, dataset string, table_name string, "
                   "load_method string, partition_column string, column string, position int, "
                   "config_type string, spark_type string, is_key boolean, is_cluster boolean")


def table_catalog(spark: SparkSession) -> DataFrame:
    """C-01: one row per configured column of every table."""
    rows = []
    for s in load_specs():
        for i, (c, t) in enumerate(s.columns, start=1):
            rows.append((s.table_type, s.ad_type, s.name, s.dataset, s.table_name, s.load_method,
                         s.partition_column, c, i, t, SPARK_TYPES[t].simpleString() if t in SPARK_TYPES else "string",
                         c in s.merge_columns, c in s.cluster_columns))
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def select_tables(catalog: DataFrame, *, types=(), ad_types=(), names=()) -> DataFrame:
    """C-02: filter by table types / ad types / names; an empty list means all and blank entries
    are ignored. Each table type uses its own ad-type filter."""
    out = catalog
    for col, values in (("table_type", types), ("ad_type", ad_types), ("name", names)):
        values = [v for v in values if v and str(v).strip()]
        if values:
            out = out.filter(F.col(col).isin(values))
    return out
