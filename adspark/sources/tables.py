"""Table sources (I-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table_all_strings(spark: SparkSession, source) -> DataFrame:
    """I-05: a table with every column as text. ``source`` is a Parquet path, a table name
    (``db.table``) or a dict of JDBC options (``url``, ``dbtable``, ...). NULL stays NULL (D1)."""
    if isinstance(source, dict):
        df = spark.read.format("jdbc").options(**source).load()
    elif "/" in source or source.endswith(".parquet"):
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
