"""Date expansion (F-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range_list(df: DataFrame, start: str, end: str, *, out: str = "day", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """F-01: one row per date from ``start`` to ``end`` inclusive, formatted (no row when end < start)."""
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    days = F.when(e >= s, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))
    return df.withColumn(out, F.explode(days)).withColumn(out, F.date_format(F.col(out), fmt))
