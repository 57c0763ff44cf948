"""Object-key metadata (I-08, I-09, I-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspark.functions.dates import date_token
from adspark.functions.text import url_key_decode


def source_path() -> Column:
    """The path of the file a row was read from, as it is named: Spark gives it URL-encoded."""
    encoded = F.col("_metadata.file_path")
    return F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)


def path_metadata(df: DataFrame, path: Column | None = None, *, kind: str = "report") -> DataFrame:
    """I-08 / I-09: metadata from the object key, counted from the end so a bucket or folder
    prefix does not matter.

    report: ``.../<ad_type>/<report_type[__opt_opt]>/<country>/<client>/<profile>/<start-end>/<file>``
    entity: ``.../<ad_type>/<entity_type>/<country>/<client>/<profile>/<file>``
    Folders written as ``name=value`` contribute their value. Adds ``_ad_type _report_type _report_options _country _client_id _profile_id`` and, for reports,
    ``_start_date _end_date`` (ISO dates).
    """
    path = F.col("_file") if path is None else path
    parts = F.split(path, "/")

    def seg(i: int) -> Column:
        # Hive-style folders (``name=value``) carry the value after the first ``=``.
        return F.regexp_replace(F.try_element_at(parts, F.lit(i)), r"^[^=/]*=", "")

    if kind == "report":
        typ = seg(-6)
        dates = F.split(seg(-2), "-")
        cols = {
            "_ad_type": seg(-7),
            "_report_type": F.split(typ, "__").getItem(0),
            "_report_options": F.when(typ.contains("__"), F.split(F.split(typ, "__").getItem(1), "_"))
            .otherwise(F.array().cast("array<string>")),
            "_country": seg(-5), "_client_id": seg(-4), "_profile_id": seg(-3),
            "_start_date": date_token(F.try_element_at(dates, F.lit(1))),
            "_end_date": date_token(F.try_element_at(dates, F.lit(2))),
        }
    elif kind == "entity":
        cols = {"_ad_type": seg(-6), "_report_type": seg(-5), "_report_options": F.array().cast("array<string>"),
                "_country": seg(-4), "_client_id": seg(-3), "_profile_id": seg(-2)}
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return df.withColumns(cols)


def object_key_decode(events: DataFrame, *, key: str = "key") -> DataFrame:
    """I-12: URL-decode object keys of storage events (``+`` becomes a blank)."""
    return events.withColumn(key, url_key_decode(F.col(key)))
