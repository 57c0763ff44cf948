"""Run table of the catalog sync: one row per (batch, seller) with its state.

``started`` makes the rows from the eligible and the incomplete sellers, ``planned`` and ``finished``
move them on. States: ``incomplete`` (a token or the partner id is missing; never run), ``running``,
``error`` (quarantined, or an unreadable result document), ``no_data`` (nothing offered and nothing to
delete), ``completed`` and ``completed_with_errors``. Only ``running`` rows move, so a step repeated
changes nothing. All joins are on the seller, one row each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("seller_id", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("ended_at", T.TimestampType()),
])


def started(complete: DataFrame, incomplete: DataFrame, *, batch_id: str, now: Column, user_id: str = "id") -> DataFrame:
    """Rows of a run from the two results of ``eligible_sellers``. A user with a complete row is
    eligible whatever other rows it has; for the others ``error`` names what is missing."""
    ok = complete.select(F.col(user_id).cast("string").alias("seller_id")).distinct()
    flags = [c for c in incomplete.columns if c.startswith("has_")]
    missing = [F.when(~F.coalesce(F.max(c), F.lit(False)), F.lit(c.removeprefix("has_"))) for c in flags]
    partner = F.max(F.trim(F.coalesce(F.col("selling_partner_id").cast("string"), F.lit(""))))
    missing.append(F.when(partner == "", F.lit("selling_partner_id")))
    lacking = incomplete.groupBy(F.col(user_id).cast("string").alias("seller_id")).agg(
        F.concat(F.lit("missing: "), F.concat_ws(", ", *missing)).alias("error")).join(ok, "seller_id", "left_anti")
    rows = ok.select("seller_id", F.lit("running").alias("status"), F.lit(None).cast("string").alias("error")).unionByName(
        lacking.select("seller_id", F.lit("incomplete").alias("status"), "error"))
    return rows.select(F.lit(batch_id).alias("batch_id"), "seller_id", "status", "error", now.alias("started_at"),
                       F.when(F.col("status") == "incomplete", now).alias("ended_at"))


def _move(rows: DataFrame, status: Column, error: Column, now: Column) -> DataFrame:
    running = F.col("status") == "running"
    out = rows.withColumn("_status", F.when(running, status).otherwise(F.col("status")))
    return out.select("batch_id", "seller_id", F.col("_status").alias("status"),
                      F.when(running, error).otherwise(F.col("error")).alias("error"), "started_at",
                      F.when(running & (F.col("_status") != "running"), now).otherwise(F.col("ended_at")).alias("ended_at"))


def _flag(rows: DataFrame, sellers: DataFrame, name: str) -> DataFrame:
    return rows.join(sellers.select(F.col("seller_id").cast("string").alias("seller_id")).distinct().withColumn(name, F.lit(True)),
                     "seller_id", "left")


def planned(rows: DataFrame, offered: DataFrame, staged: DataFrame, errors: DataFrame, *, now: Column) -> DataFrame:
    """After planning: ``errors(seller_id, error)`` ends a seller with ``error``; a seller without
    offered products and staged rows ends with ``no_data``, one whose products are all unchanged is
    ``completed``; the others wait for their results."""
    why = errors.groupBy(F.col("seller_id").cast("string").alias("seller_id")).agg(
        F.concat_ws("; ", F.sort_array(F.collect_set("error"))).alias("_why"))  # a text per kind of check
    j = _flag(_flag(rows, offered, "_offered"), staged, "_staged").join(why, "seller_id", "left")
    status = F.when(F.col("_why").isNotNull(), "error").when(F.col("_staged"), "running") \
        .when(F.col("_offered"), "completed").otherwise("no_data")
    return _move(j, status, F.col("_why"), now)


def finished(rows: DataFrame, totals: DataFrame, unreadable: DataFrame, *, now: Column) -> DataFrame:
    """After the results: a seller with an unreadable result document ends with ``error``, one with
    totals (``feed_summary``) with their status; without a result it stays ``running``."""
    j = _flag(rows, unreadable, "_bad").join(
        totals.select(F.col("seller_id").cast("string").alias("seller_id"), F.col("status").alias("_total")), "seller_id", "left")
    status = F.when(F.col("_bad"), "error").otherwise(F.coalesce("_total", F.lit("running")))
    return _move(j, status, F.when(F.col("_bad"), "unexpected result structure"), now)
