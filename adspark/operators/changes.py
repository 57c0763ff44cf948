"""Change detection, staging and message numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspark.functions.numbers import round_money
from adspark.functions.text import try_cast
from adspark.session import kept_table


def _q(c: str):
    return F.col(f"`{c}`")


def _q_name(c: str) -> str:
    return f"`{c}`"


def _on(on):
    return [on] if isinstance(on, str) else list(on)


def row_hash(df: DataFrame, cols=None, *, out: str = "product_hash") -> DataFrame:
    """K-18: SHA-256 hex of the columns joined by ``|``, each as text with NULL as ``''``.

    ``cols`` defaults to all columns in sorted name order (D11), a fixed list independent of the
    order in which enrichment added them."""
    cols = sorted(c for c in df.columns if c != out) if cols is None else list(cols)
    text = F.concat_ws("|", *[F.coalesce(_q(c).cast("string"), F.lit("")) for c in cols])
    return df.withColumn(out, F.sha2(text, 256))


def annotate_changes(products: DataFrame, history: DataFrame, on, *, now: Column, sku: str = "sku",
                     max_age_days: int = 10, keep_share: float = 0.03, seed: str = "",
                     hash_col: str = "product_hash", status: str = "status",
                     ended_at: str = "ended_at", carry=()) -> DataFrame:
    """K-17 with every product kept: adds ``reason`` (``new``, ``not_processed``, ``hash_changed``,
    ``stale``, ``sampled`` or ``unchanged``) and ``is_changed`` (no history or another hash).

    The random re-send of the reference becomes a seeded hash of the SKU and ``seed`` (D10):
    ``pmod(xxhash64(sku, seed), 10000) < keep_share * 10000``. ``carry`` names columns of the history
    that the result keeps.
    """
    on = _on(on)
    h = history.select(*[_q(c) for c in on], _q(status).alias("_h_status"), _q(hash_col).alias("_h_hash"),
                       _q(ended_at).alias("_h_ended"), F.lit(True).alias("_h_present"), *[_q(c) for c in carry])
    j = products.join(h, on, "left")
    threshold = int(round(keep_share * 10000))
    sampled = F.pmod(F.xxhash64(_q(sku).cast("string"), F.lit(seed)), F.lit(10000)) < threshold
    age_limit = now - F.make_interval(days=F.lit(max_age_days))
    reason = (F.when(_q("_h_present").isNull(), F.lit("new"))
              .when(~_q("_h_status").eqNullSafe("processed"), F.lit("not_processed"))
              .when(~_q("_h_hash").eqNullSafe(_q(hash_col)), F.lit("hash_changed"))
              .when(_q("_h_ended").isNull() | (_q("_h_ended") <= age_limit), F.lit("stale"))
              .when(sampled, F.lit("sampled"))
              .otherwise(F.lit("unchanged")))
    changed = _q("_h_present").isNull() | ~_q("_h_hash").eqNullSafe(_q(hash_col))
    return j.withColumns({"reason": reason, "is_changed": changed}) \
        .drop("_h_status", "_h_hash", "_h_ended", "_h_present")


def changed_rows(products: DataFrame, history: DataFrame, on, **kw) -> DataFrame:
    """K-17: the products to send (every reason but ``unchanged``)."""
    return annotate_changes(products, history, on, **kw).filter(F.col("reason") != "unchanged")


# History column layout of staged changes.
HISTORY_COLUMNS = ("sku", "batch_id", "seller_id", "asin", "title", "price", "status", "started_at",
                   "ended_at", "error_description", "product_hash")


def stage_changes(updates: DataFrame, deletes: DataFrame, *, batch_id: str, now: Column,
                  seller: str = "seller_id", sku: str = "sku", asin: str = "asin", title: str = "title",
                  price: str = "price_to_push", hash_col: str = "product_hash") -> DataFrame:
    """K-20: UPDATE rows (price rounded to 2, status ``processing``) plus DELETE rows (NULL fields,
    status ``pending_delete``), each with the batch id and start time, and a ``kind`` column."""
    u = updates.select(
        _q(sku).cast("string").alias("sku"), F.lit(batch_id).alias("batch_id"), _q(seller).cast("string").alias("seller_id"),
        _q(asin).cast("string").alias("asin"), _q(title).cast("string").alias("title"),
        round_money(try_cast(_q(price).cast("string"), "double")).alias("price"),
        F.lit("processing").alias("status"), now.alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"), F.lit(None).cast("string").alias("error_description"),
        _q(hash_col).cast("string").alias("product_hash"), F.lit("UPDATE").alias("kind"))
    d = deletes.select(
        _q(sku).cast("string").alias("sku"), F.lit(batch_id).alias("batch_id"), _q(seller).cast("string").alias("seller_id"),
        F.lit(None).cast("string").alias("asin"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("double").alias("price"), F.lit("pending_delete").alias("status"), now.alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"), F.lit(None).cast("string").alias("error_description"),
        F.lit(None).cast("string").alias("product_hash"), F.lit("DELETE").alias("kind"))
    return u.unionByName(d)


def message_ids(changes: DataFrame, *, by=("seller_id",), order=("kind_rank", "sku"), out: str = "message_id",
                num_partitions: int | None = None) -> DataFrame:
    """K-22: dense ids 1..n per ``by`` group in ``order`` (updates before deletes, then SKU).

    A single seller may hold a third of all rows, so the ids are not computed by one window over
    the seller. Instead: range-partition by (group, order) so a big group spreads over many
    partitions, take the in-partition position from ``monotonically_increasing_id`` (the rows are
    sorted inside each partition), count rows per (partition, group) and turn those counts into
    offsets with a window over the small per-partition summary. The summary has at most one row
    per (partition, group), so its window is tiny even for the largest group.
    ``order`` may name ``kind_rank``: 0 for UPDATE rows and 1 for DELETE rows of a ``kind`` column.
    The order columns must make rows unique within a group (SKUs unique per seller).
    """
    by, order = list(by), list(order)
    df = changes
    if "kind_rank" in order and "kind_rank" not in df.columns:
        df = df.withColumn("kind_rank", F.when(F.col("kind") == "DELETE", F.lit(1)).otherwise(F.lit(0)))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [_q(c) for c in by + order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys) \
        .withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    # Positions depend on the physical partitioning, and the frame is read twice below (summary and
    # join): keep it once as a table in the shared checkpoint folder so both reads see the same rows
    # (adaptive execution could otherwise coalesce the two reads differently); this also cuts the
    # lineage, so a lost executor reads the table again.
    ranged = kept_table(ranged, "ids")
    summary = ranged.groupBy("_pid", *[_q(c) for c in by]).agg(
        F.min("_mono").alias("_base"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*[_q(c) for c in by]).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    # Null-safe on the group columns, so a NULL group still gets its ids.
    offsets = offsets.select(F.col("_pid").alias("_o_pid"), *[F.col(_q_name(c)).alias(f"_o_{i}") for i, c in enumerate(by)],
                             "_base", "_off")
    # A table of known size: the rows are not dealt again where Spark can broadcast it.
    offsets = kept_table(offsets, "ids")
    cond = F.col("_pid") == F.col("_o_pid")
    for i, c in enumerate(by):
        cond = cond & F.col(_q_name(c)).eqNullSafe(F.col(f"_o_{i}"))
    out_df = ranged.join(offsets, cond, "inner") \
        .withColumn(out, (F.col("_mono") - F.col("_base") + F.col("_off") + 1).cast("bigint"))
    return out_df.drop("_pid", "_mono", "_base", "_off", "_o_pid", *[f"_o_{i}" for i in range(len(by))])
