"""Catalog sync as two Spark jobs for all sellers at once.

``plan_feed``: products -> identifiers, overrides, brand rules, filters, enrichment, pricing, hash
(``price_products``) -> change detection against history -> staged history rows, UPDATE / DELETE
messages with ids and chunks, feed documents.
``apply_feed``: feed result documents -> per-message outcome -> history and batch rows.

``seller_id`` is part of every key, so one plan serves every seller; a seller holding a large share
of the rows is spread by the sku part of the keys (joins) and by range partitioning (message ids).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspark.functions.numbers import explicit_price_override, override_map_floor

from adspark.operators import changes as K
from adspark.operators import feed as FD
from adspark.operators import joins as J
from adspark.operators import load as L
from adspark.operators import normalize as N
from adspark.operators import pricing as P
from adspark.operators import runs as RN
from adspark.operators.aggregates import feed_result_by_message, feed_summary
from adspark.operators.pricing import PC, ProductColumns
from adspark.session import ensure_checkpoint_dir, kept_table, session_conf, shuffles_released


def price_products(products: DataFrame, identifiers: DataFrame, overrides: DataFrame | None,
                   rules: DataFrame | None, master: DataFrame | None, *, cols: ProductColumns = PC,
                   seller: str = "seller_id", seq: str = "seq", hash_cols=None, check_rules: bool = True):
    """The product chain in the reference's order: J-01, K-10, K-11, K-12, N-16, N-17, J-02,
    K-13, K-14, K-15, K-16, K-19, K-18. Returns ``(priced, rejected, current)``: ``current`` holds the
    keys of the offered products (after the filters, priced or not)."""
    df = offered_products(products, identifiers, overrides, rules, master, cols=cols, seller=seller, seq=seq, check_rules=check_rules)
    priced, rejected = P.price_reject(df, cols)
    return K.row_hash(priced, _hash_columns(priced) if hash_cols is None else hash_cols), rejected, df.select(_q(seller), _q(cols.sku))


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _hash_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c != "product_hash")


def offered_products(products: DataFrame, identifiers: DataFrame, overrides: DataFrame | None,
                     rules: DataFrame | None, master: DataFrame | None, *, cols: ProductColumns = PC,
                     seller: str = "seller_id", seq: str = "seq", check_rules: bool = True) -> DataFrame:
    """``price_products`` up to K-16: every product that the filters leave, with its price or NULL.

    The override table is reduced once per (seller, SKU) (``reduce_overrides``) and joined once;
    its reduced values serve the cell overrides (K-11), the override MAP floor (K-15) and the
    explicit price (K-16)."""
    # Joined and sorted by the SKU first: it tells rows apart early, a seller has many.
    keys = [cols.sku, seller]
    df = N.null_tokens(products)
    df = J.join_identifiers(df, N.null_tokens(identifiers), cols.sku)
    df = P.mpn_block(df, cols)
    ov_cols = []
    if overrides is not None:
        cell = [c for c in overrides.columns if c in df.columns and c not in keys and c not in (seq, cols.price)]
        ov_cols = [f"_ov_{c}" for c in cell]
        numeric = [cols.price] if cols.price in overrides.columns else []
        if cols.map_price in overrides.columns and cols.map_price not in cell:
            cell_map = [cols.map_price]
        else:
            cell_map = []
        # Kept, so that its exchange has ended when the products' wide ones begin.
        red = kept_table(P.reduce_overrides(overrides, keys, seq=seq, cols=cell + cell_map, numeric=numeric), "overrides")
        df = df.join(red, keys, "left")
        df = df.withColumns({c: F.coalesce(F.col(f"`_ov_{c}`"), F.col(f"`{c}`").cast("string")) for c in cell})
        ov_cols = [c for c in red.columns if c.startswith("_ov")]
    if rules is not None:
        df = P.brand_rules(df, rules, cols, check_unique=check_rules, on=[seller] if seller in rules.columns else [])
    df = N.filter_identifier(df, cols.asin)
    df = N.filter_push_flag(df, cols.push_marketplace)
    if master is not None:
        df = J.join_new_columns(df, master, cols.sku)
    df = P.numeric_fields(df, cols)
    df = P.apply_target_price(df, cols)
    df = P.apply_map_floor(df, cols)
    if overrides is not None:
        price = F.col(f"`{cols.price}`")
        price = override_map_floor(price, F.col(f"`_ov_{cols.map_price}`")) if f"_ov_{cols.map_price}" in ov_cols else price
        if f"_ovnum_{cols.price}" in ov_cols:
            price = explicit_price_override(price, F.col(f"`_ovnum_{cols.price}`"))
        df = df.withColumn(cols.price, price).drop(*ov_cols)
    return df


@dataclass
class FeedPlan:
    priced: DataFrame
    rejected: DataFrame
    annotated: DataFrame
    staged: DataFrame
    messages: DataFrame
    message_rejects: DataFrame
    documents: DataFrame
    price_updates: DataFrame
    current: DataFrame
    duplicates: DataFrame
    errors: DataFrame | None = None


def _annotated_rows(offered: DataFrame, history: DataFrame, keys: list[str], *, cols: ProductColumns, now: Column,
                    keep_share: float, seed: str) -> DataFrame:
    """Every offered row with its hash (K-18) and change (K-17); ``_has_price`` (K-19); ``_n_key``, the number
    of priced rows of its key; ``_h_nth``, which of the key's history rows it is joined with. All steps
    share one exchange and one order by (SKU, seller)."""
    by = [_q(k) for k in reversed(keys)]
    counted = offered.withColumn("_has_price", P.as_double(offered, cols.price).isNotNull())
    counted = counted.withColumn("_n_key", F.count_if("_has_price").over(Window.partitionBy(*by)))
    hashed = K.row_hash(counted, _hash_columns(offered))
    known = F.lit(True)
    for k in by:
        known = known & k.isNotNull()
    hist = history.filter(known).select(*by, "status", "product_hash", "ended_at")
    hist = hist.withColumns({"_h_nth": F.row_number().over(Window.partitionBy(*by).orderBy("status", "product_hash", "ended_at")),
                             "_h_rows": F.count(F.lit(1)).over(Window.partitionBy(*by))})
    rows = K.annotate_changes(hashed, hist, list(reversed(keys)), now=now, sku=cols.sku, keep_share=keep_share, seed=seed,
                              carry=("_h_nth", "_h_rows"))
    return rows.withColumns({"_n_key": F.col("_n_key") * F.coalesce("_h_rows", F.lit(1)),
                             "_h_nth": F.coalesce("_h_nth", F.lit(1))}).drop("_h_rows")


def _single_rows(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(annotated, duplicates)`` of the priced ``rows``, exact duplicates once: keys with one row, and with
    several. Only keys that come more than once are dealt and compared."""
    priced = rows.filter("_has_price").drop("_has_price")
    several = kept_table(priced.filter("_n_key > 1").drop("_n_key"))
    same_key = Window.partitionBy(*[_q(k) for k in keys])
    several = several.repartition(*[_q(k) for k in keys]).dropDuplicates().drop("_h_nth") \
        .withColumn("_n_key", F.count(F.lit(1)).over(same_key))
    single = priced.filter("_n_key = 1").drop("_n_key", "_h_nth")
    duplicates = several.filter("_n_key > 1").drop("_n_key").withColumn("reject_reason", F.lit("duplicate_sku"))
    return single.unionByName(several.filter("_n_key = 1").drop("_n_key")), duplicates


#: The planner accepts rows that are dealt by a part of a join's keys.
DEALT_BY_SKU = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: Rows of a SKU that one task may hold.
ROWS_PER_SKU = 1_000_000


def _dealing(products: DataFrame, sku: str) -> dict[str, str]:
    """Settings for the product chain. Rows that the identifiers' join has dealt by SKU stay so for overrides,
    history and the count of a key's rows: these come to them, and what a SKU's rows share lies together. If
    a SKU has more rows than a task may hold, they are dealt by SKU and seller once more."""
    with shuffles_released(products.sparkSession):
        most = products.filter(_q(sku).isNotNull()).groupBy(_q(sku)).count().agg(F.max("count")).first()[0]
    return DEALT_BY_SKU if (most or 0) <= ROWS_PER_SKU else {}


def plan_feed(products: DataFrame, identifiers: DataFrame, overrides: DataFrame | None, rules: DataFrame | None,
              master: DataFrame | None, history: DataFrame, live: DataFrame, *, batch_id: str, now: Column,
              seed: str, cols: ProductColumns = PC, seller: str = "seller_id", keep_share: float = 0.03,
              max_delete_share: float = 0.5, force_deletes: bool = False, chunk_size: int = FD.CHUNK_SIZE,
              seller_label: str | None = None, quarantine: bool = False) -> FeedPlan:
    """Everything up to the feed upload (the external boundary). A SKU with several different priced
    rows (e.g. two identifier rows) is not sent: its rows come back as ``duplicates``.

    With ``quarantine`` a seller whose own rules are ambiguous or whose deletes pass the guard is left
    out of everything and comes back in ``errors(seller, error)``; all others are planned. Without it
    the first such seller ends the job."""
    keys = [seller, cols.sku]
    ensure_checkpoint_dir(products.sparkSession)
    errors = None
    own_rules = quarantine and rules is not None and seller in rules.columns
    if own_rules:
        errors = kept_table(P.rule_errors(rules, seller), "errors")
        products, live, rules = (df.join(errors.select(_q(seller)), seller, "left_anti") for df in (products, live, rules))
    # The product chain runs once: priced and rejected rows, the offered keys, the staged rows, the
    # message ids, the update messages, the price updates and the change statistics read what is kept.
    offered = offered_products(products, identifiers, overrides, rules, master, cols=cols, seller=seller, check_rules=not own_rules)
    # The hash is as long as the rest of a row; who needs it works it out again from the columns kept.
    checked = _annotated_rows(offered, history, keys, cols=cols, now=now, keep_share=keep_share, seed=seed)
    with session_conf(products.sparkSession, _dealing(products, cols.sku)):
        rows = kept_table(checked.drop("product_hash"))
    rows = K.row_hash(rows, _hash_columns(offered)).select(*[_q(c) for c in checked.columns])
    # J-06 on the offered products (after the filters, before pricing and change filtering), with the
    # F3 guard.
    listed = kept_table(J.listed_skus(live, rows, keys))
    if max_delete_share is not None and not force_deletes:
        if quarantine:
            guard = J.delete_share_errors(listed, listed.filter("_gone"), seller, max_share=max_delete_share)
            errors = kept_table(guard if errors is None else errors.unionByName(guard), "errors")
        else:
            J.refuse_deletes(listed, [seller], max_share=max_delete_share)
    deletes = listed.filter("_gone").drop("_gone")
    if errors is not None:
        # As a table of known size: wide rows are not dealt by seller where Spark can broadcast the sellers.
        failed = kept_table(errors.select(_q(seller)).distinct(), "errors")
        rows, deletes = (df.join(failed, seller, "left_anti") for df in (rows, deletes))
    once = rows.filter("_h_nth = 1").select(*[_q(c) for c in offered.columns], "product_hash", "_has_price")
    priced = once.filter("_has_price").drop("_has_price")
    rejected = once.filter("not _has_price").select(*[_q(c) for c in offered.columns], F.lit("missing_price").alias("reject_reason"))
    current = once.select(*[_q(k) for k in keys])
    annotated, duplicates = _single_rows(rows, keys)
    updates = annotated.filter(F.col("reason") != "unchanged")
    staged = K.stage_changes(updates, deletes, batch_id=batch_id, now=now, seller=seller, sku=cols.sku,
                             asin=cols.asin, title=cols.title, price=cols.price)
    ids = K.message_ids(staged.select("seller_id", "sku", "kind"), by=("seller_id",), order=("kind_rank", "sku"))
    ids = FD.chunk_messages(ids, size=chunk_size).select("seller_id", "sku", "message_id", "chunk_id", "kind")
    ucols = ProductColumns(**{**cols.__dict__, "sku": "sku"})
    upd = P.pack_price(updates.withColumnRenamed(seller, "seller_id").withColumnRenamed(cols.sku, "sku"), ucols)
    # Messages are read by the documents, the results and the price updates: what they are made of is kept once.
    named = [c for c in FD.message_columns(upd, ucols) if c != "seller_id"]
    sent = _numbered(upd.select("seller_id", *[_q(c) for c in named], "pack_price_applied"), ids.filter("kind = 'UPDATE'"))
    with session_conf(products.sparkSession, DEALT_BY_SKU):
        sent = kept_table(sent.unionByName(ids.filter("kind = 'DELETE'"), allowMissingColumns=True))
    sent_upd = sent.filter("kind = 'UPDATE'").drop("kind")
    update_msgs, _ = FD.update_messages(sent_upd, ucols)
    _, message_rejects = FD.update_messages(_numbered(upd, ids.filter("kind = 'UPDATE'").drop("kind")), ucols)
    delete_msgs = FD.delete_messages(sent.filter("kind = 'DELETE'"))
    messages = _union_messages(update_msgs, delete_msgs)
    documents = FD.feed_documents(messages, seller="seller_id", seller_label=seller_label)
    price_updates = sent_upd.filter("pack_price_applied").select("seller_id", "sku", F.col(cols.price).alias("price"))
    return FeedPlan(priced, rejected, annotated, staged, messages, message_rejects, documents, price_updates, current,
                    duplicates, errors)


#: Tasks that share the rows of one SKU.
SKU_SHARES = 8


def _numbered(upd: DataFrame, ids: DataFrame) -> DataFrame:
    """Update rows with their message ids. Both sides are dealt by SKU, a SKU's sellers over some tasks: what
    a SKU's rows have in common lies together, which keeps the exchange and the stored rows small."""
    share = F.pmod(F.xxhash64(F.col("seller_id").cast("string")), F.lit(SKU_SHARES))
    a, b = (df.withColumn("_share", share).repartition("sku", "_share") for df in (upd, ids))
    return a.join(b, ["sku", "_share", "seller_id"], "inner").drop("_share")


def _union_messages(update_msgs: DataFrame, delete_msgs: DataFrame) -> DataFrame:
    """Update and delete messages have different structs; both travel as JSON text."""
    u = update_msgs.select("seller_id", "sku", "message_id", "chunk_id", F.to_json("message").alias("message_json"))
    d = delete_msgs.select("seller_id", "sku", "message_id", "chunk_id", F.to_json("message").alias("message_json"))
    return u.unionByName(d)


def apply_feed(history: DataFrame, batches: DataFrame, results_raw: DataFrame, messages: DataFrame, *,
               batch_id: str, now: Column, keys=("seller_id", "batch_id", "feed_id")):
    """Fold the feed results of one batch back: ``(history, batches, errors)``."""
    issues, summary, errors = FD.parse_feed_result(results_raw, keys=keys)
    per_msg = feed_result_by_message(issues, group=[k for k in ("seller_id", "batch_id") if k in issues.columns],
                                     pos=[k for k in ("feed_id", "pos") if k in issues.columns], limit=FD.ERROR_CHARS)
    with_sku = J.issues_to_messages(per_msg, messages.select("seller_id", F.lit(batch_id).alias("batch_id"),
                                                             F.col("message_id").alias("messageId"), "sku"),
                                    on=("seller_id", "batch_id", "messageId"))
    new_history = FD.apply_feed_results(history, with_sku, batch_id=batch_id, now=now, keys=("seller_id", "sku"))
    totals = feed_summary(summary, by=("seller_id", "batch_id"))
    new_batches = FD.batch_totals(batches, totals, now=now)
    return new_history, new_batches, errors


def retain_offered(history: DataFrame, current: DataFrame, keys=("seller_id", "sku")) -> DataFrame:
    """J-07 for the sellers of a run: their history rows stay only while the SKU is offered; a seller
    without any offered product (as after a failed read) and sellers outside the run stay untouched."""
    keys = list(keys)
    run = current.select(keys[0]).distinct()
    return J.retain_valid_history(history, current, keys).unionByName(history.join(run, keys[0], "left_anti"))


def fold_staged(history: DataFrame, staged: DataFrame, price_updates: DataFrame | None = None) -> DataFrame:
    """L-15 and L-18: staged rows upserted into the change history (the old hash is kept when the new
    one is NULL), then recomputed pack prices applied."""
    keys = ["seller_id", "sku"]
    out = L.history_upsert(history, staged.drop("kind"), keys)
    if price_updates is not None:
        out = FD.apply_price_updates(out, price_updates, keys)
    return out


# Change / batch history tables are partitioned by a hash bucket of the seller, so a run that
# touches some sellers rewrites only their buckets.
HISTORY_BUCKETS = 64


def _bucket(seller: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(seller)), F.lit(buckets)).cast("int")


#: History rows that one round of a fold rewrites: what a round shuffles and stages goes before the next.
ROWS_PER_ROUND = 10_000_000


def bucket_rounds(rows: int, buckets: int = HISTORY_BUCKETS) -> list[list[int]]:
    """The buckets dealt over rounds of about ``ROWS_PER_ROUND`` rows."""
    n = min(buckets, max(1, -(-rows // ROWS_PER_ROUND)))
    return [list(range(i, buckets, n)) for i in range(n)]


def _in_buckets(df: DataFrame, part: list[int], *, seller: str = "seller_id", buckets: int = HISTORY_BUCKETS) -> DataFrame:
    """The rows of the sellers of some buckets."""
    return df if len(part) == buckets else df.filter(_bucket(seller, buckets).isin(part))


def store_history(history: DataFrame, path: str, *, staging_root: str, touched_sellers: DataFrame | None = None,
                  seller: str = "seller_id", buckets: int = HISTORY_BUCKETS, reads_target: bool | None = None) -> None:
    """Publish a seller-keyed history table (the change history or the batch history) partitioned
    by seller bucket. With ``touched_sellers`` (a frame holding the seller column) only the buckets
    of those sellers are rewritten; the rest stay as they are. ``history`` may read ``path`` (the
    new version is staged first, unless ``reads_target`` says that it does not)."""
    spark = history.sparkSession
    df = history.withColumn("_bucket", _bucket(seller, buckets))
    touched = None
    if touched_sellers is not None:
        # At most as many values as there are buckets.
        numbers = [r[0] for r in touched_sellers.select(_bucket(seller, buckets).alias("_bucket")).distinct().collect()]
        touched = spark.createDataFrame([(n,) for n in numbers], "_bucket int")
        df = df.filter(F.col("_bucket").isin(numbers))
    L.keep_bucket_count(spark, path, buckets, store=True)
    reads_target = L.has_partitions(spark, path) if reads_target is None else reads_target
    with shuffles_released(spark):
        L.publish_partitions(df, path, "_bucket", staging_root=staging_root, reads_target=reads_target, touched=touched,
                             compression="zstd")


def load_history(spark, path: str, schema, *, part: list[int] | None = None) -> DataFrame:
    """The stored history without its bucket column (``schema`` without ``_bucket``); with ``part`` only
    these buckets."""
    from pyspark.sql.types import IntegerType, StructType
    full = StructType(list(schema.fields)).add("_bucket", IntegerType())
    rows = spark.read.schema(full).parquet(path)
    return (rows if part is None else rows.filter(F.col("_bucket").isin(part))).drop("_bucket")


def run_plan_feed(products: DataFrame, identifiers: DataFrame, overrides: DataFrame | None,
                  rules: DataFrame | None, master: DataFrame | None, live: DataFrame, *, history_path: str,
                  history_schema, feed_path: str, staging_root: str, batch_id: str, now: Column, seed: str,
                  batches_path: str | None = None, batches_schema=None, sellers: tuple[DataFrame, DataFrame, DataFrame] | None = None,
                  runs_path: str | None = None, user_id: str = "id", **plan_kw) -> FeedPlan:
    """First job of a sync run (up to the upload boundary): plan against the stored change history,
    write one feed document per (seller, chunk) under ``<feed_path>/batch_id=<batch_id>`` and fold the
    staged rows (and recomputed pack prices) into the stored history, rewriting only the touched
    sellers' buckets. SKUs no longer offered (J-07) and SKUs sent as deletes (L-17) leave the history.
    With ``batches_path`` every seller of the batch gets its ``processing`` row in the batch history.

    With ``sellers`` (users, oauth, channels) the run starts from the eligible sellers (J-05): products
    and listings of all others are left alone. With ``runs_path`` the run table keeps the state of every
    seller of the batch, and a seller that fails its checks is quarantined instead of ending the job."""
    spark = products.sparkSession
    seller = plan_kw.get("seller", "seller_id")
    ensure_checkpoint_dir(spark)
    if sellers is not None:
        complete, incomplete = J.eligible_sellers(*sellers, user_id=user_id)
        eligible = kept_table(complete.select(F.col(user_id).cast(products.schema[seller].dataType).alias(seller)).distinct(), "sellers")
        products, live = (df.join(eligible, seller, "left_semi") for df in (products, live))
    if runs_path is not None:
        if sellers is None:
            complete = products.select(F.col(seller).alias(user_id)).union(live.select(seller)).distinct()
            incomplete = complete.limit(0).withColumn("selling_partner_id", F.lit(None).cast("string"))
        rows = RN.started(complete, incomplete, batch_id=batch_id, now=now, user_id=user_id)
        _put_run(spark, rows, runs_path=runs_path, staging_root=staging_root)
        plan_kw.setdefault("quarantine", True)
    history = _stored(spark, history_path, history_schema)
    plan = plan_feed(products, identifiers, overrides, rules, master, history, live, batch_id=batch_id, now=now,
                     seed=seed, **plan_kw)
    with shuffles_released(spark):
        FD.store_documents(plan.documents, f"{feed_path.rstrip('/')}/batch_id={batch_id}")
    cols = plan_kw.get("cols", PC)
    current = plan.current.select(F.col(f"`{seller}`").cast("string").alias("seller_id"),
                                  F.col(f"`{cols.sku}`").cast("string").alias("sku"))
    offering = kept_table(current.select("seller_id").distinct(), "sellers")
    staged_sellers = kept_table(plan.staged.select("seller_id").distinct(), "sellers")
    touched = staged_sellers.union(offering).distinct()
    if batches_path is not None:
        start_batch(spark, staged_sellers, batches_path=batches_path, batches_schema=batches_schema,
                    staging_root=staging_root, batch_id=batch_id, now=now)
    known = L.has_partitions(spark, history_path)
    keys = ["seller_id", "sku"]
    for part in bucket_rounds(plan.staged.count() + history.count()):
        old, valid, staged, prices, sellers = (_in_buckets(df, part) for df in (
            _stored(spark, history_path, history_schema, part=part) if known else history, current, plan.staged, plan.price_updates, touched))
        deletes = staged.filter("kind = 'DELETE'")
        # Prices and deletes come before the upsert: its two sides are dealt by the same keys then.
        staged = FD.delete_listed_history(FD.apply_price_updates(staged, prices, keys), deletes, keys)
        old = FD.delete_listed_history(retain_offered(old, valid, keys), deletes, keys)
        store_history(fold_staged(old, staged), history_path, staging_root=staging_root, touched_sellers=sellers, reads_target=known)
    if runs_path is not None:
        failed = spark.createDataFrame([], "seller_id string, error string") if plan.errors is None else plan.errors.select(
            F.col(f"`{seller}`").cast("string").alias("seller_id"), "error")
        rows = RN.planned(read_run(spark, runs_path, batch_id), offering, staged_sellers, failed, now=now)
        _put_run(spark, rows, runs_path=runs_path, staging_root=staging_root)
    return plan


def read_run(spark, runs_path: str, batch_id: str) -> DataFrame:
    """The run table's rows of one batch; ``run_outcomes`` counts those that were not ``incomplete``."""
    return _stored(spark, runs_path, RN.RUN_SCHEMA).filter(F.col("batch_id") == F.lit(batch_id))


def _put_run(spark, rows: DataFrame, *, runs_path: str, staging_root: str) -> None:
    """Rows of the run table stored, replacing those of the same (batch, seller)."""
    rows = rows.checkpoint(eager=True)
    runs = L.delete_insert(_stored(spark, runs_path, RN.RUN_SCHEMA), rows, ["batch_id", "seller_id"])
    store_history(runs, runs_path, staging_root=staging_root, touched_sellers=rows.select("seller_id"))


def _stored(spark, path: str, schema, *, part: list[int] | None = None) -> DataFrame:
    fs, p, _ = L._fs(spark, path)
    return load_history(spark, path, schema, part=part) if fs.exists(p) else spark.createDataFrame([], schema)


def start_batch(spark, sellers: DataFrame, *, batches_path: str, batches_schema, staging_root: str, batch_id: str,
                now: Column) -> None:
    """The ``processing`` row of every seller of a batch, written at the start of the run; a repeated
    start replaces the rows of the same (batch, seller)."""
    batches = _stored(spark, batches_path, batches_schema)
    given = {"batch_id": F.lit(batch_id), "seller_id": F.col("seller_id"), "status": F.lit("processing"), "started_at": now}
    rows = sellers.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in batches_schema.fields])
    store_history(L.delete_insert(batches, rows, ["batch_id", "seller_id"]), batches_path, staging_root=staging_root,
                  touched_sellers=sellers)


def run_apply_feed(spark, result_paths, messages: DataFrame, *, history_path: str, history_schema,
                   batches_path: str, batches_schema, staging_root: str, batch_id: str, now: Column,
                   seller: str = "seller_id", runs_path: str | None = None, stored: bool = False):
    """Second job: read the feed result documents (one JSON document per file; the seller is the
    ``seller_id=`` folder of the file; with ``stored`` a folder written by ``store_results``, which
    does not grow by a file a seller), fold them into the stored change history and batch
    history (only the sellers of this batch are rewritten) and, with ``runs_path``, into the run table.
    Returns the unreadable documents."""
    from adspark.sources.files import whole_files
    if stored:
        raw = FD.read_results(spark, result_paths).select(F.col("seller_id").alias(seller), F.lit(batch_id).alias("batch_id"), "feed_id", "value")
    else:
        raw = whole_files(spark, result_paths).select(
            F.regexp_extract("_file", r"seller_id=([^/]+)", 1).alias(seller), F.lit(batch_id).alias("batch_id"),
            F.col("_file").alias("feed_id"), "value")
    history = load_history(spark, history_path, history_schema)
    batches = _stored(spark, batches_path, batches_schema)
    _, new_batches, errors = apply_feed(history, batches, raw, messages, batch_id=batch_id, now=now)
    # All sellers of the batch, also those without a result file: their rows end with the batch.
    touched = kept_table(raw.select(seller).union(history.filter(F.col("batch_id") == F.lit(batch_id)).select(seller)).distinct(), "sellers")
    for part in bucket_rounds(history.count()):
        old = load_history(spark, history_path, history_schema, part=part)
        results, sent, sellers = (_in_buckets(df, part, seller=s) for df, s in ((raw, seller), (messages, "seller_id"), (touched, seller)))
        new_history, _, _ = apply_feed(old, batches, results, sent, batch_id=batch_id, now=now)
        store_history(new_history, history_path, staging_root=staging_root, touched_sellers=sellers)
    store_history(new_batches, batches_path, staging_root=staging_root, touched_sellers=touched)
    if runs_path is not None:
        _, summary, _ = FD.parse_feed_result(raw, keys=("seller_id", "batch_id", "feed_id"))
        rows = RN.finished(read_run(spark, runs_path, batch_id), feed_summary(summary, by=("seller_id", "batch_id")),
                           errors.select("seller_id"), now=now)
        _put_run(spark, rows, runs_path=runs_path, staging_root=staging_root)
    return errors
