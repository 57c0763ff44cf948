"""Equi-joins of the catalog sync and key lookups (I-07), set ops (S-*).

All joins are equality joins (inner / left / semi / anti). Spark chooses broadcast-hash or
sort-merge from sizes (and AQE re-plans at runtime).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.functions.text import is_missing, normalize_text_key


def _on(on):
    return [on] if isinstance(on, str) else list(on)


def _q(c: str) -> str:
    return f"`{c}`"


def lookup_by_keys(df: DataFrame, keys: DataFrame, on, *, cols=None) -> DataFrame:
    """I-07: rows of ``df`` whose key is among ``keys`` (semi join; no IN-list text), optionally
    only some columns. An empty key frame gives an empty result."""
    on = _on(on)
    out = df.join(keys.select(*[_q(c) for c in on]), on, "left_semi")
    if cols is not None:
        out = out.select(*[_q(c) for c in dict.fromkeys(on + list(cols))])
    return out


def join_identifiers(products: DataFrame, ids: DataFrame, on) -> DataFrame:
    """J-01: products LEFT JOIN identifiers on the SKU; duplicate identifier rows fan out."""
    return products.join(ids, _on(on), "left")


def join_new_columns(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J-02: LEFT JOIN bringing only the columns of ``right`` that ``left`` lacks."""
    on = _on(on)
    new = [c for c in right.columns if c not in left.columns]
    if not new:
        return left
    return left.join(right.select(*[_q(c) for c in on + new]), on, "left")


def join_brand_rules(products: DataFrame, rules: DataFrame | None, *, brand: str = "brand",
                     rule_brand: str = "brand_name", prefix: str = "brand_rules_", on=()) -> DataFrame:
    """J-03: LEFT JOIN the brand rules on the normalised brand (lower + trim) and the extra keys
    ``on`` (e.g. the seller). Rule columns come back prefixed. The rule table is optional; Spark
    broadcasts it where its size allows."""
    if rules is None:
        return products
    on = [on] if isinstance(on, str) else list(on)
    r = rules.drop("id") if "id" in rules.columns else rules
    renamed = r.select(*[F.col(_q(c)).alias(c if c in on else prefix + c) for c in r.columns]) \
        .withColumn("_brand_key", normalize_text_key(F.col(_q(prefix + rule_brand))))
    return products.withColumn("_brand_key", normalize_text_key(F.col(_q(brand)))) \
        .join(renamed, on + ["_brand_key"], "left").drop("_brand_key")


def join_override_price(products: DataFrame, overrides: DataFrame, *, on="sku",
                        map_col: str = "map_price", seq: str = "seq",
                        suffix: str = "_overwrite") -> DataFrame:
    """J-04: bring the override MAP price as ``<map_col><suffix>``. Overrides are first reduced to
    one row per SKU (the latest non-missing value by ``seq``, D6), so products never fan out."""
    on = _on(on)
    valid = ~is_missing(F.col(_q(map_col)))
    one = overrides.groupBy(*[_q(k) for k in on]).agg(
        F.max_by(F.when(valid, F.col(_q(map_col))), F.when(valid, F.col(_q(seq)))).alias(map_col + suffix))
    return products.join(one, on, "left")


def eligible_sellers(users: DataFrame, oauth: DataFrame, channels: DataFrame, *, only=None,
                     user_id: str = "id", token_cols=("access_token", "refresh_token")):
    """J-05: users LEFT JOIN oauth LEFT JOIN channels, superusers (and users of unknown standing)
    excluded, optionally one user. A blank partner id counts as missing.

    Returns ``(complete, incomplete)``; only token-present flags travel, never tokens (D7).
    """
    u = users.filter(~F.coalesce(F.col("is_superuser").cast("boolean"), F.lit(True)))
    if only is not None:
        u = u.filter(F.col(user_id) == F.lit(only))
    present = [c for c in token_cols if c in oauth.columns]
    o = oauth.select(F.col("user_id").alias(user_id),
                     *[(F.col(c).isNotNull() & (F.trim(F.col(c)) != "")).alias(f"has_{c}") for c in present])
    ch = channels.select(F.col("user_id").alias(user_id), "selling_partner_id")
    joined = u.select(user_id).join(o, user_id, "left").join(ch, user_id, "left")
    ok = F.trim(F.coalesce(F.col("selling_partner_id").cast("string"), F.lit(""))) != ""
    for c in present:
        ok = ok & F.coalesce(F.col(f"has_{c}"), F.lit(False))
    joined = joined.withColumn("_complete", ok)
    return (joined.filter("_complete").drop("_complete"),
            joined.filter(~F.col("_complete")).drop("_complete"))


def skus_to_delete(live: DataFrame, products: DataFrame, on, *, max_share: float | None = 0.5,
                   force: bool = False, by=None) -> DataFrame:
    """J-06: live SKUs that are no longer among the current products (anti join).

    Guard against F3 (a failed product read must not delete a whole store): with ``max_share`` set
    (default 0.5; ``None`` disables it), deleting more than that share of a group's live SKUs (in particular all of them because its
    product set came back empty) fails unless ``force``. With ``by`` (e.g. the seller) the check is
    per group and lazy: a ``raise_error`` inside the plan fails the query that uses the deletes, no
    extra job runs. Without ``by`` it is one global check run immediately.
    """
    on = _on(on)
    out = live.join(products.select(*[_q(c) for c in on]), on, "left_anti")
    if max_share is None or force:
        return out
    if by is None:
        known = products.select(*[_q(c) for c in on]).distinct().withColumn("_known", F.lit(True))
        stats = live.join(known, on, "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_known").isNull()).alias("d")).first()
        if stats["n"] > 0 and stats["d"] > max_share * stats["n"]:
            raise ValueError(f"refusing to delete {stats['d']} of {stats['n']} live SKUs; pass force=True")
        return out
    by = _on(by)
    n = live.groupBy(*[_q(c) for c in by]).agg(F.count(F.lit(1)).alias("_n"))
    d = out.groupBy(*[_q(c) for c in by]).agg(F.count(F.lit(1)).alias("_d"))
    guard = n.join(d, by, "inner").select(
        *[_q(c) for c in by],
        F.when(F.col("_d") > F.lit(max_share) * F.col("_n"),
               F.raise_error(F.concat(F.lit("refusing to delete more than the allowed share of live SKUs for "),
                                      F.concat_ws("/", *[F.col(_q(c)).cast("string") for c in by]))))
        .otherwise(F.lit(True)).alias("_ok"))
    return out.join(guard, by, "left").filter(F.coalesce(F.col("_ok"), F.lit(True))).drop("_ok")


def listed_skus(live: DataFrame, products: DataFrame, on) -> DataFrame:
    """J-06 for all live SKUs: each distinct key of ``live`` once, with ``_gone`` where it is no longer among
    the products (a key with a NULL never is). Live and current keys meet in one aggregate."""
    on = _on(on)
    a, b = live.select(*[_q(c) for c in on]), products.select(*[_q(c) for c in on])
    if [f.dataType for f in a.schema] != [f.dataType for f in b.schema]:
        known = b.distinct().withColumn("_known", F.lit(True))
        return a.distinct().join(known, on, "left").select(*[_q(c) for c in on], F.col("_known").isNull().alias("_gone"))
    flags = a.select("*", F.lit(True).alias("_live"), F.lit(False).alias("_known")).union(b.select("*", F.lit(False), F.lit(True)))
    keys = flags.groupBy(*[_q(c) for c in on]).agg(F.max("_live").alias("_live"), F.max("_known").alias("_known"))
    gone = ~F.col("_known")
    for c in on:
        gone = gone | F.col(_q(c)).isNull()
    return keys.filter("_live").select(*[_q(c) for c in on], gone.alias("_gone"))


def refuse_deletes(listed: DataFrame, by, *, max_share: float) -> None:
    """The guard of ``skus_to_delete`` on ``listed_skus``: an error if one group would lose more than ``max_share``."""
    by, known = _on(by), F.lit(True)
    for c in by:
        known = known & F.col(_q(c)).isNotNull()
    counts = listed.filter(known).groupBy(*[_q(c) for c in by]).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_gone").alias("_d"))
    group = F.concat_ws("/", *[F.col(_q(c)).cast("string") for c in by])
    counts.filter(F.col("_d") > F.lit(max_share) * F.col("_n")) \
        .select(F.raise_error(F.concat(F.lit("refusing to delete more than the allowed share of live SKUs for "), group))).limit(1).collect()


def delete_share_errors(live: DataFrame, deletes: DataFrame, by, *, max_share: float = 0.5) -> DataFrame:
    """The guard of ``skus_to_delete`` as rows: one (``by``, ``error``) for each group of which more than
    ``max_share`` of the live SKUs would be deleted."""
    by = _on(by)
    n = live.groupBy(*[_q(c) for c in by]).agg(F.count(F.lit(1)).alias("_n"))
    d = deletes.groupBy(*[_q(c) for c in by]).agg(F.count(F.lit(1)).alias("_d"))
    text = F.format_string("refusing to delete %d of %d live SKUs", F.col("_d"), F.col("_n"))
    return n.join(d, by).filter(F.col("_d") > F.lit(max_share) * F.col("_n")).select(*[_q(c) for c in by], text.alias("error"))


def retain_valid_history(history: DataFrame, valid: DataFrame, on) -> DataFrame:
    """J-07: keep only history rows whose SKU is current (semi join)."""
    on = _on(on)
    return history.join(valid.select(*[_q(c) for c in on]), on, "left_semi")


def issues_to_messages(results: DataFrame, messages: DataFrame, on=("batch_id", "messageId")) -> DataFrame:
    """J-09: attach the SKU of each result by message id; no match gives NULL."""
    on = _on(on)
    return results.join(messages.select(*[_q(c) for c in on], "sku"), on, "left")


def union_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """S-01: bag union by column name."""
    return a.unionByName(b, allowMissingColumns=True)


def sku_difference(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """S-02: rows of ``a`` whose key is not in ``b``."""
    on = _on(on)
    return a.join(b.select(*[_q(c) for c in on]), on, "left_anti")
