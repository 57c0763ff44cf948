"""Catalog-sync pricing operators.

Column names are parameters (``ProductColumns``); the defaults are neutral snake_case names.
Every rule is a column expression inside one projection, so the whole chain stays in one
whole-stage-codegen span between the joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.functions.numbers import (explicit_price_override, override_map_floor, round_money,
                                       target_price_num, to_double)
from adspark.functions.text import is_missing, normalize_text_key, try_cast
from adspark.operators.joins import join_brand_rules, join_override_price


@dataclass(frozen=True)
class ProductColumns:
    sku: str = "sku"
    title: str = "title"
    brand: str = "brand"
    cost: str = "cost"
    fulfillment_cost: str = "fulfillment_cost"
    margin: str = "requested_margin"
    retail: str = "retail_price"
    map_price: str = "map_price"
    quantity: str = "quantity"
    uom: str = "uom"
    push_marketplace: str = "push_to_marketplace"
    push_site: str = "push_to_site"
    asin: str = "asin"
    fee: str = "referral_fee"
    mpn_match: str = "mpn_match"
    item_name: str = "item_name"
    product_type: str = "product_type"
    pack_count: str = "number_of_items"
    price: str = "price_to_push"


@dataclass(frozen=True)
class RuleColumns:
    brand: str = "brand_name"
    map_fraction: str = "map_fraction"
    push_marketplace: str = "push_to_marketplace"
    push_site: str = "push_to_site"


PC = ProductColumns()
RC = RuleColumns()


def _c(name: str):
    return F.col(f"`{name}`")


def as_double(df: DataFrame, name: str):
    """A column as double: numeric columns are cast directly (NaN becomes NULL), text is parsed
    (``to_double``); an absent column is NULL. DataFrame-level steps use it so that typed columns
    are never sent through a text round trip."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.nanvl(_c(name).cast("double"), F.lit(None).cast("double"))
    return to_double(_c(name))


def numeric_fields(df: DataFrame, cols: ProductColumns = PC) -> DataFrame:
    """Parse the numeric product fields (text at the source) to doubles once, so that the pricing
    steps after it work on typed values."""
    names = [cols.cost, cols.fulfillment_cost, cols.margin, cols.retail, cols.map_price, cols.quantity,
             cols.uom, cols.fee, cols.pack_count]
    return df.withColumns({n: as_double(df, n) for n in names if n in df.columns})


def mpn_block(df: DataFrame, cols: ProductColumns = PC) -> DataFrame:
    """K-10: an identifier match flag equal to ``false`` (any case) sets the marketplace push flag
    to ``No``; NULL changes nothing (and so does an absent flag column)."""
    if cols.mpn_match not in df.columns:
        return df
    return df.withColumn(cols.push_marketplace,
                         F.when(F.lower(_c(cols.mpn_match)) == "false", F.lit("No")).otherwise(_c(cols.push_marketplace)))


def cell_overrides(products: DataFrame, overrides: DataFrame, on, *, seq: str, cols=None) -> DataFrame:
    """K-11: for every column present in both frames, a non-missing override replaces the cell.
    Several override rows per SKU: per column the latest (by ``seq``) non-missing value wins.
    Unknown SKUs are ignored. The override table is reduced by a grouped aggregate (partial
    aggregation before the shuffle) and joined once. ``on`` is the key (e.g. seller and SKU)."""
    on = [on] if isinstance(on, str) else list(on)
    common = [c for c in overrides.columns if c in products.columns and c not in on and c != seq]
    if cols is not None:
        common = [c for c in common if c in cols]
    if not common:
        return products
    aggs = []
    for c in common:
        valid = ~is_missing(_c(c))
        aggs.append(F.max_by(F.when(valid, _c(c).cast("string")), F.when(valid, _c(seq))).alias(f"_ov_{c}"))
    # Rows without any usable override value cannot change a result: drop them before the shuffle.
    useful = F.lit(False)
    for c in common:
        useful = useful | ~is_missing(_c(c))
    reduced = overrides.filter(useful).groupBy(*[_c(k) for k in on]).agg(*aggs)
    joined = products.join(reduced, on, "left")
    out = joined.withColumns({c: F.coalesce(_c(f"_ov_{c}"), _c(c).cast("string")) for c in common})
    return out.drop(*[f"_ov_{c}" for c in common])


def reduce_overrides(overrides: DataFrame, on, *, seq: str, cols, numeric=()) -> DataFrame:
    """One row per key with the latest (by ``seq``) non-missing value of each column in ``cols``
    (``_ov_<col>``) and the latest numeric value of each column in ``numeric`` (``_ovnum_<col>``).
    One grouped aggregate serves K-11, K-15 and K-16 together."""
    on = [on] if isinstance(on, str) else list(on)
    # Each value is worked out once, as a column, for the filter, the value and its order.
    values = {f"_ov_{c}": F.when(~is_missing(_c(c)), _c(c).cast("string")) for c in cols}
    values |= {f"_ovnum_{c}": to_double(_c(c)) for c in numeric}
    rows = overrides.select(*[_c(k) for k in on], _c(seq).alias("_seq"), *[v.alias(n) for n, v in values.items()])
    useful = F.lit(False)
    for n in values:
        useful = useful | _c(n).isNotNull()
    aggs = [F.max_by(_c(n), F.when(_c(n).isNotNull(), F.col("_seq"))).alias(n) for n in values]
    # Rows without any usable value cannot change a result: drop them before the shuffle.
    return rows.filter(useful).groupBy(*[_c(k) for k in on]).agg(*aggs)


def brand_rules(df: DataFrame, rules: DataFrame | None, cols: ProductColumns = PC, rc: RuleColumns = RC,
                *, check_unique: bool = True, on=()) -> DataFrame:
    """K-12: where a brand rule matches (normalised brand), the site flag takes the rule value if
    valid; the marketplace flag likewise unless already ``No``; MAP becomes
    ``round((1 - fraction) * retail, 2)`` when the fraction is valid, else stays."""
    if rules is None:
        return df
    if check_unique:
        dup = rules.groupBy(*[_c(k) for k in on], normalize_text_key(_c(rc.brand)).alias("b")).count().filter("count > 1")
        if dup.limit(1).count() > 0:
            raise ValueError("more than one brand rule for a brand")
    p = "brand_rules_"
    j = join_brand_rules(df, rules, brand=cols.brand, rule_brand=rc.brand, prefix=p, on=on)
    matched = _c(p + rc.brand).isNotNull()
    r_mkt, r_site, r_frac = _c(p + rc.push_marketplace), _c(p + rc.push_site), _c(p + rc.map_fraction)
    frac = to_double(r_frac)
    new_map = round_money((F.lit(1.0) - frac) * to_double(_c(cols.retail)))
    out = j.withColumns({
        cols.push_marketplace: F.when(matched & ~_c(cols.push_marketplace).eqNullSafe("No") & ~is_missing(r_mkt), r_mkt)
        .otherwise(_c(cols.push_marketplace)),
        cols.push_site: F.when(matched & ~is_missing(r_site), r_site).otherwise(_c(cols.push_site)),
        cols.map_price: F.when(matched & frac.isNotNull(), new_map).otherwise(to_double(_c(cols.map_price))),
    })
    return out.drop(*[c for c in out.columns if c.startswith(p)])


def rule_errors(rules: DataFrame, on, rc: RuleColumns = RC) -> DataFrame:
    """The uniqueness check of ``brand_rules`` as rows: one (``on``, ``error``) for each group with more
    than one rule for a (normalised) brand."""
    on = [on] if isinstance(on, str) else list(on)
    key = F.coalesce(normalize_text_key(_c(rc.brand)), F.lit(""))
    dup = rules.groupBy(*[_c(k) for k in on], key.alias("_b")).count().filter("count > 1")
    return dup.groupBy(*[_c(k) for k in on]).agg(F.concat(F.lit("more than one brand rule for "), F.min("_b")).alias("error"))


def apply_target_price(df: DataFrame, cols: ProductColumns = PC) -> DataFrame:
    """K-13 as a frame step: ``price`` from fulfillment cost, referral fee and margin."""
    return df.withColumn(cols.price, target_price_num(as_double(df, cols.fulfillment_cost), as_double(df, cols.fee),
                                                      as_double(df, cols.margin)))


def apply_map_floor(df: DataFrame, cols: ProductColumns = PC) -> DataFrame:
    """K-14 as a frame step: a positive MAP above the price replaces it."""
    m, price = as_double(df, cols.map_price), _c(cols.price)
    return df.withColumn(cols.price, F.when((m > 0) & (m > price), m).otherwise(price))


def apply_override_prices(df: DataFrame, overrides: DataFrame, cols: ProductColumns = PC, *, seq: str = "seq",
                          override_price: str | None = None, on=None) -> DataFrame:
    """K-15 and K-16: the override MAP floors the price (no positivity test), then a valid numeric
    override price replaces it. Bad override numbers are ignored (counted by ``override_rejects``)."""
    override_price = override_price or cols.price
    on = [cols.sku] if on is None else ([on] if isinstance(on, str) else list(on))
    j = join_override_price(df, overrides, on=on, map_col=cols.map_price, seq=seq)
    j = j.withColumn(cols.price, override_map_floor(_c(cols.price), _c(cols.map_price + "_overwrite"))) \
        .drop(cols.map_price + "_overwrite")
    if override_price not in overrides.columns:
        return j
    valid = ~is_missing(_c(override_price)) & to_double(_c(override_price)).isNotNull()
    ov = overrides.groupBy(*[_c(k) for k in on]).agg(
        F.max_by(F.when(valid, _c(override_price)), F.when(valid, _c(seq))).alias("_price_ov"))
    return j.join(ov, on, "left") \
        .withColumn(cols.price, explicit_price_override(_c(cols.price), _c("_price_ov"))).drop("_price_ov")


def override_rejects(overrides: DataFrame, cols: ProductColumns = PC, *, override_price: str | None = None) -> DataFrame:
    """Override prices that are present but not numbers (warned and ignored by K-16)."""
    c = _c(override_price or cols.price)
    return overrides.filter(~is_missing(c) & to_double(c).isNull())


def price_reject(df: DataFrame, cols: ProductColumns = PC):
    """K-19: split into rows with a price and rows without one (rejected with a reason, D12)."""
    has = as_double(df, cols.price).isNotNull()
    return df.filter(has), df.filter(~has).withColumn("reject_reason", F.lit("missing_price"))


def pack_price(df: DataFrame, cols: ProductColumns = PC, *, out: str | None = None) -> DataFrame:
    """K-23 (and K-24 first): the list price is ``max(round(price, 2), round(retail, 2))``; when the
    pack count and unit count are valid, pack > unit and unit <> 0 (both truncated to int), the
    cost is scaled to ``cost * pack / unit + (fulfillment - cost)`` and the price becomes
    ``max(round(target_price(scaled), 2), retail)`` if that target price exists. Adds
    ``list_price`` and ``pack_price_applied``; ``price`` is rounded to 2.

    Intermediate values are separate typed columns (each computed once per row: inside CASE
    branches Spark cannot share repeated sub-expressions)."""
    out = out or cols.price
    tmp = ["_pk_price", "_pk_retail", "_pk_cost", "_pk_ful", "_pk_fee", "_pk_margin", "_pk_pack", "_pk_unit",
           "_pk_target", "_pk_price2", "_pk_retail2"]
    d = df.withColumns({
        "_pk_price": as_double(df, cols.price), "_pk_retail": as_double(df, cols.retail),
        "_pk_cost": as_double(df, cols.cost), "_pk_ful": as_double(df, cols.fulfillment_cost),
        "_pk_fee": as_double(df, cols.fee), "_pk_margin": as_double(df, cols.margin),
        "_pk_pack": try_cast(as_double(df, cols.pack_count), "int"), "_pk_unit": try_cast(as_double(df, cols.uom), "int"),
    })
    pack, unit, cost = F.col("_pk_pack"), F.col("_pk_unit"), F.col("_pk_cost")
    applies = pack.isNotNull() & unit.isNotNull() & (pack > unit) & (unit != 0)
    scaled = cost * (pack.cast("double") / unit.cast("double")) + (F.col("_pk_ful") - cost)
    d = d.withColumns({
        "_pk_target": F.when(applies, target_price_num(scaled, F.col("_pk_fee"), F.col("_pk_margin"))),
        "_pk_price2": round_money(F.col("_pk_price")), "_pk_retail2": round_money(F.col("_pk_retail")),
    })
    use_new = F.col("_pk_target").isNotNull()
    d = d.withColumns({
        "list_price": F.when(F.col("_pk_price").isNotNull() & F.col("_pk_retail").isNotNull(),
                             F.greatest(F.col("_pk_price2"), F.col("_pk_retail2"))),
        out: F.when(use_new, F.greatest(round_money(F.col("_pk_target")), F.col("_pk_retail2")))
        .otherwise(F.col("_pk_price2")),
        "pack_price_applied": use_new,
    })
    return d.drop(*tmp)
