"""Numeric casts, sanitisers and the pricing column expressions (K-13..K-16, K-24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adspark.functions.text import MISSING_TOKENS, _c, try_cast


def to_double(c) -> Column:
    """Text or number to double; unparsable, missing tokens and NaN become NULL."""
    c = _c(c)
    d = try_cast(F.trim(c.cast("string")), "double")
    # nanvl references the parsed value once (a CASE would copy the whole parse expression).
    return F.nanvl(d, F.lit(None).cast("double"))


def to_long(c) -> Column:
    """Text to bigint: exact integer text first (keeps ids above 2^53 exact), then through double so
    that ``'5.0'`` reads as 5; anything else NULL."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(try_cast(s, "bigint"), try_cast(try_cast(s, "double"), "bigint"))


def round_money(c, scale: int = 2) -> Column:
    """D13: money is rounded HALF_UP on its decimal value: cast to ``decimal(18,4)`` first, then
    rounded to ``scale`` places and returned as double."""
    return F.round(_c(c).cast("decimal(18,4)"), scale).cast("double")


def sanitize_number(c, type_: str = "double") -> Column:
    """N-13: NULL, missing tokens and unparsable text become NULL."""
    c = _c(c)
    c = F.when(F.trim(c.cast("string")).isin(list(MISSING_TOKENS)), F.lit(None)).otherwise(c)
    return to_long(c) if type_ in ("long", "bigint", "int") else to_double(c)


def target_price_num(cost: Column, fee: Column, margin: Column) -> Column:
    """K-13 on double columns (NULL for a missing input)."""
    denom = F.lit(1.0) - fee - margin
    return F.when((cost > 0) & (denom > 0), F.round(cost / denom, 4))


def target_price(cost, fee, margin) -> Column:
    """K-13: ``cost / (1 - fee - margin)`` rounded to 4 places; NULL when cost <= 0, the denominator
    <= 0 or any input is not a number."""
    return target_price_num(to_double(cost), to_double(fee), to_double(margin))


def map_floor(price, map_price) -> Column:
    """K-14: a positive MAP above the price replaces it; a missing price stays missing."""
    price, m = _c(price), to_double(map_price)
    return F.when((m > 0) & (m > price), m).otherwise(price)


def override_map_floor(price, override_map) -> Column:
    """K-15: an override MAP above the price replaces it (no positivity test)."""
    price, m = _c(price), to_double(override_map)
    return F.when(m > price, m).otherwise(price)


def explicit_price_override(price, override) -> Column:
    """K-16: a valid numeric override replaces the price, also a missing one."""
    return F.coalesce(to_double(override), _c(price))


def list_price(price, retail) -> Column:
    """K-24: ``max(round(price, 2), round(retail, 2))``; NULL when either is not a number (the
    reference skips such rows)."""
    p, r = to_double(price), to_double(retail)
    return F.when(p.isNotNull() & r.isNotNull(), F.greatest(round_money(p), round_money(r)))
