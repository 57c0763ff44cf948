"""Text functions: missing tokens, name/value normalisation, sanitisers, decoding."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens that mean "missing" in the product tables (all read as text).
MISSING_TOKENS = ("", "nan", "NULL", "None")

# Characters ``str.isprintable`` rejects: control / format / private / surrogate / unassigned
# (``\p{C}``) and every separator (``\p{Z}``) except the plain blank. One intersected character
# class (Java regex syntax); it runs about twice as fast as the equivalent alternation
# ``[\p{C}\p{Zl}\p{Zp}]|[^\P{Zs} ]`` that engines without class intersection need.
NON_PRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, type_: str) -> Column:
    """``TRY_CAST``: NULL instead of an error for a value that does not convert."""
    return _c(c).try_cast(type_)


def is_missing(c, tokens=MISSING_TOKENS) -> Column:
    """True when the value is NULL or, trimmed, one of the missing tokens."""
    text = F.trim(_c(c).cast("string"))
    # The value is named once: a plan would work out what it stands for again at each mention.
    return F.coalesce(text, F.lit("")).isin(list(tokens)) if "" in tokens else text.isNull() | text.isin(list(tokens))


def null_token(c, tokens=MISSING_TOKENS) -> Column:
    """I-06: map the missing tokens to NULL, keep everything else."""
    c = _c(c)
    return F.when(is_missing(c, tokens), F.lit(None)).otherwise(c)


def normalize_text_key(c) -> Column:
    """N-18: lower-case and strip outer blanks (used for brand matching)."""
    return F.lower(F.trim(_c(c)))


# The naming rules of N-01, in order, as (pattern, replacement). A blank on either side
# of a round bracket goes, then one closing bracket at the end; white space, dash, brackets, braces
# and question mark become an underscore; comma, dot and slash go.
NAME_RULES = (
    (r" ?\( ?", "("),
    (r" ?\) ?", ")"),
    (r"\)$(?!\n)", ""),
    (r"[\s\-()\[\]{}?]", "_"),
    (r"[,./]", ""),
)


def normalize_column_name(name: str) -> str:
    """N-01 on one column name (driver-side: names are schema, not data)."""
    for pattern, put in NAME_RULES:
        name = re.sub(pattern, put, name)
    return name


def normalize_value(c) -> Column:
    """N-01 applied to values: the same rules as column expressions."""
    c = _c(c)
    for pattern, put in NAME_RULES:
        c = F.regexp_replace(c, pattern, put)
    return c


def sanitize_string(c, n: int = 255) -> Column:
    """N-12: keep NULL; drop non-printable characters (control, format, unassigned, separators other
    than the plain blank); truncate to ``n`` characters."""
    c = _c(c)
    cleaned = F.regexp_replace(c, NON_PRINTABLE, "")
    return F.substring(cleaned, 1, n)


def truncate_with_ellipsis(c, n: int = 65535) -> Column:
    """N-15: text longer than ``n`` becomes its first ``n - 3`` characters plus ``...``."""
    c = _c(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


def decode_with_fallback(value, fallback: str = "ISO-8859-1") -> Column:
    """I-02: bytes as UTF-8 when valid, else decoded with the fallback charset (latin1 accepts every
    byte, so later fallbacks are unreachable). ``value`` is binary or string."""
    v = _c(value)
    as_bin = v.cast("binary")
    return F.when(F.is_valid_utf8(as_bin), as_bin.cast("string")).otherwise(F.decode(as_bin, fallback))


def url_key_decode(c) -> Column:
    """I-12: decode an object key like ``unquote_plus`` (``+`` becomes a blank, ``%xx`` decoded)."""
    return F.try_url_decode(_c(c))
