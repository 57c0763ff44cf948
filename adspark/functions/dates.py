"""Date and timestamp functions (N-04, N-14, I-10, F-02, F-03)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adspark.functions.text import _c, try_cast

# Tokens meaning "no timestamp", and the formats tried after ISO parsing.
NULL_TIMESTAMP_TOKENS = ("none", "null", "")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd", "yyyy-MM-dd",
                     "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss")


def parse_timestamp(c, formats=TIMESTAMP_FORMATS, epoch: bool = True) -> Column:
    """N-04: ``none``/``null``/blank (any case) -> NULL, else ISO text, then each format; with
    ``epoch`` a 13-digit number is epoch milliseconds and a 10-digit one epoch seconds (D3)."""
    s = F.trim(_c(c).cast("string"))
    candidates = [F.try_to_timestamp(s)] + [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    if epoch:
        digits = s.rlike(r"^[0-9]+$")
        candidates.append(F.when(digits & (F.length(s) == 13),
                                 F.timestamp_millis(try_cast(s, "bigint"))))
        candidates.append(F.when(digits & (F.length(s) == 10),
                                 F.timestamp_seconds(try_cast(s, "bigint"))))
    return F.when(s.isNull() | F.lower(s).isin(list(NULL_TIMESTAMP_TOKENS)), F.lit(None)) \
        .otherwise(F.coalesce(*candidates))


def sanitize_timestamp(c) -> Column:
    """N-14: anything that is not a timestamp becomes NULL."""
    c = _c(c)
    return F.try_to_timestamp(c.cast("string"))


def date_token(c, src: str = "yyyyMMdd", dst: str = "yyyy-MM-dd") -> Column:
    """I-10: reformat a date token; unparsable -> NULL."""
    return F.date_format(F.try_to_timestamp(_c(c), F.lit(src)), dst)


def shift_date(c, days: int = 15, fmt: str = "yyyy-MM-dd") -> Column:
    """F-02: add ``days`` days to ISO date text."""
    return F.date_format(F.date_add(F.to_date(F.try_to_timestamp(_c(c))), days), fmt)


def dates_from_name(c) -> tuple[Column, Column]:
    """F-03: ``date_range=YYYYMMDD[-YYYYMMDD]`` in a name -> (start, end) ISO dates; a missing end is
    ``''``; no match gives NULL for both."""
    c = _c(c)
    pattern = r"date_range=(\d{8})(?:-(\d{8}))?"
    matched = c.rlike(pattern)
    start = F.regexp_extract(c, pattern, 1)
    end = F.regexp_extract(c, pattern, 2)
    start_iso = F.when(matched, date_token(start))
    end_iso = F.when(matched, F.when(end == "", F.lit("")).otherwise(date_token(end)))
    return start_iso, end_iso
