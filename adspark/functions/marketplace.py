"""I-11: country code to marketplace id."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from adspark.functions.text import _c

# Country code -> marketplace id, as configured for the ingested reports.
MARKETPLACES = {
    "CA": "A2EUQ1WTGCTBG2",
    "US": "ATVPDKIKX0DER",
    "MX": "A1AM78C64UM0Y8",
    "BR": "A2Q3Y263D00KWC",
    "ES": "A1RKKUPIHCS9HS",
    "UK": "A1F83G8C2ARO7P",
    "FR": "A13V1IB3VIYZZH",
    "NL": "A1805IZSGTT6HS",
    "DE": "A1PA6795UKMFR9",
    "IT": "APJ6JRA9NG5V4",
    "SE": "A2NODRKZP88ZB9",
    "PL": "A1C3SOZRARQ6R3",
    "EG": "ARBP9OOSHTCHU",
    "TR": "A33AVAJ2PDY3EV",
    "AE": "A2VIGQ35RCS4UG",
    "IN": "A21TJRUUN4KGV",
    "SG": "A19VAU5U5O7RUS",
    "AU": "A39IBJ37TRP1C6",
    "JP": "A1VC38T7YXB528",
}


def country_to_marketplace(c, mapping: dict | None = None) -> Column:
    """Known country -> marketplace id; unknown values pass through unchanged."""
    mapping = MARKETPLACES if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    c = _c(c)
    return F.coalesce(F.try_element_at(m, c), c)
