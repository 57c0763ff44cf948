"""Column-level functions (``Column -> Column``), all built from Spark SQL built-ins."""

from adspark.functions.text import (  # noqa: F401
    MISSING_TOKENS, NON_PRINTABLE, decode_with_fallback, is_missing, normalize_column_name, normalize_text_key,
    normalize_value, null_token, sanitize_string, truncate_with_ellipsis, url_key_decode,
)
from adspark.functions.numbers import (  # noqa: F401
    explicit_price_override, list_price, map_floor, override_map_floor, round_money, sanitize_number,
    target_price, to_double, to_long,
)
from adspark.functions.dates import (  # noqa: F401
    date_token, dates_from_name, parse_timestamp, sanitize_timestamp, shift_date,
)
from adspark.functions.marketplace import MARKETPLACES, country_to_marketplace  # noqa: F401
