"""Projection, filter and normalisation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.functions.dates import parse_timestamp
from adspark.functions.marketplace import country_to_marketplace
from adspark.functions.numbers import to_double, to_long
from adspark.functions.text import MISSING_TOKENS, normalize_column_name, null_token, try_cast
from adspark.specs import SPARK_TYPES, TableSpec

# Tables whose missing ``date`` is taken from the start date of the file path.
DEFAULT_DATE_TABLES = {("SB", "campaign_v2")}


def null_tokens(df: DataFrame, *, cols=None, tokens=MISSING_TOKENS) -> DataFrame:
    """I-06: every missing token in the (string) columns becomes NULL, once, at the source."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_token(F.col(f"`{c}`"), tokens) for c in cols})


def normalize_columns(df: DataFrame) -> DataFrame:
    """N-01: rename every column by the name rules; two names colliding after normalising fail."""
    mapping = {c: normalize_column_name(c) for c in df.columns}
    targets = list(mapping.values())
    dup = sorted({t for t in targets if targets.count(t) > 1})
    if dup:
        raise ValueError(f"column names collide after normalising: {dup}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def stamp_columns(df: DataFrame, *, kind: str, ad_type: str, now: Column,
                  country: Column | None = None, profile: Column | None = None) -> DataFrame:
    """N-02: add ``marketplace`` (reports only), ``last_updated`` and ``profileId`` (``advertiserId``
    for DSP) from the path metadata; same-named input columns are overwritten."""
    country = F.col("_country") if country is None else country
    profile = F.col("_profile_id") if profile is None else profile
    cols = {"last_updated": now}
    if kind == "report":
        cols["marketplace"] = country_to_marketplace(country)
    cols["advertiserId" if ad_type == "DSP" else "profileId"] = profile
    return df.withColumns(cols)


def _string_value(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def cast_column(c: Column, dtype: T.DataType, config_type: str) -> Column:
    """N-03 for one column: typed value with the per-type default of SURVEY section 1."""
    if config_type == "INT64":
        if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
        return F.coalesce(to_long(c), F.lit(0).cast("bigint"))
    if config_type == "FLOAT64":
        return F.coalesce(to_double(c), F.lit(0.0))
    if config_type == "STRING":
        return F.coalesce(_string_value(c, dtype), F.lit(""))
    if config_type == "TIMESTAMP":
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return c.cast("timestamp")
        if isinstance(dtype, T.DateType):
            return c.cast("timestamp")
        return parse_timestamp(c)
    if config_type == "BOOLEAN":
        if isinstance(dtype, T.BooleanType):
            return c
        return try_cast(F.lower(F.trim(c.cast("string"))), "boolean")
    return _string_value(c, dtype)


def bad_value(c: Column, dtype: T.DataType, config_type: str) -> Column:
    """True where a non-blank input value could not be cast (it is replaced by the default)."""
    text = F.trim(c.cast("string")) if not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) \
        else F.lit(None).cast("string")
    present = text.isNotNull() & ~F.lower(text).isin("", "nan", "null", "none")
    if config_type == "INT64":
        return present & to_long(c).isNull()
    if config_type == "FLOAT64":
        return present & to_double(c).isNull()
    if config_type == "TIMESTAMP" and not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return present & parse_timestamp(c).isNull()
    return F.lit(False)


def cast_to_schema(df: DataFrame, spec, *, fail_fast: bool = False, add_missing: bool = False):
    """N-03: cast every schema column present in ``df`` to its type with the type default.

    ``spec`` is a TableSpec or a list of ``(name, config_type)``. Returns ``(typed, rejects)``:
    ``rejects`` is a lazy one-row-per-column count of non-blank values that failed to cast (D2).
    With ``fail_fast`` any rejected value raises (this runs one aggregation).
    """
    columns = spec.columns if isinstance(spec, TableSpec) else tuple(spec)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    out, bad = [], []
    for name, ctype in columns:
        if name in dtypes:
            c = F.col(f"`{name}`")
            out.append(cast_column(c, dtypes[name], ctype).alias(name))
            bad.append((name, bad_value(c, dtypes[name], ctype)))
        elif add_missing:
            out.append(F.lit(None).cast(SPARK_TYPES.get(ctype, T.StringType())).alias(name))
    extra = [F.col(f"`{c}`") for c in df.columns if c.startswith("_") and c not in dict(columns)]
    typed = df.select(*out, *extra)
    if bad:
        counts = df.agg(*[F.count_if(b).alias(n) for n, b in bad])
        stack = ", ".join(f"'{n}', `{n}`" for n, _ in bad)
        rejects = counts.selectExpr(f"stack({len(bad)}, {stack}) AS (column, rejected)") \
            .filter("rejected > 0")
    else:
        rejects = df.sparkSession.createDataFrame([], "column string, rejected bigint")
    if fail_fast and rejects.limit(1).count() > 0:
        raise ValueError("values failed to cast: " + ", ".join(r["column"] for r in rejects.collect()))
    return typed, rejects


def drop_unknown_columns(df: DataFrame, spec) -> tuple[DataFrame, list[str]]:
    """N-05: keep schema columns (and ``_``-prefixed metadata), return the dropped names."""
    names = spec.column_names if isinstance(spec, TableSpec) else [c for c, _ in spec]
    keep = [c for c in df.columns if c in names or c.startswith("_")]
    dropped = [c for c in df.columns if c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in keep]), dropped


def default_report_date(df: DataFrame, spec: TableSpec, start: Column, *, force: bool = False) -> DataFrame:
    """N-06: for the configured tables a missing ``date`` is the path start date."""
    if not force and (spec.ad_type, spec.name) not in DEFAULT_DATE_TABLES:
        return df
    if "date" in df.columns:
        return df.withColumn("date", F.coalesce(F.col("date").cast("string"), start))
    return df.withColumn("date", start)


def _field(df: DataFrame, parent: str, field: str) -> Column:
    """Field of a nested input column given as struct or as raw JSON text."""
    dtype = df.schema[parent].dataType
    if isinstance(dtype, T.StructType):
        if field in dtype.fieldNames():
            return F.col(f"`{parent}`.`{field}`")
        return F.lit(None)
    if isinstance(dtype, T.MapType):
        return F.col(f"`{parent}`")[field]
    return F.get_json_object(F.col(f"`{parent}`").cast("string"), f"$.{field}")


def flatten_extended_data(df: DataFrame) -> DataFrame:
    """N-07: ``extendedData`` fields to columns; ``servingStatusDetails`` as JSON text."""
    if "extendedData" not in df.columns:
        return df
    details = _field(df, "extendedData", "servingStatusDetails")
    dtype = df.schema["extendedData"].dataType
    if isinstance(dtype, T.StructType) and "servingStatusDetails" in dtype.fieldNames():
        sub = dtype["servingStatusDetails"].dataType
        if isinstance(sub, (T.StructType, T.ArrayType, T.MapType)):
            details = F.to_json(details)
    return df.withColumns({
        "creationDateTime": _field(df, "extendedData", "creationDateTime").cast("string"),
        "lastUpdateDateTime": _field(df, "extendedData", "lastUpdateDateTime").cast("string"),
        "servingStatus": _field(df, "extendedData", "servingStatus").cast("string"),
        "servingStatusDetails": details.cast("string"),
    }).drop("extendedData")


def flatten_campaign_budget(df: DataFrame) -> DataFrame:
    """N-08: ``budget`` object -> ``budget`` (double) and ``budgetType``; a scalar budget is kept
    and an existing ``budgetType`` stays (D4)."""
    if "budget" not in df.columns:
        return df
    dtype = df.schema["budget"].dataType
    existing_type = F.col("budgetType").cast("string") if "budgetType" in df.columns else F.lit(None).cast("string")
    if isinstance(dtype, T.StructType):
        return df.withColumns({
            "budgetType": F.coalesce(_field(df, "budget", "budgetType").cast("string"), existing_type),
            "budget": to_double(_field(df, "budget", "budget")),
        })
    if isinstance(dtype, (T.NumericType,)):
        return df.withColumns({"budget": F.col("budget").cast("double"), "budgetType": existing_type})
    text = F.trim(F.col("budget").cast("string"))
    is_obj = text.startswith("{")
    return df.withColumns({
        "budgetType": F.when(is_obj, F.coalesce(F.get_json_object(text, "$.budgetType"), existing_type))
        .otherwise(existing_type),
        "budget": F.when(is_obj, to_double(F.get_json_object(text, "$.budget"))).otherwise(to_double(text)),
    })


def flatten_portfolio_budget(df: DataFrame) -> DataFrame:
    """N-09: ``policy`` and ``currencyCode`` from the portfolio ``budget``, which is then dropped."""
    if "budget" not in df.columns:
        return df
    return df.withColumns({
        "policy": _field(df, "budget", "policy").cast("string"),
        "currencyCode": _field(df, "budget", "currencyCode").cast("string"),
    }).drop("budget")


def stringify_nested(df: DataFrame, spec) -> DataFrame:
    """N-10: for STRING targets, arrays / structs / maps become JSON text, scalars stay."""
    columns = spec.columns if isinstance(spec, TableSpec) else tuple(spec)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    change = {}
    for name, ctype in columns:
        if ctype == "STRING" and name in dtypes:
            if isinstance(dtypes[name], (T.StructType, T.ArrayType, T.MapType)):
                change[name] = F.to_json(F.col(f"`{name}`"))
    return df.withColumns(change) if change else df


def filter_identifier(df: DataFrame, col: str, *, bad=("NOTAVAILABLE",)) -> DataFrame:
    """N-16: drop rows whose identifier is NULL (no lookup match), blank or a bad token."""
    c = F.col(f"`{col}`")
    return df.filter(c.isNotNull() & (F.trim(c) != "") & ~c.isin(list(bad)))


def filter_push_flag(df: DataFrame, col: str, *, off: str = "No") -> DataFrame:
    """N-17: drop rows whose flag equals ``off``; a missing flag is kept (null-safe)."""
    return df.filter(~F.col(f"`{col}`").eqNullSafe(off))
