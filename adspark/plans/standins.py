"""Every operator of the survey exercised on the driver tables, each with its DuckDB oracle SQL.

The driver tables (TPC-H-like orders / part / lineitem / customer / supplier plus events, pages and
documents) stand in for the advertising and catalog tables: orders play report rows and change
history, part plays seller products, lineitem plays overrides, events play feed issues. Each
query reads whole tables; branching on values (order priority, part type, event type, ...) makes
the edge rows of FIXTURES section 1.4. Every stand-in returns a DataFrame; the oracle SQL
returns the same columns (names and types) on DuckDB.

Clock and batch values are fixed literals so results are deterministic.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspark.functions import (country_to_marketplace, date_token, dates_from_name, decode_with_fallback,
                               explicit_price_override, list_price, map_floor, normalize_text_key,
                               normalize_value, override_map_floor, parse_timestamp, sanitize_number,
                               sanitize_string, sanitize_timestamp, shift_date, target_price, to_double,
                               truncate_with_ellipsis)
from adspark.functions.marketplace import MARKETPLACES
from adspark.operators import aggregates as A
from adspark.operators import catalog_tables as CT
from adspark.operators import changes as K
from adspark.operators import feed as FD
from adspark.operators import joins as J
from adspark.operators import load as L
from adspark.operators import normalize as N
from adspark.operators import pricing as P
from adspark.operators.dates import date_range_list
from adspark.operators.evolution import evolve_table
from adspark.session import ensure_checkpoint_dir, kept_table, scratch_dir
from adspark.sources import files as SRC
from adspark.sources.paths import path_metadata
from adspark.sources.tables import read_table_all_strings
from adspark.specs import TableSpec, get_spec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

NOW = "2001-06-01 00:00:00"
BATCH_ID = "20010601000000"
MISSING_SQL = "('', 'nan', 'NULL', 'None')"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps to wall-clock timestamps (UTC session), as DuckDB TIMESTAMP."""
    change = {f.name: F.col(f"`{f.name}`").cast("timestamp_ntz") for f in df.schema.fields
              if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(change) if change else df


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) IN {MISSING_SQL})"


# ---------------------------------------------------------------------------------------------
# Loads (L-*) on orders: target = older orders, stage = recent orders with a changed price
# ---------------------------------------------------------------------------------------------

def _upsert_frames(spark, sf):
    o = _t(spark, sf, "orders")
    target = o.filter(F.col("o_orderdate") < _ts("1999-01-01"))
    stage = o.filter(F.col("o_orderdate") >= _ts("1998-01-01")) \
        .withColumn("o_totalprice", F.col("o_totalprice") + 10)
    return target, stage


_UPSERT_CTE = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 10 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""

_UPSERT_SQL = _UPSERT_CTE + """
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
"""


@query("merge_upsert", _UPSERT_SQL)
def q_merge_upsert(spark, sf):
    target, stage = _upsert_frames(spark, sf)
    return L.merge_upsert(target, stage, ["o_orderkey"])


@query("merge_upsert_subset", """
WITH s AS (SELECT *, o_orderpriority IN ('1-URGENT', '2-HIGH') AS priced FROM orders WHERE o_orderstatus <> 'P')
SELECT t.o_orderkey, t.o_custkey, CASE WHEN s.o_orderkey IS NULL OR s.priced THEN t.o_orderstatus ELSE 'X' END AS o_orderstatus,
  CASE WHEN s.priced THEN t.o_totalprice + 1 ELSE t.o_totalprice END AS o_totalprice, t.o_orderdate, t.o_orderpriority
FROM orders t LEFT JOIN s ON s.o_orderkey = t.o_orderkey
WHERE t.o_orderpriority <> '5-LOW'
UNION ALL
SELECT o_orderkey, o_custkey, 'X', 0, o_orderdate, o_orderpriority FROM s WHERE o_orderpriority = '5-LOW'
""")
def q_merge_upsert_subset(spark, sf):
    """Orders that are not pending are delivered again, some with a new price only, some with a new
    status only; those of low priority are new."""
    o = _t(spark, sf, "orders")
    target = o.filter("o_orderpriority <> '5-LOW'")
    again = o.filter("o_orderstatus <> 'P'").withColumn("_order", F.col("o_orderdate"))
    priced = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    prices = again.filter(priced).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit(""), "_present": F.array(F.lit("o_orderkey"), F.lit("o_totalprice"))})
    states = again.filter(~priced).withColumns({"o_totalprice": F.lit(0).cast(o.schema["o_totalprice"].dataType), "o_orderstatus": F.lit("X"), "_present": F.array(F.lit("o_orderkey"), F.lit("o_orderstatus"))})
    return L.merge_upsert_subset(target, prices.unionByName(states), ["o_orderkey"])


@query("delete_insert", """
WITH s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01')
SELECT * FROM orders t WHERE NOT EXISTS
  (SELECT 1 FROM s WHERE s.o_custkey = t.o_custkey AND s.o_orderdate = t.o_orderdate)
UNION ALL SELECT * FROM s
""")
def q_delete_insert(spark, sf):
    o = _t(spark, sf, "orders")
    stage = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= _ts("2000-01-01"))) \
        .withColumn("o_orderstatus", F.lit("X"))
    return L.delete_insert(o, stage, ["o_custkey", "o_orderdate"])


@query("append_rows", """
SELECT * FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT * FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'
""")
def q_append_rows(spark, sf):
    c = _t(spark, sf, "customer")
    return L.append_rows(c.filter("c_acctbal >= 0"), c.filter("c_acctbal < 0 OR c_mktsegment = 'BUILDING'"))


@query("append_evolving", """
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0
""")
def q_append_evolving(spark, sf):
    c = _t(spark, sf, "customer")
    return L.append_evolving(c.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_nationkey"),
                             c.filter("c_acctbal < 0").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@query("merge_delete_missing", _UPSERT_CTE + """
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM s WHERE s.o_custkey = t.o_custkey)
UNION ALL SELECT * FROM s
""")
def q_merge_delete_missing(spark, sf):
    target, stage = _upsert_frames(spark, sf)
    return L.merge_delete_missing(target, stage, ["o_orderkey"], scope=["o_custkey"])


@query("assert_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_assert_unique_key(spark, sf):
    return L.assert_unique_key(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_stage", "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)")
def q_distinct_stage(spark, sf):
    o = _t(spark, sf, "orders")
    return A.distinct_stage(o.unionByName(o))


# ---------------------------------------------------------------------------------------------
# Normalisation (N-*) and sources (I-*)
# ---------------------------------------------------------------------------------------------

@query("cast_to_schema", """
SELECT event_id,
  CASE WHEN event_type IN ('view', 'error') THEN CAST(0 AS BIGINT)
       ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS qty,
  CASE WHEN event_type = 'view' THEN CAST(0 AS DOUBLE)
       ELSE CAST(json_extract_string(props, '$.k') || '.25' AS DOUBLE) END AS amount,
  CASE WHEN event_type = 'click' THEN NULL ELSE date_trunc('second', ts) END AS ts,
  CASE WHEN event_type = 'purchase' THEN '' ELSE event_type END AS label
FROM events
""")
def q_cast_to_schema(spark, sf):
    e = _t(spark, sf, "events")
    et, k = F.col("event_type"), F.get_json_object("props", "$.k")
    raw = e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(et == "view", F.lit("")).when(et == "error", F.lit("abc"))
        .when(et == "signup", F.concat(k, F.lit(".0"))).otherwise(k).alias("qty"),
        F.when(et == "view", F.lit(None)).otherwise(F.concat(k, F.lit(".25"))).alias("amount"),
        F.when(et == "click", F.lit("none")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(et == "purchase", F.lit(None)).otherwise(et).alias("label"))
    typed, _ = N.cast_to_schema(raw, [("event_id", "INT64"), ("qty", "INT64"), ("amount", "FLOAT64"),
                                      ("ts", "TIMESTAMP"), ("label", "STRING")])
    return _ntz(typed)


@query("parse_timestamp", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '2-HIGH') THEN NULL ELSE o_orderdate END AS parsed
FROM orders
""")
def q_parse_timestamp(spark, sf):
    o = _t(spark, sf, "orders")
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (F.when(p == "5-LOW", F.lit("none")).when(p == "4-NOT SPECIFIED", F.lit(""))
            .when(p == "3-MEDIUM", F.date_format(d, "yyyyMMdd")).when(p == "2-HIGH", F.lit("NULL"))
            .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")))
    return o.select("o_orderkey", parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


@query("stringify_nested", """
SELECT c_custkey,
  CAST(to_json(struct_pack(c_name := c_name, c_nationkey := c_nationkey)) AS VARCHAR) AS info,
  CAST(to_json([c_mktsegment]) AS VARCHAR) AS tags, c_name
FROM customer
""")
def q_stringify_nested(spark, sf):
    c = _t(spark, sf, "customer")
    df = c.select("c_custkey", F.struct("c_name", "c_nationkey").alias("info"),
                  F.array("c_mktsegment").alias("tags"), "c_name")
    return N.stringify_nested(df, [("c_custkey", "INT64"), ("info", "STRING"), ("tags", "STRING"),
                                   ("c_name", "STRING")])


@query("flatten_extended_data", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS creationDateTime,
  strftime(ts, '%Y-%m-%d') AS lastUpdateDateTime, event_type AS servingStatus,
  CAST(to_json([event_type, CAST(user_id AS VARCHAR)]) AS VARCHAR) AS servingStatusDetails
FROM events
""")
def q_flatten_extended_data(spark, sf):
    e = _t(spark, sf, "events")
    df = e.select("event_id", F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("creationDateTime"),
        F.date_format("ts", "yyyy-MM-dd").alias("lastUpdateDateTime"),
        F.col("event_type").alias("servingStatus"),
        F.array("event_type", F.col("user_id").cast("string")).alias("servingStatusDetails")).alias("extendedData"))
    return N.flatten_extended_data(df)


@query("flatten_campaign_budget", """
SELECT c_custkey, c_acctbal AS budget,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END AS budgetType
FROM customer
""")
def q_flatten_campaign_budget(spark, sf):
    c = _t(spark, sf, "customer")
    budget = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("c_acctbal").cast("string")) \
        .otherwise(F.to_json(F.struct(F.col("c_acctbal").alias("budget"), F.col("c_mktsegment").alias("budgetType"))))
    return N.flatten_campaign_budget(c.select("c_custkey", budget.alias("budget")))


@query("flatten_portfolio_budget", """
SELECT c_custkey, c_name, c_mktsegment AS policy,
  CASE WHEN c_nationkey < 10 THEN 'USD' ELSE 'EUR' END AS currencyCode
FROM customer
""")
def q_flatten_portfolio_budget(spark, sf):
    c = _t(spark, sf, "customer")
    budget = F.struct(F.col("c_mktsegment").alias("policy"),
                      F.when(F.col("c_nationkey") < 10, F.lit("USD")).otherwise(F.lit("EUR")).alias("currencyCode"),
                      F.col("c_acctbal").alias("amount"))
    return N.flatten_portfolio_budget(c.select("c_custkey", "c_name", budget.alias("budget")))


def _report_key(o: DataFrame) -> Column:
    st, pr, d = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    ad = F.when(st == "F", "SP").when(st == "O", "SB").otherwise("SD")
    rtype = F.when(pr == "1-URGENT", "campaign__daily_sum").when(pr == "2-HIGH", "keyword__x").otherwise("adgroup")
    country = F.when(F.col("o_totalprice") > 250000, "US").otherwise("DE")
    dates = F.concat(F.date_format(d, "yyyyMMdd"), F.lit("-"), F.date_format(F.date_add(d, 6), "yyyyMMdd"))
    return F.concat_ws("/", F.lit("bucket"), F.lit("reports"), ad, rtype, country, F.col("o_custkey").cast("string"),
                       F.col("o_orderkey").cast("string"), dates, F.lit("report.json.gz"))


@query("path_metadata", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'SP' WHEN 'O' THEN 'SB' ELSE 'SD' END AS ad_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'campaign' WHEN '2-HIGH' THEN 'keyword' ELSE 'adgroup' END AS report_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'daily,sum' WHEN '2-HIGH' THEN 'x' ELSE '' END AS report_options,
  CASE WHEN o_totalprice > 250000 THEN 'US' ELSE 'DE' END AS country,
  CAST(o_custkey AS VARCHAR) AS client_id, CAST(o_orderkey AS VARCHAR) AS profile_id,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date, strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d') AS end_date
FROM orders
""")
def q_path_metadata(spark, sf):
    o = _t(spark, sf, "orders")
    m = path_metadata(o.select("o_orderkey", _report_key(o).alias("_file")), kind="report")
    return m.select("o_orderkey", F.col("_ad_type").alias("ad_type"), F.col("_report_type").alias("report_type"),
                    F.array_join("_report_options", ",").alias("report_options"), F.col("_country").alias("country"),
                    F.col("_client_id").alias("client_id"), F.col("_profile_id").alias("profile_id"),
                    F.col("_start_date").alias("start_date"), F.col("_end_date").alias("end_date"))


@query("path_metadata_entity", """
SELECT c_custkey,
  CASE WHEN c_acctbal < 0 THEN 'SD' ELSE 'SP' END AS ad_type, lower(c_mktsegment) AS entity_type,
  CASE WHEN c_nationkey < 12 THEN 'US' ELSE 'UK' END AS country,
  CAST(c_nationkey AS VARCHAR) AS client_id, CAST(c_custkey AS VARCHAR) AS profile_id
FROM customer
""")
def q_path_metadata_entity(spark, sf):
    c = _t(spark, sf, "customer")
    key = F.concat_ws("/", F.lit("root"), F.lit("x"), F.lit("entities"),
                      F.when(F.col("c_acctbal") < 0, "SD").otherwise("SP"), F.lower("c_mktsegment"),
                      F.when(F.col("c_nationkey") < 12, "US").otherwise("UK"), F.col("c_nationkey").cast("string"),
                      F.col("c_custkey").cast("string"), F.lit("entity.json.gz"))
    m = path_metadata(c.select("c_custkey", key.alias("_file")), kind="entity")
    return m.select("c_custkey", F.col("_ad_type").alias("ad_type"), F.col("_report_type").alias("entity_type"),
                    F.col("_country").alias("country"), F.col("_client_id").alias("client_id"),
                    F.col("_profile_id").alias("profile_id"))


@query("object_key_decode", "SELECT page_id, url || ' ' || CAST(page_id AS VARCHAR) AS key FROM pages")
def q_object_key_decode(spark, sf):
    from adspark.sources.paths import object_key_decode
    p = _t(spark, sf, "pages")
    ev = p.select("page_id", F.concat(F.replace("url", F.lit("/"), F.lit("%2F")), F.lit("+"),
                                      F.col("page_id").cast("string")).alias("key"))
    return object_key_decode(ev)


# 25 country codes indexed by nation key (19 configured, 6 unknown).
_COUNTRY_CODES = ["CA", "US", "MX", "BR", "ES", "UK", "FR", "NL", "DE", "IT", "SE", "PL", "EG", "TR", "AE",
                  "IN", "SG", "AU", "JP", "ZZ", "GB", "us", "XX", "QQ", "NA"]


def _marketplace_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MARKETPLACES.items())
    return f"CASE {col} {whens} ELSE {col} END"


@query("country_to_marketplace", f"""
WITH c AS (SELECT c_custkey, ([{", ".join(repr(x) for x in _COUNTRY_CODES)}])[c_nationkey + 1] AS country FROM customer)
SELECT c_custkey, country, {_marketplace_case('country')} AS marketplace FROM c
""")
def q_country_to_marketplace(spark, sf):
    c = _t(spark, sf, "customer")
    codes = F.array(*[F.lit(x) for x in _COUNTRY_CODES])
    df = c.select("c_custkey", F.element_at(codes, F.col("c_nationkey") + 1).alias("country"))
    return df.withColumn("marketplace", country_to_marketplace("country"))


_NORM_VALUE_SRC = """CASE WHEN p_size > 25 THEN p_name || ' (' || p_type || ')'
    ELSE '[' || p_brand || '] ' || p_name || '-' || p_type || ' ( {x}?, a.b/c ) ' END"""


@query("normalize_value", f"""
WITH v AS (SELECT p_partkey, {_NORM_VALUE_SRC} AS raw FROM part)
SELECT p_partkey, raw, regexp_replace(regexp_replace(regexp_replace(
  replace(replace(replace(replace(raw, ' (', '('), '( ', '('), ' )', ')'), ') ', ')'),
  '\\)$', ''), '[\\s\\-()\\[\\]{{}}?]', '_', 'g'), '[,./]', '', 'g') AS normalized
FROM v
""")
def q_normalize_value(spark, sf):
    p = _t(spark, sf, "part")
    raw = F.when(F.col("p_size") > 25, F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))) \
        .otherwise(F.concat(F.lit("["), "p_brand", F.lit("] "), "p_name", F.lit("-"), "p_type", F.lit(" ( {x}?, a.b/c ) ")))
    return p.select("p_partkey", raw.alias("raw")).withColumn("normalized", normalize_value("raw"))


@query("sanitize_string", """
SELECT doc_id, substring(regexp_replace(text, '[\\p{C}\\p{Zl}\\p{Zp}]|[^\\P{Zs} ]', '', 'g'), 1, 255) AS clean
FROM documents
""")
def q_sanitize_string(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", sanitize_string("text", 255).alias("clean"))


@query("truncate_with_ellipsis", """
SELECT doc_id, CASE WHEN length(text) > 65535 THEN substring(text, 1, 65532) || '...' ELSE text END AS truncated
FROM documents
""")
def q_truncate_with_ellipsis(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", truncate_with_ellipsis("text", 65535).alias("truncated"))


def _asin_col():
    t = F.col("p_type")
    return (F.when(t == "SMALL", F.lit("")).when(t == "ECONOMY", F.lit("NOTAVAILABLE"))
            .when(t == "LARGE", F.lit(None)).otherwise(F.concat(F.lit("B0"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))))


@query("filter_identifier", """
SELECT p_partkey, 'B0' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS asin FROM part
WHERE p_type NOT IN ('SMALL', 'ECONOMY', 'LARGE')
""")
def q_filter_identifier(spark, sf):
    p = _t(spark, sf, "part")
    return N.filter_identifier(p.select("p_partkey", _asin_col().alias("asin")), "asin")


@query("filter_push_flag", """
WITH f AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'No' WHEN 'LARGE' THEN NULL ELSE 'Yes' END AS flag FROM part)
SELECT * FROM f WHERE flag IS DISTINCT FROM 'No'
""")
def q_filter_push_flag(spark, sf):
    p = _t(spark, sf, "part")
    t = F.col("p_type")
    flag = F.when(t == "SMALL", F.lit("No")).when(t == "LARGE", F.lit(None)).otherwise(F.lit("Yes"))
    return N.filter_push_flag(p.select("p_partkey", flag.alias("flag")), "flag")


@query("null_tokens", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') THEN NULL ELSE o_orderstatus END AS a,
  o_orderstatus AS b
FROM orders
""")
def q_null_tokens(spark, sf):
    o = _t(spark, sf, "orders")
    p = F.col("o_orderpriority")
    a = (F.when(p == "1-URGENT", F.lit("")).when(p == "2-HIGH", F.lit("nan")).when(p == "3-MEDIUM", F.lit("NULL"))
         .when(p == "4-NOT SPECIFIED", F.lit(" None ")).otherwise(F.col("o_orderstatus")))
    return N.null_tokens(o.select("o_orderkey", a.alias("a"), F.col("o_orderstatus").alias("b")))


@query("sanitize_number", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL ELSE o_totalprice END AS n
FROM orders
""")
def q_sanitize_number(spark, sf):
    o = _t(spark, sf, "orders")
    p = F.col("o_orderpriority")
    text = (F.when(p == "1-URGENT", F.lit("")).when(p == "2-HIGH", F.lit("nan")).when(p == "3-MEDIUM", F.lit("abc"))
            .otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", sanitize_number(text).alias("n"))


@query("sanitize_timestamp", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS ts FROM orders
""")
def q_sanitize_timestamp(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("x")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", sanitize_timestamp(text).cast("timestamp_ntz").alias("ts"))


@query("normalize_text_key", "SELECT c_custkey, lower(c_mktsegment) AS key FROM customer")
def q_normalize_text_key(spark, sf):
    c = _t(spark, sf, "customer")
    raw = F.when(F.col("c_nationkey") < 10, F.concat(F.lit("  "), F.upper("c_mktsegment"), F.lit(" "))) \
        .otherwise(F.initcap("c_mktsegment"))
    return c.select("c_custkey", normalize_text_key(raw).alias("key"))


@query("date_token", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders
""")
def q_date_token(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("bad")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", date_token(text).alias("day"))


_SUPPLIER_TEXT_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
  CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier
"""


@query("read_table_all_strings", _SUPPLIER_TEXT_SQL)
def q_read_table_all_strings(spark, sf):
    return read_table_all_strings(spark, f"{sf.rstrip('/')}/supplier.parquet")


@query("read_csv_report", _SUPPLIER_TEXT_SQL)
def q_read_csv_report(spark, sf):
    path = _scratch(spark, "csv-report")
    _t(spark, sf, "supplier").write.option("header", True).option("compression", "gzip").csv(path)
    return SRC.read_csv_report(spark, path).drop("_file", "_mtime")


@query("read_listing_tsv", """SELECT DISTINCT s_name AS "seller-sku" FROM supplier WHERE s_nationkey <> 0""")
def q_read_listing_tsv(spark, sf):
    path = _scratch(spark, "listing")
    s = _t(spark, sf, "supplier")
    sku = F.when(F.col("s_nationkey") == 0, F.lit("")) \
        .when(F.col("s_nationkey") == 1, F.concat(F.col("s_name"), F.lit("\u0000"))).otherwise(F.col("s_name"))
    s.select(sku.alias("seller-sku"), F.col("s_acctbal").alias("price")) \
        .write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(path)
    return SRC.read_listing_tsv(spark, path)


@query("distinct_listing", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS sku FROM lineitem")
def q_distinct_listing(spark, sf):
    li = _t(spark, sf, "lineitem")
    return A.distinct_listing(li.select(F.col("l_partkey").cast("string").alias("sku")), sku="sku")


@query("row_count", """
SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_row_count(spark, sf):
    return A.row_count(_t(spark, sf, "lineitem"), by=("l_returnflag", "l_linestatus"))


@query("stamp_columns", f"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ATVPDKIKX0DER' WHEN 'O' THEN 'A1PA6795UKMFR9' ELSE 'XX' END AS marketplace,
  CAST(o_custkey AS VARCHAR) AS profileId, TIMESTAMP '{NOW}' AS last_updated
FROM orders
""")
def q_stamp_columns(spark, sf):
    o = _t(spark, sf, "orders")
    st = F.col("o_orderstatus")
    df = o.select("o_orderkey", F.when(st == "F", "US").when(st == "O", "DE").otherwise("XX").alias("_country"),
                  F.col("o_custkey").cast("string").alias("_profile_id"))
    out = N.stamp_columns(df, kind="report", ad_type="SP", now=_now())
    return out.select("o_orderkey", "marketplace", "profileId", "last_updated")


@query("drop_unknown_columns", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def q_drop_unknown_columns(spark, sf):
    df, _ = N.drop_unknown_columns(_t(spark, sf, "orders"), [("o_orderkey", "INT64"), ("o_totalprice", "FLOAT64"),
                                                             ("o_orderdate", "TIMESTAMP"), ("absent", "STRING")])
    return df


@query("normalize_columns", """
SELECT p_partkey AS Part_Key, p_name AS Name_text, p_brand AS brand_name, p_retailprice AS Price_USD,
  p_size AS size__cm_ FROM part
""")
def q_normalize_columns(spark, sf):
    p = _t(spark, sf, "part")
    df = p.select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Name (text)"),
                  F.col("p_brand").alias("brand-name"), F.col("p_retailprice").alias("Price (USD) "),
                  F.col("p_size").alias("size [cm]"))
    return N.normalize_columns(df)


_CAMPAIGN_V2 = TableSpec("report", "SB", "campaign_v2", "ads_sb", "reports_campaign_v2", "date", (), (),
                         "merge", (), (("date", "TIMESTAMP"),))


@query("default_report_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '2024-03-20' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date
FROM orders
""")
def q_default_report_date(spark, sf):
    o = _t(spark, sf, "orders")
    df = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None))
                  .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))
    return N.default_report_date(df, _CAMPAIGN_V2, F.lit("2024-03-20"))


@query("select_load_columns", """
SELECT o_orderkey AS campaignId, CAST(o_custkey AS VARCHAR) AS profileId, o_orderdate AS date, o_totalprice AS cost
FROM orders
""")
def q_select_load_columns(spark, sf):
    o = _t(spark, sf, "orders")
    df = o.select(F.col("o_orderkey").alias("campaignId"), F.lit(1).alias("id"),
                  F.col("o_custkey").cast("string").alias("profileId"), "o_orderstatus",
                  F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("cost"))
    return L.select_load_columns(df, get_spec("report", "SP", "campaign"))


@query("add_missing_columns", """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS TIMESTAMP) AS seen FROM orders
""")
def q_add_missing_columns(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = L.add_missing_columns(o, [("o_orderkey", "INT64"), ("o_totalprice", "FLOAT64"), ("note", "STRING"),
                                    ("seen", "TIMESTAMP")])
    return _ntz(out)


@query("file_format_gate", """
WITH f AS (SELECT '/data/' || CAST(page_id AS VARCHAR) ||
  CASE WHEN url LIKE 'https%' THEN '.json.gz' WHEN url LIKE '%#top' THEN '.CSV' WHEN url LIKE '%?%' THEN '.txt'
       ELSE '.json' END AS path FROM pages)
SELECT path, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS extension,
  CASE WHEN lower(regexp_extract(path, '(\\.[^./]+)$', 1)) IN ('.gz', '.json', '.csv') THEN 'ACCEPTED'
       ELSE 'INPUT_FORMAT_UNSUPPORTED' END AS status
FROM f
""")
def q_file_format_gate(spark, sf):
    p = _t(spark, sf, "pages")
    u = F.col("url")
    ext = (F.when(u.startswith("https"), ".json.gz").when(u.endswith("#top"), ".CSV")
           .when(u.contains("?"), ".txt").otherwise(".json"))
    files = p.select(F.concat(F.lit("/data/"), F.col("page_id").cast("string"), ext).alias("path"))
    ok, bad = SRC.file_format_gate(files)
    return ok.withColumn("status", F.lit("ACCEPTED")).unionByName(bad)


@query("header_gate", """
WITH h AS (SELECT page_id, regexp_replace(split_part(html, chr(10), 1), chr(13) || '$', '') AS line FROM pages)
SELECT page_id,
  CASE WHEN trim(line) = '' THEN 'empty'
       WHEN list_contains(string_split(line, ','), 'Error') THEN 'error_column'
       WHEN contains(lower(regexp_replace(line, '\\s', '', 'g')), '<html>') THEN 'html'
       ELSE 'valid' END AS verdict
FROM h
""")
def q_header_gate(spark, sf):
    p = _t(spark, sf, "pages")
    first = F.regexp_replace(F.substring_index("html", "\n", 1), "\r$", "")
    headers = p.select("page_id", F.when(F.trim(first) == "", F.array().cast("array<string>"))
                       .otherwise(F.split(first, ",")).alias("columns"))
    return SRC.header_gate(headers, path="page_id")


def _orders_text(o: DataFrame) -> DataFrame:
    return o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])


_ORDERS_SPEC = [("o_orderkey", "INT64"), ("o_custkey", "INT64"), ("o_orderstatus", "STRING"),
                ("o_totalprice", "FLOAT64"), ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "STRING")]


def write_json_array_files(df: DataFrame, path: str, *, files: int = 8) -> None:
    """Write ``df`` as JSON-array files (the report file format): ``files`` of them, or as many as
    keep each at ROWS_PER_FILE rows."""
    from adspark.streaming import ingest
    parts = df.repartition(max(files, -(-df.count() // ingest.ROWS_PER_FILE)))
    docs = parts.groupBy(F.spark_partition_id().alias("_part")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*df.columns))), ","), F.lit("]")).alias("value"))
    # One folder per array, so every file holds exactly one JSON array.
    docs.write.mode("overwrite").option("compression", "gzip").partitionBy("_part").text(path)


@query("read_json_report", "SELECT * FROM orders")
def q_read_json_report(spark, sf):
    path = _scratch(spark, "json-report")
    write_json_array_files(_t(spark, sf, "orders"), path)
    raw = SRC.read_json_report(spark, path, T.StructType([T.StructField(c, T.StringType()) for c, _ in _ORDERS_SPEC]))
    typed, _ = N.cast_to_schema(raw.drop("_file", "_mtime"), _ORDERS_SPEC)
    return _ntz(typed.drop("_file", "_mtime"))


@query("decode_with_fallback", """
WITH d AS (SELECT doc_id, lang, text, CASE WHEN lang = 'fr' THEN hex(encode(text)) || 'E9' END AS h FROM documents)
SELECT doc_id, CASE WHEN lang = 'fr'
  THEN array_to_string(list_transform(range(0, length(h), 2),
                                      lambda i: chr(CAST(('0x' || substr(h, i + 1, 2)) AS INTEGER))), '')
  ELSE text END AS decoded
FROM d
""")
def q_decode_with_fallback(spark, sf):
    """I-02: French documents get an invalid trailing byte, so the whole file falls back to latin1
    (each UTF-8 byte becomes one character); the others are valid UTF-8 and stay as they are."""
    d = _t(spark, sf, "documents")
    raw = F.when(F.col("lang") == "fr", F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("E9")))) \
        .otherwise(F.encode("text", "UTF-8"))
    return d.select("doc_id", decode_with_fallback(raw).alias("decoded"))


# ---------------------------------------------------------------------------------------------
# Joins (J-*), set operations (S-*)
# ---------------------------------------------------------------------------------------------

@query("join_identifiers", """
WITH ids AS (SELECT p_partkey AS sku, p_name, p_brand FROM part
             UNION ALL SELECT p_partkey AS sku, p_name, p_brand FROM part WHERE p_size > 45)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS sku, ids.p_name, ids.p_brand
FROM lineitem l LEFT JOIN ids ON ids.sku = l.l_partkey
""")
def q_join_identifiers(spark, sf):
    p = _t(spark, sf, "part").select(F.col("p_partkey").alias("sku"), "p_name", "p_brand", "p_size")
    ids = p.drop("p_size").unionByName(p.filter("p_size > 45").drop("p_size"))
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"))
    return J.join_identifiers(li, ids, "sku")


@query("join_new_columns", """
SELECT o.o_orderkey, o.o_custkey AS c_custkey, 'order-' || CAST(o.o_orderkey AS VARCHAR) AS c_name,
  c.c_nationkey, c.c_acctbal, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q_join_new_columns(spark, sf):
    o = _t(spark, sf, "orders")
    left = o.select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                    F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("c_name"))
    return J.join_new_columns(left, _t(spark, sf, "customer"), "c_custkey")


@query("lookup_by_keys", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def q_lookup_by_keys(spark, sf):
    keys = _t(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return J.lookup_by_keys(_t(spark, sf, "customer"), keys, "c_custkey", cols=["c_name", "c_acctbal"])


@query("skus_to_delete", """
SELECT p_partkey AS sku FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)
""")
def q_skus_to_delete(spark, sf):
    live = _t(spark, sf, "part").select(F.col("p_partkey").alias("sku"))
    products = _t(spark, sf, "lineitem").filter("l_quantity >= 45").select(F.col("l_partkey").alias("sku"))
    return J.skus_to_delete(live, products, "sku", max_share=0.5)


@query("retain_valid_history", """
SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)
""")
def q_retain_valid_history(spark, sf):
    valid = _t(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.retain_valid_history(_t(spark, sf, "orders"), valid, "o_custkey")


@query("issues_to_messages", """
SELECT e.event_id AS messageId, e.event_type, 'S' || CAST(o.o_orderkey AS VARCHAR) AS sku, 'B' AS batch_id
FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id
""")
def q_issues_to_messages(spark, sf):
    res = _t(spark, sf, "events").select(F.lit("B").alias("batch_id"), F.col("event_id").alias("messageId"), "event_type")
    msgs = _t(spark, sf, "orders").select(F.lit("B").alias("batch_id"), F.col("o_orderkey").alias("messageId"),
                                          F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("sku"))
    return J.issues_to_messages(res, msgs, ("batch_id", "messageId"))


@query("union_changes", """
SELECT * FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'F'
""")
def q_union_changes(spark, sf):
    o = _t(spark, sf, "orders")
    return J.union_changes(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'").drop("o_orderpriority"))


@query("sku_difference", """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderkey = o.o_orderkey AND b.o_totalprice > 100000)
""")
def q_sku_difference(spark, sf):
    o = _t(spark, sf, "orders")
    return J.sku_difference(o, o.filter("o_totalprice > 100000"), "o_orderkey")


@query("eligible_sellers", """
WITH u AS (SELECT c_custkey AS id FROM customer WHERE NOT (c_mktsegment = 'AUTOMOBILE')),
oa AS (SELECT o_custkey AS id, max(CASE WHEN o_orderstatus = 'F' THEN 'tok' END) AS access_token,
              max(CASE WHEN o_orderpriority = '1-URGENT' THEN 'ref' END) AS refresh_token FROM orders GROUP BY o_custkey),
o2 AS (SELECT id, (access_token IS NOT NULL AND trim(access_token) <> '') AS has_access_token,
              (refresh_token IS NOT NULL AND trim(refresh_token) <> '') AS has_refresh_token FROM oa),
ch AS (SELECT DISTINCT user_id AS id, 'SP' || CAST(user_id AS VARCHAR) AS selling_partner_id FROM events),
j AS (SELECT u.id, o2.has_access_token, o2.has_refresh_token, ch.selling_partner_id
      FROM u LEFT JOIN o2 ON o2.id = u.id LEFT JOIN ch ON ch.id = u.id)
SELECT *, (selling_partner_id IS NOT NULL AND COALESCE(has_access_token, false) AND COALESCE(has_refresh_token, false)) AS complete
FROM j
""")
def q_eligible_sellers(spark, sf):
    c, o, e = _t(spark, sf, "customer"), _t(spark, sf, "orders"), _t(spark, sf, "events")
    users = c.select(F.col("c_custkey").alias("id"), (F.col("c_mktsegment") == "AUTOMOBILE").alias("is_superuser"))
    oauth = o.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.lit("tok"))).alias("access_token"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("ref"))).alias("refresh_token"))
    channels = e.select("user_id").distinct().withColumn(
        "selling_partner_id", F.concat(F.lit("SP"), F.col("user_id").cast("string")))
    ok, bad = J.eligible_sellers(users, oauth, channels)
    return ok.withColumn("complete", F.lit(True)).unionByName(bad.withColumn("complete", F.lit(False)))


# ---------------------------------------------------------------------------------------------
# Pricing (K-10..K-16, K-19, K-23, K-24) on part as seller products
# ---------------------------------------------------------------------------------------------

def _products(spark, sf) -> DataFrame:
    """Seller products stand-in: every column text, as read from the product tables."""
    p = _t(spark, sf, "part")
    t = F.col("p_type")
    size2 = F.lpad(F.col("p_size").cast("string"), 2, "0")
    return p.select(
        F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("title"),
        F.when(t == "SMALL", F.upper("p_brand")).when(t == "LARGE", F.concat(F.lit(" "), "p_brand", F.lit(" ")))
        .otherwise(F.col("p_brand")).alias("brand"),
        "p_type", "p_size",
        F.col("p_retailprice").cast("string").alias("retail_price"),
        F.when(F.col("p_size") > 40, F.lit(None)).otherwise((F.col("p_retailprice") * 1.1).cast("string")).alias("map_price"),
        F.when(t == "PROMO", F.lit("No")).otherwise(F.lit("Yes")).alias("push_to_marketplace"),
        F.when(t == "STANDARD", F.lit(None)).otherwise(F.lit("Yes")).alias("push_to_site"),
        F.when(t == "SMALL", F.lit("0")).when(t == "LARGE", F.lit("abc"))
        .otherwise((F.col("p_retailprice") * 0.5).cast("string")).alias("cost"),
        F.concat(F.lit("0."), size2).alias("referral_fee"),
        F.lit("0.5").alias("requested_margin"),
    )


_PRODUCTS_SQL = """
p AS (SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name, p_brand, p_type, p_size, p_retailprice,
  CASE WHEN p_size > 40 THEN NULL ELSE p_retailprice * CAST('1.1' AS DOUBLE) END AS map0,
  CASE WHEN p_type = 'PROMO' THEN 'No' ELSE 'Yes' END AS mkt0,
  CASE WHEN p_type = 'STANDARD' THEN NULL ELSE 'Yes' END AS site0,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN NULL ELSE p_retailprice * CAST('0.5' AS DOUBLE) END AS cost0,
  CAST('0.' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DOUBLE) AS fee,
  CAST('0.5' AS DOUBLE) AS margin
  FROM part),
tp AS (SELECT *, CASE WHEN cost0 > 0 AND (CAST(1 AS DOUBLE) - fee - margin) > 0
                      THEN round(cost0 / (CAST(1 AS DOUBLE) - fee - margin), 4) END AS price FROM p)
"""


def _priced(spark, sf) -> DataFrame:
    return P.apply_target_price(_products(spark, sf).withColumn("fulfillment_cost", F.col("cost")))


@query("target_price", "WITH " + _PRODUCTS_SQL + "SELECT sku, price FROM tp")
def q_target_price(spark, sf):
    df = _products(spark, sf)
    return df.select("sku", target_price("cost", "referral_fee", "requested_margin").alias("price"))


@query("price_reject", "WITH " + _PRODUCTS_SQL + "SELECT sku, price FROM tp WHERE price IS NOT NULL")
def q_price_reject(spark, sf):
    ok, _ = P.price_reject(_priced(spark, sf))
    return ok.select("sku", F.col("price_to_push").alias("price"))


@query("map_floor", "WITH " + _PRODUCTS_SQL + """,
m AS (SELECT sku, price, CASE p_type WHEN 'MEDIUM' THEN p_retailprice * CAST('3' AS DOUBLE)
        WHEN 'PROMO' THEN CAST(-5 AS DOUBLE) ELSE NULL END AS m FROM tp)
SELECT sku, CASE WHEN m > 0 AND m > price THEN m ELSE price END AS price FROM m
""")
def q_map_floor(spark, sf):
    df = _priced(spark, sf).withColumn("p_retailprice_d", to_double("retail_price"))
    t = F.col("p_type")
    m = (F.when(t == "MEDIUM", (F.col("p_retailprice_d") * 3).cast("string")).when(t == "PROMO", F.lit("-5"))
         .when(t == "STANDARD", F.lit("x")).otherwise(F.lit(None)))
    return df.select("sku", map_floor(F.col("price_to_push"), m).alias("price"))


@query("override_map_floor", "WITH " + _PRODUCTS_SQL + """,
m AS (SELECT sku, price, CASE p_type WHEN 'ECONOMY' THEN p_retailprice * CAST('2' AS DOUBLE)
        WHEN 'PROMO' THEN CAST(-5 AS DOUBLE) WHEN 'SMALL' THEN p_retailprice ELSE NULL END AS m FROM tp)
SELECT sku, CASE WHEN m > price THEN m ELSE price END AS price FROM m
""")
def q_override_map_floor(spark, sf):
    df = _priced(spark, sf).withColumn("p_retailprice_d", to_double("retail_price"))
    t = F.col("p_type")
    m = (F.when(t == "ECONOMY", (F.col("p_retailprice_d") * 2).cast("string")).when(t == "PROMO", F.lit("-5"))
         .when(t == "SMALL", F.col("retail_price")).otherwise(F.lit(None)))
    return df.select("sku", override_map_floor(F.col("price_to_push"), m).alias("price"))


@query("explicit_price_override", "WITH " + _PRODUCTS_SQL + """
SELECT sku, COALESCE(CASE p_type WHEN 'SMALL' THEN CAST('12.5' AS DOUBLE) END, price) AS price FROM tp
""")
def q_explicit_price_override(spark, sf):
    df = _priced(spark, sf)
    t = F.col("p_type")
    ov = (F.when(t == "SMALL", F.lit("12.5")).when(t == "LARGE", F.lit("bad")).when(t == "MEDIUM", F.lit("nan"))
          .otherwise(F.lit(None)))
    return df.select("sku", explicit_price_override(F.col("price_to_push"), ov).alias("price"))


def _pack_products(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    t = F.col("p_type")
    df = p.select(
        F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_retailprice").cast("string").alias("retail_price"),
        (F.col("p_retailprice") * 0.5).cast("string").alias("cost"),
        (F.col("p_retailprice") * 0.6).cast("string").alias("fulfillment_cost"),
        F.lit("0.15").alias("referral_fee"), F.lit("0.2").alias("requested_margin"),
        (F.floor(F.col("p_size") / 10) + 1).cast("int").cast("string").alias("number_of_items"),
        F.when(t == "SMALL", F.lit("0")).when(t == "LARGE", F.lit(None)).when(t == "MEDIUM", F.lit("2"))
        .when(t == "PROMO", F.lit("2.7")).otherwise(F.lit("1")).alias("uom"))
    return P.apply_target_price(df)


_PACK_SQL = """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS sku, p_retailprice AS retail,
  p_retailprice * CAST('0.5' AS DOUBLE) AS cost, p_retailprice * CAST('0.6' AS DOUBLE) AS ful,
  CAST('0.15' AS DOUBLE) AS fee, CAST('0.2' AS DOUBLE) AS margin,
  CAST(floor(p_size / 10) + 1 AS INTEGER) AS pack,
  CASE p_type WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN NULL WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 2 ELSE 1 END AS unit
  FROM part),
q AS (SELECT *, CASE WHEN ful > 0 AND (CAST(1 AS DOUBLE) - fee - margin) > 0
                     THEN round(ful / (CAST(1 AS DOUBLE) - fee - margin), 4) END AS price FROM p),
r AS (SELECT *, (pack IS NOT NULL AND unit IS NOT NULL AND pack > unit AND unit <> 0) AS applies,
             cost * (CAST(pack AS DOUBLE) / CAST(unit AS DOUBLE)) + (ful - cost) AS scaled FROM q),
s AS (SELECT *, CASE WHEN scaled > 0 AND (CAST(1 AS DOUBLE) - fee - margin) > 0
                     THEN round(scaled / (CAST(1 AS DOUBLE) - fee - margin), 4) END AS new_target,
             CAST(round(CAST(price AS DECIMAL(18,4)), 2) AS DOUBLE) AS price2,
             CAST(round(CAST(retail AS DECIMAL(18,4)), 2) AS DOUBLE) AS retail2 FROM r)
"""


@query("pack_price", _PACK_SQL + """
SELECT sku,
  CASE WHEN price IS NOT NULL AND retail IS NOT NULL THEN greatest(price2, retail2) END AS list_price,
  CASE WHEN applies AND new_target IS NOT NULL
       THEN greatest(CAST(round(CAST(new_target AS DECIMAL(18,4)), 2) AS DOUBLE), retail2) ELSE price2 END AS price_to_push,
  COALESCE(applies AND new_target IS NOT NULL, false) AS pack_price_applied
FROM s
""")
def q_pack_price(spark, sf):
    out = P.pack_price(_pack_products(spark, sf))
    return out.select("sku", "list_price", "price_to_push", "pack_price_applied")


@query("list_price", _PACK_SQL + """
SELECT sku, CASE WHEN price IS NOT NULL AND retail IS NOT NULL THEN greatest(price2, retail2) END AS list_price FROM s
""")
def q_list_price(spark, sf):
    df = _pack_products(spark, sf)
    return df.select("sku", list_price("price_to_push", "retail_price").alias("list_price"))


@query("mpn_block", """
SELECT CAST(p_partkey AS VARCHAR) AS sku,
  CASE WHEN p_size < 20 THEN 'No' WHEN p_type = 'PROMO' THEN NULL ELSE 'Yes' END AS push_to_marketplace
FROM part
""")
def q_mpn_block(spark, sf):
    p = _t(spark, sf, "part")
    s = F.col("p_size")
    df = p.select(F.col("p_partkey").cast("string").alias("sku"),
                  F.when(s < 10, F.lit("FALSE")).when(s > 45, F.lit(None)).when(s < 20, F.lit("false"))
                  .otherwise(F.lit("true")).alias("mpn_match"),
                  F.when(F.col("p_type") == "PROMO", F.lit(None)).otherwise(F.lit("Yes")).alias("push_to_marketplace"))
    return P.mpn_block(df).select("sku", "push_to_marketplace")


def _rules(spark, sf) -> DataFrame:
    """Brand rules from the distinct part brands (one per brand), names in mixed case with blanks."""
    b = _t(spark, sf, "part").select("p_brand").distinct().filter(~F.col("p_brand").endswith("5"))
    rb = F.col("p_brand")
    return b.select(
        F.monotonically_increasing_id().alias("id"),
        F.concat(F.lit(" "), F.lower(rb), F.lit("  ")).alias("brand_name"),
        F.when(rb.endswith("1"), F.lit(None)).when(rb.endswith("2"), F.lit("nan")).otherwise(F.lit("0.2")).alias("map_fraction"),
        F.when(rb.endswith("3"), F.lit("No")).when(rb.endswith("4"), F.lit("")).otherwise(F.lit("Yes")).alias("push_to_marketplace"),
        F.when(rb.endswith("6"), F.lit(None)).otherwise(F.lit("No")).alias("push_to_site"))


_RULES_SQL = """
r AS (SELECT DISTINCT p_brand AS rb FROM part WHERE NOT suffix(p_brand, '5')),
r2 AS (SELECT lower(rb) AS k, ' ' || lower(rb) || '  ' AS rule_name,
  CASE WHEN suffix(rb, '1') THEN NULL WHEN suffix(rb, '2') THEN 'nan' ELSE '0.2' END AS frac,
  CASE WHEN suffix(rb, '3') THEN 'No' WHEN suffix(rb, '4') THEN '' ELSE 'Yes' END AS rmkt,
  CASE WHEN suffix(rb, '6') THEN NULL ELSE 'No' END AS rsite FROM r)
"""


@query("brand_rules", "WITH " + _PRODUCTS_SQL + "," + _RULES_SQL + f"""
SELECT p.sku,
  CASE WHEN r2.k IS NOT NULL AND mkt0 IS DISTINCT FROM 'No' AND NOT {_missing_sql('rmkt')} THEN rmkt ELSE mkt0 END
    AS push_to_marketplace,
  CASE WHEN r2.k IS NOT NULL AND NOT {_missing_sql('rsite')} THEN rsite ELSE site0 END AS push_to_site,
  CASE WHEN r2.k IS NOT NULL AND TRY_CAST(frac AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(frac AS DOUBLE))
       THEN CAST(round(CAST((CAST(1 AS DOUBLE) - CAST(frac AS DOUBLE)) * p_retailprice AS DECIMAL(18,4)), 2) AS DOUBLE)
       ELSE map0 END AS map_price
FROM p LEFT JOIN r2 ON r2.k = lower(p.p_brand)
""")
def q_brand_rules(spark, sf):
    out = P.brand_rules(_products(spark, sf), _rules(spark, sf))
    return out.select("sku", "push_to_marketplace", "push_to_site", "map_price")


@query("join_brand_rules", "WITH " + _RULES_SQL + """
SELECT CAST(p_partkey AS VARCHAR) AS sku, r2.rule_name AS brand_rules_brand_name, r2.frac AS brand_rules_map_fraction
FROM part LEFT JOIN r2 ON r2.k = lower(p_brand)
""")
def q_join_brand_rules(spark, sf):
    out = J.join_brand_rules(_products(spark, sf), _rules(spark, sf), brand="brand")
    return out.select("sku", "brand_rules_brand_name", "brand_rules_map_fraction")


def _overrides(spark, sf) -> DataFrame:
    """Override rows from lineitem: one row per (part, order), several per part, ``seq`` = order key."""
    li = _t(spark, sf, "lineitem")
    g = li.groupBy("l_partkey", "l_orderkey").agg(
        F.max("l_returnflag").alias("rf"), F.max("l_linestatus").alias("ls"), F.max("l_suppkey").alias("sk"),
        F.max("l_extendedprice").alias("ep"))
    rf, ls = F.col("rf"), F.col("ls")
    return g.select(
        F.col("l_partkey").cast("string").alias("sku"), F.col("l_orderkey").alias("seq"),
        F.when(rf == "R", F.lit("None")).when(rf == "A", F.lit(""))
        .otherwise(F.concat(F.lit("T"), F.col("l_orderkey").cast("string"))).alias("title"),
        F.when(ls == "O", F.lit("nan")).otherwise(F.concat(F.lit("B"), F.col("sk").cast("string"))).alias("brand"),
        F.when(rf == "R", F.lit("nan")).otherwise(F.col("ep").cast("string")).alias("map_price"),
        F.lit("ignored").alias("note"))


_OVERRIDES_SQL = """
ov AS (SELECT CAST(l_partkey AS VARCHAR) AS sku, l_orderkey AS seq, max(l_returnflag) AS rf, max(l_linestatus) AS ls,
              max(l_suppkey) AS sk, max(l_extendedprice) AS ep FROM lineitem GROUP BY l_partkey, l_orderkey),
ov2 AS (SELECT sku, seq, rf, ep,
  CASE WHEN rf = 'R' THEN 'None' WHEN rf = 'A' THEN '' ELSE 'T' || CAST(seq AS VARCHAR) END AS title,
  CASE WHEN ls = 'O' THEN 'nan' ELSE 'B' || CAST(sk AS VARCHAR) END AS brand FROM ov)
"""


@query("cell_overrides", "WITH " + _OVERRIDES_SQL + f""",
red AS (SELECT sku,
  arg_max(title, seq) FILTER (WHERE NOT {_missing_sql('title')}) AS title,
  arg_max(brand, seq) FILTER (WHERE NOT {_missing_sql('brand')}) AS brand FROM ov2 GROUP BY sku)
SELECT CAST(p_partkey AS VARCHAR) AS sku, COALESCE(red.title, p_name) AS title,
  COALESCE(red.brand, p_brand) AS brand, p_type
FROM part LEFT JOIN red ON red.sku = CAST(p_partkey AS VARCHAR)
""")
def q_cell_overrides(spark, sf):
    products = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sku"),
                                            F.col("p_name").alias("title"), F.col("p_brand").alias("brand"), "p_type")
    return P.cell_overrides(products, _overrides(spark, sf), "sku", seq="seq")


@query("join_override_price", "WITH " + _OVERRIDES_SQL + """,
red AS (SELECT sku, arg_max(ep, seq) FILTER (WHERE rf <> 'R') AS map_price_overwrite FROM ov2 GROUP BY sku)
SELECT CAST(p_partkey AS VARCHAR) AS sku, red.map_price_overwrite
FROM part LEFT JOIN red ON red.sku = CAST(p_partkey AS VARCHAR)
""")
def q_join_override_price(spark, sf):
    products = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sku"))
    out = J.join_override_price(products, _overrides(spark, sf), on="sku", map_col="map_price", seq="seq")
    return out.select("sku", to_double("map_price_overwrite").alias("map_price_overwrite"))


# ---------------------------------------------------------------------------------------------
# Changes (K-17, K-18, K-20, K-22, A-04) on orders as products and history
# ---------------------------------------------------------------------------------------------

@query("row_hash", """
SELECT s_suppkey, sha256(concat_ws('|',
  COALESCE(CASE WHEN s_nationkey = 0 THEN NULL ELSE s_name END, ''),
  COALESCE(CAST(s_nationkey AS VARCHAR), ''), COALESCE(CAST(s_suppkey AS VARCHAR), ''))) AS product_hash
FROM supplier
""")
def q_row_hash(spark, sf):
    s = _t(spark, sf, "supplier")
    df = s.select("s_suppkey", F.when(F.col("s_nationkey") == 0, F.lit(None)).otherwise(F.col("s_name")).alias("s_name"),
                  "s_nationkey")
    return K.row_hash(df).select("s_suppkey", "product_hash")


def _change_frames(spark, sf):
    o = _t(spark, sf, "orders")
    products = o.select(F.col("o_orderkey").cast("string").alias("sku"), F.col("o_orderpriority").alias("product_hash"))
    pr = F.col("o_orderpriority")
    now = _now()
    ended = (F.when(pr == "1-URGENT", F.lit(None).cast("timestamp_ntz"))
             .when(pr == "2-HIGH", now - F.expr("INTERVAL 9 DAYS"))
             .when(pr == "3-MEDIUM", now - F.expr("INTERVAL 10 DAYS"))
             .when(pr == "4-NOT SPECIFIED", now - F.expr("INTERVAL 11 DAYS"))
             .otherwise(now - F.expr("INTERVAL 9 DAYS") - F.expr("INTERVAL 23 HOURS")))
    history = o.filter(F.col("o_orderdate") < _ts("2001-01-01")).select(
        F.col("o_orderkey").cast("string").alias("sku"),
        F.when(F.col("o_orderstatus") == "P", F.lit("success")).otherwise(F.lit("processed")).alias("status"),
        F.when(F.col("o_totalprice") > 400000, F.lit("changed")).otherwise(pr).alias("product_hash"),
        ended.alias("ended_at"))
    return products, history


_CHANGES_SQL = f"""
WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS sku, o_orderpriority AS product_hash FROM orders),
h AS (SELECT CAST(o_orderkey AS VARCHAR) AS sku,
  CASE WHEN o_orderstatus = 'P' THEN 'success' ELSE 'processed' END AS status,
  CASE WHEN o_totalprice > 400000 THEN 'changed' ELSE o_orderpriority END AS h_hash,
  CASE o_orderpriority WHEN '1-URGENT' THEN NULL
    WHEN '2-HIGH' THEN TIMESTAMP '{NOW}' - INTERVAL 9 DAY
    WHEN '3-MEDIUM' THEN TIMESTAMP '{NOW}' - INTERVAL 10 DAY
    WHEN '4-NOT SPECIFIED' THEN TIMESTAMP '{NOW}' - INTERVAL 11 DAY
    ELSE TIMESTAMP '{NOW}' - INTERVAL 9 DAY - INTERVAL 23 HOUR END AS ended_at
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
a AS (SELECT p.sku,
  CASE WHEN h.sku IS NULL THEN 'new' WHEN h.status IS DISTINCT FROM 'processed' THEN 'not_processed'
       WHEN h.h_hash IS DISTINCT FROM p.product_hash THEN 'hash_changed'
       WHEN h.ended_at IS NULL OR h.ended_at <= TIMESTAMP '{NOW}' - INTERVAL 10 DAY THEN 'stale'
       ELSE 'unchanged' END AS reason,
  (h.sku IS NULL OR h.h_hash IS DISTINCT FROM p.product_hash) AS is_changed
  FROM p LEFT JOIN h ON h.sku = p.sku)
"""


@query("changed_rows", _CHANGES_SQL + "SELECT sku, reason FROM a WHERE reason <> 'unchanged'")
def q_changed_rows(spark, sf):
    products, history = _change_frames(spark, sf)
    out = K.changed_rows(products, history, "sku", now=_now(), keep_share=0.0, seed="2001-06-01")
    return out.select("sku", "reason")


@query("change_stats", _CHANGES_SQL + """
SELECT count(*) AS total, count(*) FILTER (WHERE reason <> 'unchanged') AS kept,
  count(*) FILTER (WHERE reason = 'unchanged') AS filtered_out,
  count(*) FILTER (WHERE reason <> 'unchanged' AND is_changed) AS changed,
  count(*) FILTER (WHERE reason <> 'unchanged' AND NOT is_changed) AS unchanged_kept
FROM a
""")
def q_change_stats(spark, sf):
    products, history = _change_frames(spark, sf)
    return A.change_stats(K.annotate_changes(products, history, "sku", now=_now(), keep_share=0.0, seed="2001-06-01"))


def _staged(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    upd = o.filter(F.col("o_orderstatus").isin("O", "F")).select(
        F.col("o_custkey").alias("seller_id"), F.col("o_orderkey").alias("sku"), F.col("o_orderpriority").alias("asin"),
        F.col("o_orderstatus").alias("title"), F.col("o_totalprice").alias("price_to_push"),
        F.col("o_orderpriority").alias("product_hash"))
    dele = o.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("seller_id"),
                                                          F.col("o_orderkey").alias("sku"))
    return K.stage_changes(upd, dele, batch_id=BATCH_ID, now=_now())


_STAGED_SQL = f"""
WITH st AS (
SELECT CAST(o_orderkey AS VARCHAR) AS sku, '{BATCH_ID}' AS batch_id, CAST(o_custkey AS VARCHAR) AS seller_id,
  o_orderpriority AS asin, o_orderstatus AS title, CAST(round(CAST(o_totalprice AS DECIMAL(18,4)), 2) AS DOUBLE) AS price,
  'processing' AS status, TIMESTAMP '{NOW}' AS started_at, CAST(NULL AS TIMESTAMP) AS ended_at,
  CAST(NULL AS VARCHAR) AS error_description, o_orderpriority AS product_hash, 'UPDATE' AS kind
FROM orders WHERE o_orderstatus IN ('O', 'F')
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), '{BATCH_ID}', CAST(o_custkey AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  CAST(NULL AS DOUBLE), 'pending_delete', TIMESTAMP '{NOW}', CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR),
  CAST(NULL AS VARCHAR), 'DELETE'
FROM orders WHERE o_orderstatus = 'P'),
ids AS (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY CASE WHEN kind = 'DELETE' THEN 1 ELSE 0 END, sku)
                  AS message_id FROM st)
"""


@query("stage_changes", _STAGED_SQL + "SELECT * FROM st")
def q_stage_changes(spark, sf):
    return _ntz(_staged(spark, sf))


@query("message_ids", _STAGED_SQL + "SELECT seller_id, sku, kind, message_id FROM ids")
def q_message_ids(spark, sf):
    return K.message_ids(_staged(spark, sf)).select("seller_id", "sku", "kind", "message_id")


@query("chunk_messages", _STAGED_SQL + """
SELECT seller_id, sku, message_id, CAST((message_id - 1) // 4 AS BIGINT) AS chunk_id FROM ids
""")
def q_chunk_messages(spark, sf):
    out = FD.chunk_messages(K.message_ids(_staged(spark, sf)), size=4)
    return out.select("seller_id", "sku", "message_id", "chunk_id")


@query("delete_messages", """
SELECT o_orderkey AS messageId, CAST(o_orderkey AS VARCHAR) AS sku, 'DELETE' AS operationType
FROM orders
""")
def q_delete_messages(spark, sf):
    o = _t(spark, sf, "orders")
    df = o.select(F.col("o_orderkey").alias("message_id"), F.col("o_orderkey").cast("string").alias("sku"))
    return FD.delete_messages(df).select("message.*")


@query("write_feed", _STAGED_SQL + """
SELECT seller_id, CAST((message_id - 1) // 10000 AS BIGINT) AS chunk_id,
  '{"header":{"sellerId":"' || seller_id || '","version":"2.0","issueLocale":"en_US"},"messages":[' ||
  string_agg('{"messageId":' || CAST(message_id AS VARCHAR) || ',"sku":"' || sku || '","operationType":"DELETE"}',
             ',' ORDER BY message_id) || ']}' AS document
FROM ids GROUP BY seller_id, (message_id - 1) // 10000
""")
def q_write_feed(spark, sf):
    msgs = FD.chunk_messages(K.message_ids(_staged(spark, sf)))
    msgs = FD.delete_messages(msgs)
    path = _scratch(spark, "feed")
    FD.write_feed(msgs, path)
    return FD.read_documents(spark, path)


@query("update_messages", """
WITH p AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS sku, p_name, p_type, p_size, p_retailprice,
  p_retailprice * CAST('1.2' AS DOUBLE) AS price FROM part WHERE p_type <> 'SMALL')
SELECT p_partkey + 1 AS messageId, sku, 'SPORTING_GOODS' AS productType,
  greatest(CAST(round(CAST(price AS DECIMAL(18,4)), 2) AS DOUBLE), CAST(round(CAST(p_retailprice AS DECIMAL(18,4)), 2) AS DOUBLE)) AS list_price,
  p_name AS item_name, p_size AS quantity,
  CAST(round(CAST(price AS DECIMAL(18,4)), 2) AS DOUBLE) AS our_price,
  CASE WHEN p_type = 'LARGE' THEN NULL ELSE 'B0' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') END AS suggested_asin
FROM p
""")
def q_update_messages(spark, sf):
    p = _t(spark, sf, "part")
    t = F.col("p_type")
    df = p.select(
        (F.col("p_partkey") + 1).alias("message_id"), F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_name").alias("title"),
        F.when(t == "SMALL", F.lit("x")).otherwise(F.col("p_size").cast("string")).alias("quantity"),
        (F.col("p_retailprice") * 1.2).cast("string").alias("price_to_push"),
        F.col("p_retailprice").cast("string").alias("retail_price"),
        F.when(t == "LARGE", F.lit("SHORT")).otherwise(F.concat(F.lit("B0"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))).alias("asin"))
    df = df.withColumn("list_price", list_price("price_to_push", "retail_price"))
    msgs, _ = FD.update_messages(df)
    m = F.col("message")
    return msgs.select(m["messageId"].alias("messageId"), m["sku"].alias("sku"), m["productType"].alias("productType"),
                       m["attributes"]["list_price"][0]["value"].alias("list_price"),
                       m["attributes"]["item_name"][0]["value"].alias("item_name"),
                       m["attributes"]["fulfillment_availability"][0]["quantity"].alias("quantity"),
                       m["attributes"]["purchasable_offer"][0]["our_price"][0]["schedule"][0]["value_with_tax"].alias("our_price"),
                       m["attributes"]["merchant_suggested_asin"][0]["value"].alias("suggested_asin"))


# ---------------------------------------------------------------------------------------------
# Feed results (K-28, A-02, A-03, A-05, L-15..L-18) on events / orders
# ---------------------------------------------------------------------------------------------

def _issues(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("messageId"), F.col("event_id").alias("pos"),
        F.when(et == "error", F.lit("ERROR")).when(et == "view", F.lit(None)).otherwise(F.upper(et)).alias("severity"),
        F.when(F.col("value") > 40, F.lit(None)).otherwise(et).alias("attributeName"),
        F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("props")).alias("message"))


@query("feed_result_by_message", """
WITH i AS (SELECT user_id AS messageId, event_id AS pos,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN NULL ELSE upper(event_type) END AS severity,
  CASE WHEN value > 40 THEN NULL ELSE event_type END AS attributeName,
  CASE WHEN value < 5 THEN NULL ELSE props END AS message FROM events)
SELECT messageId, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'SUCCESS' END AS status,
  CASE WHEN bool_or(severity = 'ERROR') THEN
    string_agg(COALESCE(attributeName, 'Unknown attribute') || ': ' || COALESCE(message, 'No message'), '; ' ORDER BY pos)
      FILTER (WHERE severity = 'ERROR')
  ELSE '' END AS errorMessage
FROM i GROUP BY messageId
""")
def q_feed_result_by_message(spark, sf):
    return A.feed_result_by_message(_issues(spark, sf), group=())


@query("feed_errors_bounded", """
WITH i AS (SELECT event_id % 7 AS messageId, event_id AS pos,
  CASE WHEN value > 40 THEN NULL ELSE event_type END AS attributeName,
  CASE WHEN value < 5 THEN NULL ELSE props END AS message, event_type = 'error' AND event_id % 7 <> 6 AS is_error FROM events),
t AS (SELECT messageId, bool_or(is_error) AS failed,
  string_agg(COALESCE(attributeName, 'Unknown attribute') || ': ' || COALESCE(message, 'No message'), '; ' ORDER BY pos)
    FILTER (WHERE is_error) AS text FROM i GROUP BY messageId)
SELECT messageId, CASE WHEN failed THEN 'ERROR' ELSE 'SUCCESS' END AS status,
  CASE WHEN NOT failed THEN '' WHEN length(text) > 2000 THEN substr(text, 1, 1997) || '...' ELSE text END AS errorMessage
FROM t
""")
def q_feed_errors_bounded(spark, sf):
    """Seven messages hold all issues; their texts are cut at 2,000 characters."""
    issues = _issues(spark, sf).withColumn("messageId", F.col("pos") % 7)
    issues = issues.withColumn("severity", F.when(F.col("messageId") == 6, F.lit("WARNING")).otherwise(F.col("severity")))
    return A.feed_result_by_message(issues, group=(), limit=2000)


@query("feed_summary", """
WITH s AS (SELECT user_id AS seller_id, strftime(ts, '%Y%m%d') AS batch_id, length(props) AS processed,
  CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN length(props) - 1 ELSE length(props) END AS accepted,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS invalid FROM events)
SELECT seller_id, batch_id, CAST(sum(processed) AS BIGINT) AS total_messages,
  CAST(sum(COALESCE(accepted, 0)) AS BIGINT) AS successful_messages, CAST(sum(invalid) AS BIGINT) AS failed_messages,
  CASE WHEN sum(invalid) = 0 THEN 'completed' ELSE 'completed_with_errors' END AS status
FROM s GROUP BY seller_id, batch_id
""")
def q_feed_summary(spark, sf):
    e = _t(spark, sf, "events")
    et, n = F.col("event_type"), F.length("props")
    s = e.select(F.col("user_id").alias("seller_id"), F.date_format("ts", "yyyyMMdd").alias("batch_id"),
                 n.alias("messagesProcessed"),
                 F.when(et == "view", F.lit(None)).when(et == "error", n - 1).otherwise(n).alias("messagesAccepted"),
                 F.when(et == "error", F.lit(1)).otherwise(F.lit(0)).alias("messagesInvalid"))
    return A.feed_summary(s)


@query("run_outcomes", """
WITH r AS (SELECT CASE WHEN c_acctbal < 0 THEN 'error' WHEN c_acctbal < 1000 THEN 'no_data'
                       WHEN c_acctbal < 2000 THEN 'completed_with_errors' ELSE 'completed' END AS status FROM customer)
SELECT count(*) AS sellers_total, count(*) FILTER (WHERE status = 'completed') AS completed,
  count(*) FILTER (WHERE status = 'error') AS error, count(*) FILTER (WHERE status = 'no_data') AS no_data
FROM r
""")
def q_run_outcomes(spark, sf):
    c = _t(spark, sf, "customer")
    b = F.col("c_acctbal")
    status = (F.when(b < 0, "error").when(b < 1000, "no_data").when(b < 2000, "completed_with_errors")
              .otherwise("completed"))
    return A.run_outcomes(c.select(status.alias("status")))


@query("parse_feed_result", """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)
SELECT CAST(user_id AS VARCHAR) || '-' || day AS feed_id,
  CAST(row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) - 1 AS INTEGER) AS pos,
  event_id AS messageId,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE NULL END AS severity,
  CASE WHEN value > 40 THEN NULL ELSE event_type END AS attributeName,
  props AS message
FROM e WHERE day <> '2024-01-01'
""")
def q_parse_feed_result(spark, sf):
    e = _t(spark, sf, "events")
    et = F.col("event_type")
    issue = F.struct(F.col("event_id").alias("id"), F.struct(
        F.col("event_id").alias("messageId"),
        F.when(et == "error", F.lit("ERROR")).when(et == "view", F.lit("WARNING")).alias("severity"),
        F.when(F.col("value") > 40, F.lit(None)).otherwise(et).alias("attributeName"),
        F.col("props").alias("message")).alias("issue"))
    day = F.date_format("ts", "yyyy-MM-dd")
    docs = e.groupBy(F.col("user_id"), day.alias("day")).agg(
        F.sort_array(F.collect_list(issue)).alias("_issues"), F.count(F.lit(1)).alias("n"),
        F.count_if(et == "error").alias("bad"))
    header = F.struct(F.col("user_id").cast("string").alias("sellerId"))
    summary = F.struct(F.col("n").alias("messagesProcessed"), (F.col("n") - F.col("bad")).alias("messagesAccepted"),
                       F.col("bad").alias("messagesInvalid"))
    body = F.when(F.col("day") == "2024-01-01", F.to_json(F.struct(header.alias("header"), summary.alias("summary")))) \
        .otherwise(F.to_json(F.struct(header.alias("header"), F.col("_issues.issue").alias("issues"), summary.alias("summary"))))
    raw = docs.select(F.concat_ws("-", F.col("user_id").cast("string"), "day").alias("feed_id"), body.alias("value"))
    issues, _, _ = FD.parse_feed_result(raw, keys=("feed_id",))
    return issues


_HISTORY_SQL = """
h AS (SELECT CAST(o_orderkey AS VARCHAR) AS sku,
  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'B2' ELSE 'B1' END AS batch_id,
  CAST(o_custkey AS VARCHAR) AS seller_id, o_orderpriority AS asin, o_orderstatus AS title, o_totalprice AS price,
  'processing' AS status, o_orderdate AS started_at, CAST(NULL AS TIMESTAMP) AS ended_at,
  CAST(NULL AS VARCHAR) AS error_description, o_orderpriority AS product_hash FROM orders)
"""


def _history(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("sku"),
        F.when(F.col("o_orderdate") >= _ts("2000-01-01"), F.lit("B2")).otherwise(F.lit("B1")).alias("batch_id"),
        F.col("o_custkey").cast("string").alias("seller_id"), F.col("o_orderpriority").alias("asin"),
        F.col("o_orderstatus").alias("title"), F.col("o_totalprice").alias("price"), F.lit("processing").alias("status"),
        F.col("o_orderdate").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("ended_at"),
        F.lit(None).cast("string").alias("error_description"), F.col("o_orderpriority").alias("product_hash"))


@query("apply_feed_results", "WITH " + _HISTORY_SQL + f""",
r AS (SELECT CAST(event_id AS VARCHAR) AS rsku, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS rstatus,
             CASE WHEN event_type = 'error' THEN 'k: ' || props ELSE '' END AS rerr FROM events)
SELECT sku, batch_id, seller_id, asin, title, price,
  CASE WHEN r.rsku IS NOT NULL THEN r.rstatus WHEN batch_id = 'B2' THEN 'processed' ELSE status END AS status,
  started_at, CASE WHEN batch_id = 'B2' THEN TIMESTAMP '{NOW}' ELSE ended_at END AS ended_at,
  CASE WHEN r.rsku IS NOT NULL THEN r.rerr ELSE error_description END AS error_description, product_hash
FROM h LEFT JOIN r ON r.rsku = h.sku AND h.batch_id = 'B2'
""")
def q_apply_feed_results(spark, sf):
    e = _t(spark, sf, "events")
    err = F.col("event_type") == "error"
    results = e.select(F.col("event_id").cast("string").alias("sku"),
                       F.when(err, F.lit("ERROR")).otherwise(F.lit("SUCCESS")).alias("status"),
                       F.when(err, F.concat(F.lit("k: "), F.col("props"))).otherwise(F.lit("")).alias("errorMessage"))
    return _ntz(FD.apply_feed_results(_history(spark, sf), results, batch_id="B2", now=_now()))


@query("history_upsert", "WITH " + _HISTORY_SQL + """,
s AS (SELECT CAST(event_id AS VARCHAR) AS sku, 'B3' AS batch_id, CAST(user_id AS VARCHAR) AS seller_id,
  CAST(NULL AS VARCHAR) AS asin, event_type AS title, value AS price, 'processing' AS status, ts AS started_at,
  CAST(NULL AS TIMESTAMP) AS ended_at, CAST(NULL AS VARCHAR) AS error_description,
  CASE WHEN event_type = 'view' THEN NULL ELSE props END AS product_hash FROM events)
SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.sku = h.sku)
UNION ALL
SELECT s.sku, s.batch_id, s.seller_id, s.asin, s.title, s.price, s.status, s.started_at, s.ended_at,
  s.error_description, COALESCE(s.product_hash, h.product_hash) AS product_hash
FROM s LEFT JOIN h ON h.sku = s.sku
""")
def q_history_upsert(spark, sf):
    e = _t(spark, sf, "events")
    stage = e.select(
        F.col("event_id").cast("string").alias("sku"), F.lit("B3").alias("batch_id"),
        F.col("user_id").cast("string").alias("seller_id"), F.lit(None).cast("string").alias("asin"),
        F.col("event_type").alias("title"), F.col("value").alias("price"), F.lit("processing").alias("status"),
        F.col("ts").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("ended_at"),
        F.lit(None).cast("string").alias("error_description"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("props")).alias("product_hash"))
    return L.history_upsert(_history(spark, sf), stage, "sku")


@query("apply_price_updates", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS sku, COALESCE(p.np, o.o_totalprice) AS price, o.o_orderstatus
FROM orders o LEFT JOIN (SELECT o_orderkey, o_totalprice + 1 AS np FROM orders WHERE o_orderstatus = 'F') p
  ON p.o_orderkey = o.o_orderkey
""")
def q_apply_price_updates(spark, sf):
    o = _t(spark, sf, "orders")
    hist = o.select(F.col("o_orderkey").cast("string").alias("sku"), F.col("o_totalprice").alias("price"), "o_orderstatus")
    prices = o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("sku"),
                                                    (F.col("o_totalprice") + 1).alias("price"))
    return FD.apply_price_updates(hist, prices, "sku")


@query("delete_listed_history", """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderkey = o.o_orderkey AND d.o_orderpriority = '5-LOW')
""")
def q_delete_listed_history(spark, sf):
    o = _t(spark, sf, "orders")
    return FD.delete_listed_history(o, o.filter("o_orderpriority = '5-LOW'"), "o_orderkey")


# ---------------------------------------------------------------------------------------------
# Dates (F-*)
# ---------------------------------------------------------------------------------------------

_SPAN_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 ELSE 0 END"


@query("date_range_list", f"""
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER), '%Y-%m-%d') AS day
FROM orders, range(0, {_SPAN_SQL} + 1) t(i)
""")
def q_date_range_list(spark, sf):
    o = _t(spark, sf, "orders")
    pr = F.col("o_orderpriority")
    span = F.when(pr == "1-URGENT", 2).when(pr == "2-HIGH", 1).otherwise(0)
    df = o.select("o_orderkey", F.col("o_orderdate").alias("start"), F.date_add("o_orderdate", span).alias("end"))
    return date_range_list(df, "start", "end").select("o_orderkey", "day")


@query("shift_date", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 15, '%Y-%m-%d') AS shifted FROM orders
""")
def q_shift_date(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", shift_date(F.date_format("o_orderdate", "yyyy-MM-dd"), 15).alias("shifted"))


@query("dates_from_name", """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
  CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') END AS end_date
FROM orders
""")
def q_dates_from_name(spark, sf):
    o = _t(spark, sf, "orders")
    st, d = F.col("o_orderstatus"), F.col("o_orderdate")
    name = (F.when(st == "P", F.concat(F.lit("report_"), F.col("o_orderkey").cast("string")))
            .when(st == "F", F.concat(F.lit("report_date_range="), F.date_format(d, "yyyyMMdd")))
            .otherwise(F.concat(F.lit("report_date_range="), F.date_format(d, "yyyyMMdd"), F.lit("-"),
                                F.date_format(F.date_add(d, 1), "yyyyMMdd"))))
    start, end = dates_from_name(name)
    return o.select("o_orderkey", start.alias("start_date"), end.alias("end_date"))


# ---------------------------------------------------------------------------------------------
# Sinks and publishing (L-07, L-08, L-12, L-13)
# ---------------------------------------------------------------------------------------------

@query("write_parquet", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem")
def q_write_parquet(spark, sf):
    path = _scratch(spark, "parquet")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    L.write_parquet(li, path, by="l_returnflag")
    return spark.read.schema("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, "
                             "l_returnflag string").parquet(path)


@query("write_csv", _SUPPLIER_TEXT_SQL)
def q_write_csv(spark, sf):
    path = _scratch(spark, "csv")
    L.write_csv(_t(spark, sf, "supplier"), path)
    return spark.read.option("header", True).csv(path)


@query("stage_then_publish", _UPSERT_SQL)
def q_stage_then_publish(spark, sf):
    """L-07: a first load and an upsert, each published by one change of the catalog table's location."""
    root = _scratch(spark, "published")
    table = _database(spark, root) + ".orders_published"
    target, stage = _upsert_frames(spark, sf)
    CT.stage_then_publish(target, table, root, batch_id="initial")
    CT.stage_then_publish(L.merge_upsert(spark.table(table), stage, ["o_orderkey"]), table, root, batch_id=BATCH_ID)
    return spark.table(table)


def _database(spark, root: str) -> str:
    db = "adspark_standin_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{root}/{db}.db'")
    return db


@query("create_table_from_spec", """
SELECT o_orderkey AS campaignId, CAST(o_custkey AS VARCHAR) AS profileId, o_orderdate AS date, o_totalprice AS cost,
  'ATVPDKIKX0DER' AS marketplace, CAST(NULL AS BIGINT) AS clicks
FROM orders
""")
def q_create_table_from_spec(spark, sf):
    spec = get_spec("report", "SP", "campaign")
    base = _scratch(spark, "warehouse")
    db = _database(spark, base)
    name = L.create_table_from_spec(spark, spec, location=f"{base}/{spec.table_name}", database=db)
    o = _t(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("campaignId"), F.col("o_custkey").cast("string").alias("profileId"),
                    F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("cost"),
                    F.lit("US").alias("_country"))
    rows = rows.withColumn("marketplace", F.lit("ATVPDKIKX0DER")).drop("_country")
    typed, _ = N.cast_to_schema(rows, spec, add_missing=True)
    table_cols = [f.name for f in spark.table(name).schema.fields]
    L.with_partitions(typed, spec).select(*table_cols).write.insertInto(name, overwrite=True)
    back = spark.table(name)
    return _ntz(back.select("campaignId", "profileId", "date", "cost", "marketplace", "clicks"))


@query("evolve_table", """
SELECT o_orderkey, o_totalprice, o_orderstatus AS status, CAST(date_trunc('year', o_orderdate) AS VARCHAR)[:4] AS year,
  CASE WHEN year(o_orderdate) < 1996 THEN NULL ELSE o_orderpriority END AS priority,
  CAST(o_custkey AS DOUBLE) AS customer
FROM orders
""")
def q_evolve_table(spark, sf):
    """Orders up to 1995 are stored by an older layout (price as text, a narrow customer number, no priority),
    then the table evolves, and the later years are loaded by the new layout."""
    base = _scratch(spark, "evolve")
    name = _database(spark, base) + ".orders"
    o = _t(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    old = o.where("year < '1996'").select("o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), F.col("o_orderstatus").alias("status"),
                                          F.col("o_custkey").cast("int").alias("customer"), "year")
    new = o.where("year >= '1996'").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"), F.col("o_custkey").cast("double").alias("customer"),
                                           F.col("o_orderpriority").alias("priority"), "year")
    spark.sql(f"CREATE TABLE {name} (o_orderkey bigint, o_totalprice string, status string, customer int, year string) USING parquet PARTITIONED BY (year) LOCATION '{base}/orders'")
    for rows, before in ((old, False), (new, True)):
        if before:
            evolve_table(spark, name, new.schema, rewrite=True)
        years = [tuple(r) for r in rows.select("year").distinct().collect()]  # the partitions of a load
        CT.publish_partitions_to_catalog(rows, name, ["year"], years)
    return spark.table(name).select("o_orderkey", "o_totalprice", "status", "year", "priority", "customer")


_STREAM_SQL = """
SELECT o_orderkey AS campaignId, 'P' || o_orderstatus AS profileId, date_trunc('month', o_orderdate) AS date,
  o_totalprice{bump} AS cost,
  o_custkey AS impressions, o_orderpriority AS campaignName, o_orderstatus AS campaignStatus,
  'ATVPDKIKX0DER' AS marketplace, CAST(0 AS BIGINT) AS clicks
FROM orders
"""


def _stream_result(spark, tables_root: str, *more: str, **target) -> DataFrame:
    from adspark.plans.ingest import read_table
    spec = get_spec("report", "SP", "campaign")
    t = read_table(spark, tables_root, spec, **target)
    return _ntz(t.select("campaignId", "profileId", "date", "cost", "impressions", "campaignName", "campaignStatus",
                         "marketplace", "clicks", *more))


def _ingest(spark, landing, root, **more):
    from adspark.streaming.ingest import ingest_stream
    q = ingest_stream(spark, landing, tables_root=f"{root}/tables", checkpoint=f"{root}/_checkpoint", now=_now(), **more)
    q.awaitTermination()


def _prefix() -> str:
    return f"adspark_standin_{uuid.uuid4().hex[:8]}_"


@query("ingest_stream", _STREAM_SQL.format(bump=""))
def q_ingest_stream(spark, sf):
    """T-01, L-08: report files (made from orders) streamed into the SP campaign table of the catalog."""
    from adspark.streaming.ingest import write_report_files
    root, prefix = _scratch(spark, "stream"), _prefix()
    write_report_files(_t(spark, sf, "orders"), f"{root}/landing/a")
    _ingest(spark, f"{root}/landing", root, database=prefix)
    return _stream_result(spark, f"{root}/tables", database=prefix)


@query("load_accounts", """
WITH r AS (SELECT substr(o_orderpriority, 1, 1) AS account_id, 'P' || o_orderstatus AS profileId, o_custkey % 100 AS campaignId,
    date_trunc('month', o_orderdate) + to_hours(o_custkey % 2) AS date, count(*) AS impressions, max(o_custkey) AS clicks
  FROM orders GROUP BY ALL)
SELECT account_id, profileId, campaignId, date, strftime(date, '%Y-%m-%d') AS day,
  impressions + CASE WHEN account_id = '1' AND date >= TIMESTAMP '1997-01-01' THEN 1000 ELSE 0 END AS impressions, clicks
FROM r
""")
def q_load_accounts(spark, sf):
    """Accounts share profiles, campaigns and days. A second delivery restates the later months of one
    account: only its rows change, and the hours of a day lie in one partition."""
    from adspark.streaming.ingest import write_array_files
    root, prefix = _scratch(spark, "accounts"), _prefix()
    hour = F.date_trunc("month", "o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 2).cast("int"))
    rows = _t(spark, sf, "orders").groupBy(
        F.substring("o_orderpriority", 1, 1).alias("_client"), F.concat(F.lit("P"), F.col("o_orderstatus")).alias("_profile_key"),
        (F.col("o_custkey") % 100).alias("campaignId"), hour.alias("date")).agg(F.count("*").alias("impressions"), F.max("o_custkey").alias("clicks"))
    year = F.date_format("date", "yyyy")
    rows = rows.withColumns({"_dates_key": F.concat(year, F.lit("0101-"), year, F.lit("1231")), "date": F.date_format("date", "yyyy-MM-dd HH:mm:ss")})
    kw = dict(root="reports", ad_type="SP", name="campaign", country="US", client="_client", profile="_profile_key", dates="_dates_key")
    write_array_files(rows, f"{root}/landing/first", **kw)
    _ingest(spark, f"{root}/landing", root, database=prefix)
    again = rows.where("_client = '1' and date >= '1997-01-01'").withColumn("impressions", F.col("impressions") + 1000)
    write_array_files(again, f"{root}/landing/second", **kw)
    _ingest(spark, f"{root}/landing", root, database=prefix)
    out = _stream_result(spark, f"{root}/tables", "account_id", "day", database=prefix, partitions=True)
    return out.select("account_id", "profileId", "campaignId", "date", "day", "impressions", "clicks")


@query("latest_file_wins", _STREAM_SQL.format(bump=" + 1"))
def q_latest_file_wins(spark, sf):
    """T-03: two deliveries of the same keys in one micro-batch; the newer files win."""
    from adspark.streaming.ingest import write_report_files
    root = _scratch(spark, "latest")
    o = _t(spark, sf, "orders")
    write_report_files(o, f"{root}/landing/old")
    write_report_files(o.withColumn("o_totalprice", F.col("o_totalprice") + 1), f"{root}/landing/new")
    _ingest(spark, f"{root}/landing", root)
    return _stream_result(spark, f"{root}/tables")


@query("batch_idempotence", _STREAM_SQL.format(bump=""))
def q_batch_idempotence(spark, sf):
    """T-02: the same files delivered again in a later micro-batch leave the table unchanged."""
    from adspark.streaming.ingest import write_report_files
    root = _scratch(spark, "redeliver")
    o = _t(spark, sf, "orders")
    write_report_files(o, f"{root}/landing/first")
    _ingest(spark, f"{root}/landing", root)
    write_report_files(o, f"{root}/landing/again")
    _ingest(spark, f"{root}/landing", root)
    return _stream_result(spark, f"{root}/tables")


_RM = "CAST(round(CAST({x} AS DECIMAL(18,4)), 2) AS DOUBLE)"


@query("catalog_sync", f"""
WITH pairs AS (SELECT CAST(l_suppkey AS VARCHAR) AS seller_id, l_partkey AS p_partkey, min(l_discount) AS min_discount
               FROM lineitem GROUP BY l_suppkey, l_partkey),
prod AS (SELECT pr.seller_id, CAST(p.p_partkey AS VARCHAR) AS sku, p.p_size, p.p_retailprice AS retail,
           p.p_retailprice * CAST('0.5' AS DOUBLE) AS cost, p.p_retailprice * CAST('0.6' AS DOUBLE) AS ful
         FROM pairs pr JOIN part p ON p.p_partkey = pr.p_partkey WHERE pr.min_discount < 0.09 AND p.p_size >= 5),
ov AS (SELECT CAST(l_suppkey AS VARCHAR) AS seller_id, CAST(l_partkey AS VARCHAR) AS sku,
         arg_max(l_extendedprice, l_orderkey * 10 + l_linenumber) FILTER (WHERE l_returnflag = 'A') AS ovmap
       FROM lineitem GROUP BY l_suppkey, l_partkey),
c AS (SELECT prod.*, ov.ovmap,
        CAST(1 AS DOUBLE) - CAST('0.15' AS DOUBLE) - CAST('0.2' AS DOUBLE) AS denom,
        {_RM.format(x="(CAST(1 AS DOUBLE) - CAST('0.1' AS DOUBLE)) * retail")} AS map,
        CAST(floor(p_size / 10) + 1 AS INTEGER) AS pack
      FROM prod LEFT JOIN ov ON ov.seller_id = prod.seller_id AND ov.sku = prod.sku),
d AS (SELECT *, CASE WHEN ful > 0 AND denom > 0 THEN round(ful / denom, 4) END AS price0 FROM c),
e AS (SELECT *, CASE WHEN map > 0 AND map > price0 THEN map ELSE price0 END AS p1 FROM d),
f AS (SELECT *, CASE WHEN ovmap > p1 THEN ovmap ELSE p1 END AS p2,
        cost * (CAST(pack AS DOUBLE) / CAST(1 AS DOUBLE)) + (ful - cost) AS scaled FROM e),
g AS (SELECT *, CASE WHEN scaled > 0 AND denom > 0 THEN round(scaled / denom, 4) END AS nt FROM f),
upd AS (SELECT seller_id, sku, 'UPDATE' AS operation, p_size AS quantity,
          CASE WHEN pack > 1 AND nt IS NOT NULL THEN greatest({_RM.format(x="nt")}, {_RM.format(x="retail")})
               ELSE {_RM.format(x="p2")} END AS our_price
        FROM g WHERE p2 IS NOT NULL),
del AS (SELECT seller_id, CAST(p_partkey AS VARCHAR) AS sku, 'DELETE' AS operation, CAST(NULL AS INTEGER) AS quantity,
          CAST(NULL AS DOUBLE) AS our_price FROM pairs JOIN part USING (p_partkey) WHERE min_discount >= 0.09 OR p_size < 5),
allm AS (SELECT *, row_number() OVER (PARTITION BY seller_id
                     ORDER BY CASE WHEN operation = 'DELETE' THEN 1 ELSE 0 END, sku) AS message_id
         FROM (SELECT * FROM upd UNION ALL SELECT * FROM del))
SELECT seller_id, sku, message_id, CAST((message_id - 1) // 10000 AS BIGINT) AS chunk_id, operation, our_price, quantity
FROM allm
""")
def q_catalog_sync(spark, sf):
    """The whole feed-planning job for all sellers at once: suppliers
    are sellers, the parts each supplier ships are its products, part data gives identifiers,
    lineitem rows give overrides, shipped-before-1997 pairs give history, and every shipped pair is
    live (pairs with a high discount are no longer offered and small parts fail the MPN match, so
    both are deleted)."""
    from adspark.plans.sync import plan_feed
    li, p = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    # The seller x product table is an input table of the job: derive it once and keep it in the
    # shared checkpoint folder (products, live listing and history all read it).
    pairs = kept_table(li.groupBy("l_suppkey", F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_discount").alias("min_discount"), F.min("l_shipdate").alias("first_ship")).select(
        F.col("l_suppkey").cast("string").alias("seller_id"), "p_partkey", "min_discount", "first_ship"), "pairs")
    products = pairs.filter("min_discount < 0.09").join(p, "p_partkey").select(
        "seller_id", F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"), (F.col("p_retailprice") * 0.5).cast("string").alias("cost"),
        (F.col("p_retailprice") * 0.6).cast("string").alias("fulfillment_cost"), F.lit("0.2").alias("requested_margin"),
        F.col("p_retailprice").cast("string").alias("retail_price"), F.lit("").alias("map_price"),
        F.col("p_size").cast("string").alias("quantity"), F.lit("1").alias("uom"),
        F.lit("Yes").alias("push_to_marketplace"), F.lit("Yes").alias("push_to_site"))
    ids = p.select(F.col("p_partkey").cast("string").alias("sku"),
                   F.concat(F.lit("B0"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("asin"),
                   F.lit("0.15").alias("referral_fee"),
                   F.when(F.col("p_size") < 5, F.lit("false")).otherwise(F.lit("true")).alias("mpn_match"),
                   (F.floor(F.col("p_size") / 10) + 1).cast("string").alias("number_of_items"))
    ov = li.select(F.col("l_suppkey").cast("string").alias("seller_id"), F.col("l_partkey").cast("string").alias("sku"),
                   (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
                   F.when(F.col("l_returnflag") == "R", F.concat(F.lit("T"), F.col("l_orderkey").cast("string")))
                   .alias("title"),
                   F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice").cast("string")).alias("map_price"))
    rules = p.select("p_brand").distinct().select(F.lower("p_brand").alias("brand_name"),
                                                  F.lit("0.1").alias("map_fraction"),
                                                  F.lit(None).cast("string").alias("push_to_marketplace"),
                                                  F.lit("Yes").alias("push_to_site"))
    history = pairs.filter(F.col("first_ship") < _ts("1997-01-01")).select(
        "seller_id", F.col("p_partkey").cast("string").alias("sku"), F.lit("processed").alias("status"),
        F.lit(None).cast("string").alias("product_hash"), _ts("2001-05-01").alias("ended_at"))
    live = pairs.select("seller_id", F.col("p_partkey").cast("string").alias("sku"))
    plan = plan_feed(products, ids, ov, rules, None, history, live, batch_id=BATCH_ID, now=_now(), seed="2001-06-01")
    m = F.from_json("message_json", "operationType string, attributes struct<purchasable_offer: array<struct<our_price: array<struct<"
                    "schedule: array<struct<value_with_tax: double>>>>>>, fulfillment_availability: array<struct<quantity: int>>>")
    sent = plan.messages.select("seller_id", "sku", "message_id", "chunk_id", m.alias("m"))
    offer = F.get(F.col("m.attributes.purchasable_offer"), F.lit(0))["our_price"]
    return sent.select(
        "seller_id", "sku", "message_id", "chunk_id", F.col("m.operationType").alias("operation"),
        F.get(F.get(offer, F.lit(0))["schedule"], F.lit(0))["value_with_tax"].alias("our_price"),
        F.get(F.col("m.attributes.fulfillment_availability"), F.lit(0))["quantity"].alias("quantity"))


# Suppliers are sellers, the parts that they ship their live SKUs. A part is offered while its least
# discount is low; in some nations only without discount, so their sellers may pass the delete guard.
# Sellers of negative balance have two rules for a brand.
_SELLERS_SQL = """
WITH pairs AS (SELECT l_suppkey, l_partkey, min(l_discount) AS least FROM lineitem GROUP BY l_suppkey, l_partkey),
s AS (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS seller_id, s_acctbal, s_nationkey FROM supplier),
p AS (SELECT s.*, CAST(l_partkey AS VARCHAR) AS sku, least < CASE WHEN s_nationkey < 8 THEN 0.005 ELSE 0.09 END AS offered
      FROM pairs JOIN s ON s_suppkey = l_suppkey),
n AS (SELECT seller_id, count(*) AS n, count(*) FILTER (WHERE NOT offered) AS d FROM p GROUP BY seller_id),
failed AS (
  SELECT DISTINCT seller_id, 'more than one brand rule for ' || (SELECT min(lower(p_brand)) FROM part) AS error FROM p WHERE s_acctbal < 0
  UNION ALL SELECT n.seller_id, 'refusing to delete ' || d || ' of ' || n || ' live SKUs' FROM n JOIN s USING (seller_id)
  WHERE d > 0.5 * n AND s_acctbal >= 0)
"""


def _seller_inputs(spark, sf):
    """Products, identifiers, rules, listing and suppliers of ``_SELLERS_SQL``."""
    ensure_checkpoint_dir(spark)
    s, part = _t(spark, sf, "supplier"), _t(spark, sf, "part")
    least = _t(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.min("l_discount").alias("least"))
    pairs = least.join(s, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("s_suppkey").cast("string").alias("seller_id"), F.col("l_partkey").alias("p_partkey"),
        (F.col("least") < F.when(F.col("s_nationkey") < 8, 0.005).otherwise(0.09)).alias("offered"))
    pairs = kept_table(pairs, "pairs")
    text = {"cost": "8", "fulfillment_cost": "10", "requested_margin": "0.2", "map_price": "", "uom": "1", "push_to_marketplace": "Yes", "push_to_site": "Yes"}
    products = pairs.filter("offered").join(part, "p_partkey").select(
        "seller_id", F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("string").alias("retail_price"), F.col("p_size").cast("string").alias("quantity"),
        *[F.lit(v).alias(k) for k, v in text.items()])
    ids = part.select(F.col("p_partkey").cast("string").alias("sku"), F.format_string("B0%08d", "p_partkey").alias("asin"),
                      F.lit("0.15").alias("referral_fee"), F.lit("true").alias("mpn_match"), F.lit("1").alias("number_of_items"))
    brand = part.agg(F.min("p_brand")).first()[0]
    spellings = F.when(F.col("s_acctbal") < 0, F.array(F.lower(F.lit(brand)), F.upper(F.lit(brand)))).otherwise(F.array(F.lit(brand)))
    rules = s.select(F.col("s_suppkey").cast("string").alias("seller_id"), F.explode(spellings).alias("brand_name"), F.lit("0.1").alias("map_fraction"),
                     F.lit(None).cast("string").alias("push_to_marketplace"), F.lit("Yes").alias("push_to_site"))
    live = pairs.select("seller_id", F.col("p_partkey").cast("string").alias("sku"))
    return products, ids, rules, live, s


@query("catalog_quarantine", _SELLERS_SQL + """
SELECT seller_id, sku, CASE WHEN offered THEN 'UPDATE' ELSE 'DELETE' END AS operation, CAST(NULL AS VARCHAR) AS error
FROM p WHERE seller_id NOT IN (SELECT seller_id FROM failed)
UNION ALL SELECT seller_id, NULL, NULL, error FROM failed
UNION ALL SELECT seller_id, NULL, NULL, 'more than one brand rule for ' || (SELECT min(lower(p_brand)) FROM part) FROM s
WHERE s_acctbal < 0 AND seller_id NOT IN (SELECT seller_id FROM p)
""")
def q_catalog_quarantine(spark, sf):
    """``plan_feed`` with quarantine: sellers with ambiguous rules or too many deletes come back as errors,
    every other seller gets its messages."""
    from adspark.plans.sync import plan_feed
    products, ids, rules, live, _ = _seller_inputs(spark, sf)
    history = spark.createDataFrame([], "seller_id string, sku string, status string, product_hash string, ended_at timestamp")
    plan = plan_feed(products, ids, None, rules, None, history, live, batch_id=BATCH_ID, now=_now(), seed="2001-06-01", quarantine=True)
    sent = plan.messages.select("seller_id", "sku", F.get_json_object("message_json", "$.operationType").alias("operation"), F.lit(None).cast("string").alias("error"))
    return sent.unionByName(plan.errors.select("seller_id", F.lit(None).cast("string").alias("sku"), F.lit(None).cast("string").alias("operation"), "error"))


@query("run_table", _SELLERS_SQL + f""",
u AS (SELECT *, seller_id IN (SELECT seller_id FROM p) AS ships, s_nationkey % 6 = 5 AS lacks FROM s),
r AS (
  SELECT u.seller_id, CASE WHEN lacks THEN 'incomplete' WHEN s_acctbal < 0 OR failed.error IS NOT NULL THEN 'error' WHEN NOT ships THEN 'no_data'
      WHEN s_nationkey % 5 = 0 THEN 'error' WHEN s_nationkey % 5 = 1 THEN 'completed_with_errors' WHEN s_nationkey % 5 = 2 THEN 'running' ELSE 'completed' END AS status,
    CASE WHEN lacks THEN 'missing: refresh_token' WHEN s_acctbal < 0 THEN 'more than one brand rule for ' || (SELECT min(lower(p_brand)) FROM part)
      WHEN failed.error IS NOT NULL THEN failed.error WHEN ships AND s_nationkey % 5 = 0 THEN 'unexpected result structure' END AS error
  FROM u LEFT JOIN failed ON failed.seller_id = u.seller_id),
o AS (SELECT count(*) AS sellers_total, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'error') AS errors,
        count(*) FILTER (WHERE status = 'no_data') AS no_data FROM r WHERE status <> 'incomplete')
SELECT '{BATCH_ID}' AS batch_id, seller_id, status, error, sellers_total, completed, errors, no_data FROM r, o
""")
def q_run_table(spark, sf):
    """``run_plan_feed`` from the eligible sellers, result documents for the sellers that got a feed,
    ``run_apply_feed``, then the run table and ``run_outcomes`` over it."""
    from adspark.plans.sync import read_run, run_apply_feed, run_plan_feed
    from pyspark.sql.types import _parse_datatype_string
    products, ids, rules, live, s = _seller_inputs(spark, sf)
    root = _scratch(spark, "run")
    user = F.col("s_suppkey").cast("string")
    users = s.select(user.alias("id"), F.lit(False).alias("is_superuser"))
    oauth = s.select(user.alias("user_id"), F.lit("a").alias("access_token"), F.when(F.col("s_nationkey") % 6 != 5, F.lit("r")).alias("refresh_token"))
    channels = s.select(user.alias("user_id"), F.concat(F.lit("SP"), user).alias("selling_partner_id"))
    history = _parse_datatype_string("sku string, batch_id string, seller_id string, asin string, title string, price double, status string, "
                                     "started_at timestamp, ended_at timestamp, error_description string, product_hash string")
    batches = _parse_datatype_string("batch_id string, seller_id string, total_messages bigint, status string, failed_message string, "
                                     "successful_messages bigint, started_at timestamp, ended_at timestamp")
    kw = dict(history_path=f"{root}/history", history_schema=history, batches_path=f"{root}/batches", batches_schema=batches,
              staging_root=f"{root}/staging", batch_id=BATCH_ID, now=_now(), runs_path=f"{root}/runs")
    plan = run_plan_feed(products, ids, None, rules, None, live, feed_path=f"{root}/feed", seed="2001-06-01", sellers=(users, oauth, channels), **kw)
    kind = F.col("s_nationkey") % 5
    n, bad = F.col("n"), F.when(kind == 1, 1).otherwise(0)
    doc = F.to_json(F.struct(F.create_map(F.lit("sellerId"), F.col("seller_id")).alias("header"), F.array().cast("array<struct<messageId:string>>").alias("issues"),
                             F.struct(n.alias("messagesProcessed"), (n - bad).alias("messagesAccepted"), bad.alias("messagesInvalid")).alias("summary")))
    sent = plan.messages.groupBy("seller_id").agg(F.count("*").alias("n")).join(s.withColumn("seller_id", user), "seller_id").filter(kind != 2)
    FD.store_results(sent.select("seller_id", F.concat_ws("-", F.lit(BATCH_ID), "seller_id").alias("feed_id"),
                                 F.when(kind == 0, F.lit("{")).otherwise(doc).alias("value")), f"{root}/results")
    run_apply_feed(spark, f"{root}/results", plan.messages, stored=True, **kw)
    rows = read_run(spark, f"{root}/runs", BATCH_ID)
    counted = A.run_outcomes(rows.filter("status <> 'incomplete'")).withColumnRenamed("error", "errors").withColumn("batch_id", F.lit(BATCH_ID))
    return rows.select("batch_id", "seller_id", "status", "error").join(counted, "batch_id")


@query("feed_fold_back", "WITH " + _HISTORY_SQL + f""",
ids AS (SELECT seller_id, sku, row_number() OVER (PARTITION BY seller_id ORDER BY sku) AS message_id
        FROM h WHERE batch_id = 'B2'),
iss AS (SELECT CAST(user_id AS VARCHAR) AS seller_id, CAST(day(ts) AS BIGINT) AS messageId, event_id,
          CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' END AS severity,
          event_type AS attributeName, props AS message FROM events),
per AS (SELECT seller_id, messageId, bool_or(severity = 'ERROR') AS err,
          string_agg(COALESCE(attributeName, 'Unknown attribute') || ': ' || COALESCE(message, 'No message'), '; '
                     ORDER BY event_id) FILTER (WHERE severity = 'ERROR') AS txt
        FROM iss GROUP BY seller_id, messageId),
res AS (SELECT per.seller_id, ids.sku, CASE WHEN err THEN 'failed' ELSE 'success' END AS rstatus,
          CASE WHEN err THEN txt ELSE '' END AS rerr
        FROM per JOIN ids ON ids.seller_id = per.seller_id AND ids.message_id = per.messageId)
SELECT h.sku, h.batch_id, h.seller_id, h.asin, h.title, h.price,
  CASE WHEN res.sku IS NOT NULL THEN res.rstatus WHEN h.batch_id = 'B2' THEN 'processed' ELSE h.status END AS status,
  h.started_at, CASE WHEN h.batch_id = 'B2' THEN TIMESTAMP '{NOW}' ELSE h.ended_at END AS ended_at,
  CASE WHEN res.sku IS NOT NULL THEN res.rerr ELSE h.error_description END AS error_description, h.product_hash
FROM h LEFT JOIN res ON res.seller_id = h.seller_id AND res.sku = h.sku AND h.batch_id = 'B2'
""")
def q_feed_fold_back(spark, sf):
    """The feed fold-back job: orders are the change history of batches
    B1 / B2, message ids number each seller's B2 rows, and one feed result document per (user,
    day) of events reports issues for message id = day of month (events are the issues)."""
    from adspark.plans.sync import apply_feed
    hist = _history(spark, sf)
    ids = K.message_ids(hist.filter("batch_id = 'B2'").select("seller_id", "sku", F.lit("UPDATE").alias("kind")),
                        by=("seller_id",), order=("kind_rank", "sku")).select("seller_id", "sku", "message_id")
    e = _t(spark, sf, "events")
    et = F.col("event_type")
    issue = F.struct(F.col("event_id").alias("id"), F.struct(
        F.dayofmonth("ts").cast("string").alias("messageId"),
        F.when(et == "error", F.lit("ERROR")).when(et == "view", F.lit("WARNING")).alias("severity"),
        et.alias("attributeName"), F.col("props").alias("message")).alias("issue"))
    docs = e.groupBy(F.col("user_id").cast("string").alias("seller_id"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.sort_array(F.collect_list(issue)).alias("_issues"), F.count(F.lit(1)).alias("n"),
        F.count_if(et == "error").alias("bad"))
    body = F.to_json(F.struct(F.struct(F.col("seller_id").alias("sellerId")).alias("header"),
                              F.col("_issues.issue").alias("issues"),
                              F.struct(F.col("n").alias("messagesProcessed"),
                                       (F.col("n") - F.col("bad")).alias("messagesAccepted"),
                                       F.col("bad").alias("messagesInvalid")).alias("summary")))
    raw = docs.select("seller_id", F.lit("B2").alias("batch_id"), F.concat_ws("-", "seller_id", "day").alias("feed_id"),
                      body.alias("value"))
    batches = hist.select("batch_id", "seller_id").distinct().select(
        "batch_id", "seller_id", F.lit(None).cast("bigint").alias("total_messages"), F.lit("processing").alias("status"),
        F.lit(None).cast("string").alias("failed_message"), F.lit(None).cast("bigint").alias("successful_messages"),
        F.lit(None).cast("timestamp_ntz").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("ended_at"))
    new_history, _, _ = apply_feed(hist, batches, raw, ids, batch_id="B2", now=_now())
    return _ntz(new_history)


def _entity_rows(c: DataFrame) -> DataFrame:
    return c.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("_profile_key"),
                    F.col("c_custkey").alias("adGroupId"), F.col("c_nationkey").alias("campaignId"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("state"),
                    F.col("c_acctbal").alias("defaultBid"),
                    F.struct(F.lit("ENABLED").alias("servingStatus")).alias("extendedData"))


@query("ingest_entity_snapshots", """
SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS profileId, c_custkey AS adGroupId, CAST(c_nationkey AS BIGINT) AS campaignId,
  c_name AS name, c_mktsegment AS state, c_acctbal AS defaultBid, 'ENABLED' AS servingStatus
FROM customer WHERE c_nationkey >= 5 OR c_acctbal > 0
""")
def q_ingest_entity_snapshots(spark, sf):
    """T-01, T-03 / L-02 for entities: customers are SP ad groups, one profile per nation, each
    delivery of a profile split over several files. A first delivery holds every customer; a later one
    re-delivers nations 0-4 with only the customers in credit, which replaces those profiles'
    snapshots (key-bucketed partitions); of a third, for all nations, the last parts are missing, so
    it changes nothing."""
    from adspark.plans.ingest import read_table
    from adspark.streaming.ingest import ingest_stream, write_array_files
    root = _scratch(spark, "entities")
    c = _t(spark, sf, "customer")

    def deliver(rows: DataFrame, number: str, part: str = "*") -> None:
        write_array_files(_entity_rows(rows), f"{root}/out/{number}", root="entities", ad_type="SP", name="adgroup", country="US",
                          profile="_profile_key", delivery=number, files_per_group=4)
        # the delivery's files, or those of some parts, arrive in the landing folder
        fs, _, jvm = L._fs(spark, root)
        for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/out/{number}/delivery=*/part={part}")):
            source = found.getPath()
            target = jvm.org.apache.hadoop.fs.Path(f"{root}/landing/{source.getParent().getName()}/{source.getName()}")
            fs.mkdirs(target.getParent())
            fs.rename(source, target)

    def ingest() -> None:
        ingest_stream(spark, f"{root}/landing", tables_root=f"{root}/tables", checkpoint=f"{root}/_checkpoint", kind="entity", now=_now()).awaitTermination()

    deliver(c, "d1")
    ingest()
    deliver(c.filter("c_nationkey < 5 AND c_acctbal > 0"), "d2")
    deliver(c.withColumn("c_name", F.lit("lost")), "d3", part="1-of-*")
    ingest()
    t = read_table(spark, f"{root}/tables", get_spec("entity", "SP", "adgroup"))
    return t.select("profileId", "adGroupId", "campaignId", "name", "state", "defaultBid", "servingStatus")


def _report_rows(o: DataFrame) -> DataFrame:
    year = F.date_format("o_orderdate", "yyyy")
    return o.select(F.concat(F.lit("P"), F.col("o_orderstatus")).alias("_profile_key"), F.concat(year, F.lit("0101-"), year, F.lit("1231")).alias("_dates_key"),
                    F.col("o_orderkey").alias("campaignId"), F.date_format("o_orderdate", "yyyy-MM-01").alias("date"), "o_orderpriority", F.col("o_totalprice").alias("cost"))


@query("ingest_strict", """
SELECT 'loaded' AS status, 'P' || o_orderstatus AS profile, count(*) AS n FROM orders WHERE year(o_orderdate) % 2 = 0 GROUP BY ALL
UNION ALL
SELECT DISTINCT 'UNREADABLE', 'P' || o_orderstatus, NULL::BIGINT FROM orders WHERE year(o_orderdate) % 2 = 1
""")
def q_ingest_strict(spark, sf):
    """I-01: reports whose text goes on after the array (those of the odd years) are rejected, not cut."""
    from adspark.streaming.ingest import write_array_files
    root, prefix = _scratch(spark, "strict"), _prefix()
    rows = _report_rows(_t(spark, sf, "orders")).drop("o_orderpriority")
    odd = F.substring("_dates_key", 1, 4).cast("int") % 2 == 1
    write_array_files(rows.withColumn("_tail", F.when(odd, "[]")), f"{root}/landing/a", root="reports", ad_type="SP", name="campaign", country="US",
                      profile="_profile_key", dates="_dates_key", tail="_tail")
    _ingest(spark, f"{root}/landing", root, database=prefix)
    loaded = _stream_result(spark, f"{root}/tables", database=prefix).groupBy(F.lit("loaded").alias("status"), F.col("profileId").alias("profile")).agg(F.count("*").alias("n"))
    rejects = path_metadata(spark.read.parquet(f"{root}/tables/_rejects")).select("status", F.col("_profile_id").alias("profile"), F.lit(None).cast("long").alias("n"))
    return loaded.unionByName(rejects.distinct())


@query("ingest_quality", """
SELECT '*' AS "column", 'rows' AS kind, count(*)::BIGINT AS n FROM orders
UNION ALL SELECT 'cost', 'rejected', count(*)::BIGINT FROM orders WHERE o_orderpriority = '1-URGENT' HAVING count(*) > 0
UNION ALL SELECT 'clicks', 'rejected', count(*)::BIGINT FROM orders WHERE o_orderpriority IN ('2-HIGH', '5-LOW') HAVING count(*) > 0
UNION ALL SELECT DISTINCT 'newMetric', 'dropped', NULL::BIGINT FROM orders
UNION ALL SELECT DISTINCT 'other_one', 'dropped', NULL::BIGINT FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def q_ingest_quality(spark, sf):
    """N-03, N-05: values that did not convert and columns that the table lacks, as the load kept them."""
    from adspark.streaming.ingest import write_array_files
    root, prefix = _scratch(spark, "quality"), _prefix()
    kind = F.col("o_orderpriority")
    rows = _report_rows(_t(spark, sf, "orders")).withColumns({
        "cost": F.when(kind == "1-URGENT", "n/a").otherwise(F.col("cost").cast("string")),
        "clicks": F.when(kind == "2-HIGH", "many").when(kind == "5-LOW", "1e").when(kind == "3-MEDIUM", "").otherwise("7"),
        "newMetric": F.lit(1), "other one": F.when(kind == "2-HIGH", F.lit(2))}).drop("o_orderpriority")
    write_array_files(rows, f"{root}/landing/a", root="reports", ad_type="SP", name="campaign", country="US", profile="_profile_key", dates="_dates_key")
    _ingest(spark, f"{root}/landing", root, database=prefix)
    return spark.read.parquet(f"{root}/tables/_load_quality").select("column", "kind", "n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
