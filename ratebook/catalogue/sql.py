"""Shared pieces of the check SQL."""

from __future__ import annotations

BASE = "https://prices.example.com"
SLICE = "o_orderkey // 65536"
FILE_SLICE = "o_orderkey // 2097152"

SALES = """
sales AS (
  SELECT o.*, c.*, n.n_nationkey, n.n_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

PRICE_TEXT = """CASE WHEN o_orderkey % 14 = 3
  THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || 'E-2'
  ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END"""

PLAN_CODE = """CASE c_custkey % 3 WHEN 0 THEN 'AWSComputeSavingsPlan'
  WHEN 1 THEN 'AWSDatabaseSavingsPlans' ELSE 'AWSMachineLearningSavingsPlans' END"""

EFFECTIVE = """CASE WHEN c_custkey % 9 > 1
  THEN '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END"""

HAS_PRODUCT = "c_custkey % 11 <> 0"
HAS_ATTRIBUTES = "c_custkey % 11 <> 0 AND c_custkey % 17 <> 0"

PRODUCT_COLUMNS = f"""
  CASE WHEN {HAS_PRODUCT} AND c_custkey % 13 <> 0
    THEN c_mktsegment || ' family' END AS product_family,
  CASE WHEN {HAS_ATTRIBUTES} THEN c_name END AS customer"""

SERVICE_NAME = f"""CASE WHEN {HAS_ATTRIBUTES} AND c_custkey % 4 <> 3
  THEN 'Service ' || c_mktsegment END"""

PLAN_SKU = "c_custkey % 23 <> 0"


def service_url(version: str) -> str:
    return (
        f"'{BASE}/offers/v1.0/' || c_mktsegment || '/' || {version} || '/' || n_name "
        "|| '/index.json'"
    )


def plan_url(version: str) -> str:
    return (
        f"'{BASE}/savingsPlan/v1.0/aws/' || {PLAN_CODE} || '/' || {version} || '/' "
        "|| n_name || '/index.json'"
    )


def service_rows(version: str = "'20240115'", source: str = "sales") -> str:
    """Every price of the service documents as a history row."""
    return f"""
  SELECT '2024-02-01' AS ingestion_date, c_mktsegment AS service_code,
    {SERVICE_NAME} AS service_name, n_name AS region_code, {version} AS version,
    '2024-01-15 08:30:00' AS publication_date, 'service' AS offer_type,
    'C' || c_custkey AS sku,
    CASE WHEN o_orderkey % 10 IN (0, 1) THEN o_orderpriority
      ELSE 'RC' || o_orderkey END AS rate_code,
    'T' || left(o_orderpriority, 1) AS offer_term_code,
    CASE WHEN o_orderstatus = 'P' THEN 'Reserved' ELSE 'OnDemand' END AS term_type,
    CASE WHEN o_orderkey % 7 <> 2 THEN o_totalprice END AS price_per_unit,
    CASE o_orderkey % 7 WHEN 0 THEN 'CNY' WHEN 2 THEN NULL ELSE 'USD' END AS currency,
    'Hrs' AS unit,
    CASE o_orderkey % 6 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 12.5::DOUBLE END
      AS starting_range,
    CASE WHEN o_orderkey % 5 > 2 THEN o_orderkey::DOUBLE END AS ending_range,
    {EFFECTIVE} AS effective_date, 'order ' || o_orderkey AS description,
    {PRODUCT_COLUMNS},
    CASE WHEN {HAS_ATTRIBUTES} THEN 'class ' || (c_custkey % 6) END AS storage_class,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS purchase_option,
    CASE o_orderkey % 7 WHEN 1 THEN 2 WHEN 2 THEN NULL ELSE 1 END::BIGINT AS raw_prices,
    {service_url(version)} AS source_url, '2024-02-01 06:30:00' AS ingested_at
  FROM {source} WHERE o_orderkey % 19 <> 0"""


def plan_rows(version: str = "'20240115'", source: str = "sales") -> str:
    """Every rate of the plan documents as a history row."""
    return f"""
  SELECT '2024-02-01' AS ingestion_date, {PLAN_CODE} AS service_code,
    {SERVICE_NAME} AS service_name, n_name AS region_code, {version} AS version,
    '2024-01-15 08:30:00' AS publication_date, 'savings_plan' AS offer_type,
    'P' || c_custkey AS sku, 'RC' || o_orderkey AS rate_code,
    CAST(NULL AS VARCHAR) AS offer_term_code, 'SavingsPlan' AS term_type,
    CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice END AS price_per_unit,
    'USD' AS currency, CASE WHEN o_orderkey % 8 <> 0 THEN 'Hrs' END AS unit,
    CAST(NULL AS DOUBLE) AS starting_range, CAST(NULL AS DOUBLE) AS ending_range,
    {EFFECTIVE} AS effective_date,
    CASE WHEN o_orderkey % 3 = 2 THEN 'rate ' || o_orderkey
      WHEN c_custkey % 4 <> 0 THEN 'plan of ' || c_name END AS description,
    {PRODUCT_COLUMNS},
    CASE WHEN {HAS_ATTRIBUTES} THEN 'class ' || (c_custkey % 6) END AS storage_class,
    CAST(NULL AS VARCHAR) AS purchase_option,
    CASE WHEN o_orderkey % 8 <> 0 THEN 1 END::BIGINT AS raw_prices,
    {plan_url(version)} AS source_url, '2024-02-01 06:30:00' AS ingested_at
  FROM {source} WHERE {PLAN_SKU}"""


# --- index documents --------------------------------------------------------

NEWEST = """
newest AS (
  SELECT c_mktsegment, n_nationkey, n_name, max(o_orderkey) AS newest
  FROM sales GROUP BY ALL)"""

PLAN_NEWEST = f"""
plan_newest AS (
  SELECT {PLAN_CODE} AS code, n_name, max(o_orderkey) AS newest
  FROM sales GROUP BY ALL)"""

LISTED = "c_mktsegment IN ('BUILDING', 'MACHINERY')"
ENTRY = f"NOT ({LISTED} AND n_nationkey % 5 = 0)"

TARGETS = f"""
targets AS (
  SELECT c_mktsegment AS service_code, n_name AS region_code, 'service' AS offer_type,
    'v' || newest AS version, {service_url("'v' || newest")} AS offer_url
  FROM newest WHERE {ENTRY} AND n_nationkey % 7 <> 0
  UNION ALL
  SELECT code, n_name, 'savings_plan', 'p' || newest,
    '{BASE}/savingsPlan/v1.0/aws/' || code || '/p' || newest || '/' || n_name
      || '/index.json'
  FROM plan_newest)"""

WITH_TARGETS = f"WITH {SALES}, {NEWEST}, {PLAN_NEWEST}, {TARGETS}"
EVEN = "CAST(regexp_extract(region_code, '([0-9]+)$', 1) AS INTEGER) % 2 = 0"

# --- history from events ----------------------------------------------------

HISTORY = f"""
hist AS (
  SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date, event_type AS service_code,
    'region-' || (user_id % 10) AS region_code,
    'v' || strftime(ts, '%Y%m%d%H') AS version,
    CASE WHEN event_type = 'signup' THEN 'savings_plan' ELSE 'service' END AS offer_type,
    'U' || user_id AS sku, 'E' || event_id AS rate_code,
    CASE WHEN event_id % 3 = 0 THEN 'Reserved' ELSE 'OnDemand' END AS term_type,
    value AS price_per_unit, json_extract_string(props, '$.k') AS k,
    '{BASE}/offers/v1.0/' || event_type || '/v' || strftime(ts, '%Y%m%d%H')
      || '/region-' || (user_id % 10) || '/index.json' AS source_url,
    strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ingested_at
  FROM events)"""

SNAPSHOT = (
    "ingestion_date, service_code, region_code, version, offer_type, sku, rate_code, "
    "term_type, price_per_unit, k, source_url, ingested_at"
)
LIVE = SNAPSHOT.removeprefix("ingestion_date, ")
LAST = "(SELECT max(ingestion_date) FROM hist)"
BEFORE_LAST = f"(SELECT max(ingestion_date) FROM hist WHERE ingestion_date < {LAST})"
CHANGED_REGION = "region_code IN ('region-0', 'region-1', 'region-2')"

CHANGED_PAIRS = f"""
changed_pairs AS (
  SELECT DISTINCT service_code, region_code FROM hist
  WHERE ingestion_date = {LAST} AND {CHANGED_REGION})"""

IN_CHANGED = "(service_code, region_code) IN (SELECT (service_code, region_code) FROM changed_pairs)"

VERSION_OF = """
  SELECT service_code, region_code, offer_type,
    arg_max(version, ingested_at) AS version, max(ingested_at) AS publication_date,
    max(ingested_at) AS loaded_at, arg_max(source_url, ingested_at) AS source_url"""
