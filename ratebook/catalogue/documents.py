"""Documents landed from orders, customers and nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.catalogue import adapters as A
from ratebook.catalogue import sql as S
from ratebook.catalogue.registry import day, instant, query, shown
from ratebook.functions.exprs import attribute
from ratebook.operators import flatten
from ratebook.plans import consumer
from ratebook.scratch import new_folder
from ratebook.sources import ndjson, offers

STAMP = {"run_date": A.RUN_DATE, "ingested_at": A.NOW}
_SERVICE = f"WITH {S.SALES} {S.service_rows()}"
_PLAN = f"WITH {S.SALES} {S.plan_rows()}"


def flat_services(spark, sf_dir, **landing):
    documents = A.service_documents(spark, sf_dir, **landing)
    reserved = landing.get("include_reserved", True)
    return flatten.flatten_service_offers(documents, include_reserved=reserved, **STAMP)


def flat_plans(spark, sf_dir):
    return flatten.flatten_plan_offers(A.plan_documents(spark, sf_dir), **STAMP)


def flat_all(spark, sf_dir):
    return flatten.flatten_all_offers(
        A.service_documents(spark, sf_dir), A.plan_documents(spark, sf_dir), **STAMP
    )


# --- scans ------------------------------------------------------------------


@query(
    f"""WITH {S.SALES}
    SELECT c_mktsegment AS service_code, n_name AS region_code,
      '2024-01-15 08:30:00' AS publication_date,
      count(DISTINCT CASE WHEN {S.HAS_PRODUCT} THEN c_custkey END) AS products,
      count(DISTINCT CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 19 <> 0
        THEN c_custkey END) AS on_demand_skus,
      count(DISTINCT CASE WHEN o_orderstatus = 'P' AND o_orderkey % 19 <> 0
        THEN c_custkey END) AS reserved_skus
    FROM sales GROUP BY c_mktsegment, n_name, {S.FILE_SLICE}
    UNION ALL
    SELECT 'SHELL', n_name, '2024-01-15 08:30:00', 0, 0, 0 FROM nation"""
)
def scan_service_offers(spark, sf_dir):
    """One JSON document per file."""
    documents = A.service_documents(spark, sf_dir, layout="file")

    def size(column):
        return F.size(column).cast("bigint")

    return documents.select(
        "service_code",
        "region_code",
        F.date_format(F.col("publicationDate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias(
            "publication_date"
        ),
        size("products").alias("products"),
        size("terms.OnDemand").alias("on_demand_skus"),
        size("terms.Reserved").alias("reserved_skus"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT {S.PLAN_CODE} AS service_code, n_name AS region_code,
      '20240115' AS document_version, count(DISTINCT c_custkey) AS plans
    FROM sales GROUP BY {S.PLAN_CODE}, n_name, {S.SLICE}"""
)
def scan_plan_offers(spark, sf_dir):
    return A.plan_documents(spark, sf_dir).select(
        "service_code",
        "region_code",
        "document_version",
        F.size("terms.savingsPlan").cast("bigint").alias("plans"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT {S.service_url("'20240115'")} AS offer_url,
      {S.SLICE} AS slice, 'v1.0' AS format_version, 'sample' AS disclaimer,
      c_mktsegment AS offer_code, '20240115' AS version,
      '2024-01-15T08:30:00Z' AS published
    FROM sales
    UNION ALL
    SELECT '{S.BASE}/offers/v1.0/SHELL/20240115/' || n_name || '/index.json', 0, 'v1.0',
      'sample', 'SHELL', '20240115', '2024-01-15T08:30:00Z' FROM nation"""
)
def scan_offer_header(spark, sf_dir):
    root = A.landed_services(spark, sf_dir)
    return offers.read_offer_headers(spark, root).select(
        "offer_url",
        F.col("slice").cast("bigint").alias("slice"),
        F.col("formatVersion").alias("format_version"),
        "disclaimer",
        F.col("offerCode").alias("offer_code"),
        "version",
        F.col("publicationDate").alias("published"),
    )


# --- flattening -------------------------------------------------------------


@query(_SERVICE)
def flatten_service_offers(spark, sf_dir):
    return shown(flat_services(spark, sf_dir))


@query(_SERVICE)
def flatten_service_offers_gz(spark, sf_dir):
    return shown(flat_services(spark, sf_dir, gzip=True))


@query(f"{_SERVICE} AND o_orderstatus <> 'P'")
def flatten_ondemand_only(spark, sf_dir):
    return shown(flat_services(spark, sf_dir, include_reserved=False))


@query(_PLAN)
def flatten_plan_offers(spark, sf_dir):
    return shown(flat_plans(spark, sf_dir))


@query(f"{_SERVICE} UNION ALL {S.plan_rows()}")
def flatten_all_offers(spark, sf_dir):
    return shown(flat_all(spark, sf_dir))


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT '2024-02-01' AS ingestion_date, c_mktsegment AS service_code,
      {S.SERVICE_NAME} AS service_name, n_name AS region_code, '20240115' AS version,
      '2024-01-15 08:30:00' AS publication_date, 'service' AS offer_type,
      'C' || c_custkey AS sku, {S.PRODUCT_COLUMNS},
      {S.service_url("'20240115'")} AS source_url, '2024-02-01 06:30:00' AS ingested_at,
      CASE WHEN o_orderstatus = 'P' THEN 'Reserved' ELSE 'OnDemand' END AS term_type,
      {S.SLICE} AS slice
    FROM sales WHERE o_orderkey % 19 <> 0"""
)
def base_row_projection(spark, sf_dir):
    skus = flatten.described(flatten.priced_entries(A.service_documents(spark, sf_dir)))
    base = flatten.base_columns(A.RUN_DATE, A.NOW)
    rows = skus.select(*[c.alias(n) for n, c in base.items()], "term_type", "slice")
    return rows.select(
        day("ingestion_date"),
        "service_code",
        "service_name",
        "region_code",
        "version",
        instant("publication_date"),
        "offer_type",
        "sku",
        "product_family",
        attribute(F.col("attributes"), "customer").alias("customer"),
        "source_url",
        instant("ingested_at"),
        "term_type",
        F.col("slice").cast("bigint").alias("slice"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT c_mktsegment AS service_code, n_name AS region_code,
      CASE WHEN o_orderstatus = 'P' THEN 'Reserved' ELSE 'OnDemand' END AS term_type,
      'C' || c_custkey AS sku, {S.PRODUCT_COLUMNS}, {S.SLICE} AS slice
    FROM sales WHERE o_orderkey % 19 <> 0"""
)
def terms_left_join_products(spark, sf_dir):
    entries = flatten.priced_entries(A.service_documents(spark, sf_dir))
    return flatten.described(entries).select(
        "service_code",
        "region_code",
        "term_type",
        "sku",
        "product_family",
        attribute(F.col("attributes"), "customer").alias("customer"),
        F.col("slice").cast("bigint").alias("slice"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT {S.PLAN_CODE} AS service_code, n_name AS region_code,
      'P' || c_custkey AS sku, {S.PRODUCT_COLUMNS}, {S.SLICE} AS slice
    FROM sales WHERE {S.PLAN_SKU}"""
)
def plan_left_join_products(spark, sf_dir):
    entries = flatten.plan_entries(A.plan_documents(spark, sf_dir))
    return flatten.described(entries).select(
        "service_code",
        "region_code",
        "sku",
        "product_family",
        attribute(F.col("attributes"), "customer").alias("customer"),
        F.col("slice").cast("bigint").alias("slice"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT {S.plan_url("'20240115'")} AS offer_url, {S.SLICE} AS slice,
      'P' || c_custkey AS sku, {S.PRODUCT_COLUMNS}
    FROM sales WHERE {S.PLAN_SKU} AND {S.HAS_PRODUCT}"""
)
def plan_products_index(spark, sf_dir):
    products = A.plan_documents(spark, sf_dir).select(
        "offer_url", "slice", F.explode(flatten.plan_products()).alias("sku", "product")
    )
    return flatten.described(products).select(
        "offer_url",
        F.col("slice").cast("bigint").alias("slice"),
        "sku",
        "product_family",
        attribute(F.col("attributes"), "customer").alias("customer"),
    )


@query(
    f"""WITH {S.SALES}
    SELECT DISTINCT {S.PLAN_CODE} AS service_code, n_name AS region_code,
      'P' || c_custkey AS sku, {S.SLICE} AS slice
    FROM sales WHERE {S.PLAN_SKU}"""
)
def filter_plan_without_sku(spark, sf_dir):
    entries = flatten.plan_entries(A.plan_documents(spark, sf_dir))
    return entries.select(
        "service_code", "region_code", "sku", F.col("slice").cast("bigint").alias("slice")
    )


@query(
    f"""WITH {S.SALES}, flat AS ({S.service_rows()})
    SELECT service_code, region_code, offer_type, source_url, count(*) AS rows_loaded
    FROM flat GROUP BY ALL"""
)
def rows_per_target(spark, sf_dir):
    return flatten.rows_per_target(flat_services(spark, sf_dir))


@query(
    f"""WITH {S.SALES}, flat AS ({S.service_rows()}),
    pairs AS (
      SELECT DISTINCT c_mktsegment AS service_code, n_name AS region_code
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL SELECT 'SHELL', n_name FROM nation)
    SELECT service_code, region_code, 'service' AS offer_type, '20240115' AS version
    FROM pairs
    WHERE (service_code, region_code) NOT IN
      (SELECT (service_code, region_code) FROM flat)"""
)
def empty_targets(spark, sf_dir):
    empty = flatten.empty_targets(
        A.service_targets(spark, sf_dir), flat_services(spark, sf_dir)
    )
    return empty.select(*schemas.TARGET_KEY)


@query(_SERVICE)
def sink_ndjson_roundtrip(spark, sf_dir):
    """Flattened rows to gzip NDJSON and back."""
    path = new_folder(spark, "ndjson")
    ndjson.write_ndjson(flat_services(spark, sf_dir), path)
    return shown(spark.read.schema(schemas.HISTORY).json(path))


# --- consumer queries over a loaded book ------------------------------------


def served(spark, sf_dir):
    """A live table that serves the flattened service documents."""

    def load(_path: str):
        book = A.new_book(spark, "served")
        day = STAMP["run_date"]
        book.commit(days={day: book.write_rows(flat_services(spark, sf_dir), day)}, live=day)
        return book

    return A.once(spark, sf_dir, "served", load).read_live()


@query(
    f"""WITH {S.SALES}, flat AS ({S.service_rows()} AND c_custkey % 50 = 7)
    SELECT region_code, 'type.7' AS instance_type, price_per_unit, unit FROM flat
    WHERE service_code = 'BUILDING' AND term_type = 'OnDemand' AND customer IS NOT NULL"""
)
def point_price_lookup(spark, sf_dir):
    looked_up = consumer.point_price_lookup(
        served(spark, sf_dir),
        "BUILDING",
        {"instanceType": "type.7"},
        "instanceType",
        "instance_type",
    )
    return looked_up.withColumn("price_per_unit", F.col("price_per_unit").cast("double"))


@query(
    f"""WITH {S.SALES}, flat AS ({S.service_rows()})
    SELECT region_code, storage_class, price_per_unit, unit FROM flat
    WHERE service_code = 'MACHINERY' AND term_type = 'OnDemand'"""
)
def attribute_listing(spark, sf_dir):
    listed = consumer.attribute_listing(
        served(spark, sf_dir), "MACHINERY", "storageClass", "storage_class"
    )
    return listed.withColumn("price_per_unit", F.col("price_per_unit").cast("double"))
