"""Declared schemas of documents and tables.  Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(38, 18)
TIER = T.DecimalType(38, 10)

# --- tables -----------------------------------------------------------------

HISTORY = T.StructType(
    [
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("service_code", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("publication_date", T.TimestampType()),
        T.StructField("offer_type", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("rate_code", T.StringType()),
        T.StructField("offer_term_code", T.StringType()),
        T.StructField("term_type", T.StringType()),
        T.StructField("price_per_unit", PRICE),
        T.StructField("currency", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("starting_range", TIER),
        T.StructField("ending_range", TIER),
        T.StructField("effective_date", T.DateType()),
        T.StructField("description", T.StringType()),
        T.StructField("product_family", T.StringType()),
        T.StructField("attributes", T.VariantType()),
        T.StructField("term_attributes", T.VariantType()),
        T.StructField("price_per_unit_raw", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source_url", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
LIVE = T.StructType([f for f in HISTORY.fields if f.name != "ingestion_date"])
# A file's own columns, and those that say which rows it holds.
PART = T.StructType([f for f in LIVE.fields if f.name != "service_code"])
PART_OF = T.StructType(
    [
        HISTORY["ingestion_date"],
        T.StructField("load", T.LongType()),
        HISTORY["service_code"],
    ]
)

VERSIONS = T.StructType(
    [
        T.StructField("service_code", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("offer_type", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("publication_date", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("source_url", T.StringType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("services_changed", T.LongType()),
        T.StructField("services_skipped", T.LongType()),
        T.StructField("service_filter", T.StringType()),
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("error", T.StringType()),
    ]
)
# The audit table is appended to, never updated: each row is one event of a run.
RUN_EVENTS = T.StructType([*RUNS.fields, T.StructField("event_seq", T.IntegerType())])

# Where the content of a table, or of a day's service, is, by publish.
POINTERS = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("service_code", T.StringType()),
        T.StructField("folder", T.StringType()),
    ]
)

# What discovery could not use, by run.
REJECTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("service_code", T.StringType()),
        T.StructField("offer_type", T.StringType()),
        T.StructField("index_path", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("record", T.StringType()),
    ]
)

# Spark drops NOT NULL on parquet tables, so writers check these themselves.
REQUIRED_HISTORY = (
    "ingestion_date",
    "service_code",
    "region_code",
    "version",
    "offer_type",
    "sku",
    "rate_code",
    "ingested_at",
)
REQUIRED_VERSIONS = ("service_code", "region_code", "offer_type", "version", "loaded_at")
REQUIRED_RUNS = ("run_id", "started_at", "status")

PAIR = ("service_code", "region_code")
VERSION_KEY = ("service_code", "region_code", "offer_type")
TARGET_KEY = (*VERSION_KEY, "version")
TARGET = (*TARGET_KEY, "offer_url")

# --- documents --------------------------------------------------------------
# `offer_url` is the landing directory's partition column.  `slice` numbers the
# self-contained parts of a document that was landed in more than one record.

_LANDED = "offer_url string, slice int"
_HEADER = (
    "formatVersion string, disclaimer string, offerCode string, "
    "version string, publicationDate string"
)
_TERM = (
    "struct<offerTermCode: string, effectiveDate: string, termAttributes: variant, "
    "priceDimensions: map<string, struct<rateCode: string, description: string, "
    "beginRange: string, endRange: string, unit: string, "
    "pricePerUnit: map<string, string>>>>"
)

OFFER_HEADER = f"{_LANDED}, {_HEADER}"


def service_offer(buckets: tuple[str, ...]) -> str:
    """Service document, reading only the given term buckets."""
    terms = ", ".join(f"{b}: map<string, map<string, {_TERM}>>" for b in buckets)
    return (
        f"{OFFER_HEADER}, "
        "products map<string, struct<productFamily: string, attributes: variant>>, "
        f"terms struct<{terms}>"
    )


# `products` stays text here: it is a list in some documents and a map in others.
PLAN_OFFER = (
    f"{OFFER_HEADER}, products string, "
    "terms struct<savingsPlan: array<struct<sku: string, description: string, "
    "effectiveDate: string, leaseContractLength: variant, "
    "rates: array<struct<rateCode: string, description: string, "
    "discountedRate: struct<price: string, unit: string>>>>>>"
)
PLAN_PRODUCT_LIST = (
    "array<struct<sku: string, productFamily: string, attributes: variant>>"
)
PLAN_PRODUCT_MAP = "map<string, struct<productFamily: string, attributes: variant>>"

MASTER_INDEX = "offers map<string, struct<currentRegionIndexUrl: string>>"
# `regions` stays text for the same reason.
REGION_INDEX = "index_path string, regions string, _corrupt_record string"
REGION_MAP = "map<string, struct<currentVersionUrl: string, versionUrl: string>>"
REGION_LIST = (
    "array<struct<regionCode: string, currentVersionUrl: string, versionUrl: string>>"
)
