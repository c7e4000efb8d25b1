"""Registered queries, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.catalogue.adapters import table_bytes
from ratebook.functions.exprs import attribute
from ratebook.session import configure, size_shuffles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sf_dir = sf_dir.rstrip("/")
            size_shuffles(configure(spark), table_bytes(spark, sf_dir))
            return make(spark, sf_dir)

        QUERIES[make.__name__] = run
        ORACLE[make.__name__] = sql
        return make

    return register


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def instant(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def number(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def shown(rows: DataFrame) -> DataFrame:
    """History rows in types every engine prints alike."""
    raw = F.col("price_per_unit_raw")
    return rows.select(
        day("ingestion_date"),
        "service_code",
        "service_name",
        "region_code",
        "version",
        instant("publication_date"),
        "offer_type",
        "sku",
        "rate_code",
        "offer_term_code",
        "term_type",
        number("price_per_unit"),
        "currency",
        "unit",
        number("starting_range"),
        number("ending_range"),
        day("effective_date"),
        "description",
        "product_family",
        attribute(F.col("attributes"), "customer").alias("customer"),
        attribute(F.col("attributes"), "storageClass").alias("storage_class"),
        attribute(F.col("term_attributes"), "PurchaseOption").alias("purchase_option"),
        F.when(raw.isNotNull(), F.size(raw)).cast("bigint").alias("raw_prices"),
        "source_url",
        instant("ingested_at"),
    )


def shown_snapshot(rows: DataFrame) -> DataFrame:
    """Event-based history rows, the columns that vary."""
    return rows.select(
        day("ingestion_date"),
        "service_code",
        "region_code",
        "version",
        "offer_type",
        "sku",
        "rate_code",
        "term_type",
        number("price_per_unit"),
        attribute(F.col("attributes"), "k").alias("k"),
        "source_url",
        instant("ingested_at"),
    )


def shown_live(rows: DataFrame) -> DataFrame:
    dated = rows.withColumn("ingestion_date", F.lit(None).cast("date"))
    return shown_snapshot(dated).drop("ingestion_date")


def shown_versions(versions: DataFrame) -> DataFrame:
    return versions.select(
        "service_code",
        "region_code",
        "offer_type",
        "version",
        instant("publication_date"),
        instant("loaded_at"),
        "source_url",
    )
