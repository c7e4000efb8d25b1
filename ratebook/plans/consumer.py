"""The documented consumer queries, over live or history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.exprs import attribute
from ratebook.operators.compose import pair_counts


def _with(live: DataFrame, service: str, attributes: dict[str, str]) -> DataFrame:
    rows = live.where((F.col("service_code") == service) & (F.col("term_type") == "OnDemand"))
    for key, value in attributes.items():
        rows = rows.where(attribute(F.col("attributes"), key) == value)
    return rows


def json_column_sample(
    live: DataFrame,
    service: str,
    region: str,
    keys: dict[str, str],
    limit: int = 20,
    order_by: tuple[str, ...] = (),
) -> DataFrame:
    """Attributes as columns for one service and region: any rows, or the first."""
    names = {column: attribute(F.col("attributes"), key) for key, column in keys.items()}
    rows = (
        _with(live, service, {})
        .where(F.col("region_code") == region)
        .select(
            "region_code", *[c.alias(n) for n, c in names.items()], "price_per_unit"
        )
    )
    return (rows.orderBy(*order_by) if order_by else rows).limit(limit)


def rows_by_service_region(live: DataFrame, limit: int = 10) -> DataFrame:
    """Largest (service, region) pairs; ties are broken by name."""
    return (
        pair_counts(live)
        .orderBy(F.desc("rows"), "service_code", "region_code")
        .limit(limit)
    )


def point_price_lookup(
    live: DataFrame, service: str, attributes: dict[str, str], shown: str, column: str
) -> DataFrame:
    """One product's price in every region."""
    return (
        _with(live, service, attributes)
        .select(
            "region_code",
            attribute(F.col("attributes"), shown).alias(column),
            "price_per_unit",
            "unit",
        )
        .orderBy("region_code")
    )


def attribute_listing(live: DataFrame, service: str, key: str, column: str) -> DataFrame:
    """Prices of a service by region and one of its attributes."""
    return (
        _with(live, service, {})
        .select(
            "region_code",
            attribute(F.col("attributes"), key).alias(column),
            "price_per_unit",
            "unit",
        )
        .orderBy("region_code", column)
    )


def price_over_time(
    book, first: date, last: date, service: str, region: str, attributes: dict[str, str]
) -> DataFrame:
    """One product's price on each day of a range."""
    return (
        _with(book.read_history(between=(first, last)), service, attributes)
        .where(F.col("region_code") == region)
        .select("ingestion_date", "region_code", "price_per_unit")
        .orderBy("ingestion_date")
    )
