"""Nested offer documents -> history rows, one per price."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.functions import exprs as X

_CONTEXT = (
    "offer_url",
    "slice",
    "service_code",
    "region_code",
    "offer_type",
    "target_version",
    "document_version",
    "publicationDate",
)


def last_wins(members: Column | str) -> Column:
    """A map whose repeated keys have their last value, as a JSON object's members do."""
    return F.map_from_entries(F.map_entries(members))


def priced_entries(documents: DataFrame, *, include_reserved: bool = True) -> DataFrame:
    """One row per (bucket, sku) with a price: its map of terms, and its product.

    Terms and products are maps of the same document, or of the same slice, so they are
    zipped by sku where they are: nothing is shuffled.  A price without a product is kept, a
    product without a price is not.
    """
    buckets = ("OnDemand", "Reserved") if include_reserved else ("OnDemand",)
    no_products = F.map_from_arrays(F.array(), F.array()).cast(
        documents.select("products").schema[0].dataType
    )
    products = last_wins(F.coalesce("products", no_products))

    def zipped(bucket: str) -> Column:
        return F.map_zip_with(
            last_wins(F.col(f"terms.{bucket}")),
            "all_products",
            lambda _, priced, product: F.struct(
                priced.alias("priced"), product.alias("product")
            ),
        )

    parts = [
        F.struct(F.lit(bucket).alias("term_type"), zipped(bucket).alias("entries"))
        for bucket in buckets
    ]
    return (
        documents.withColumn("all_products", products)
        .select(*_CONTEXT, F.inline(F.array(*parts)))
        .select(*_CONTEXT, "term_type", F.explode("entries").alias("sku", "entry"))
        .where(F.col("entry.priced").isNotNull())
        .select(*_CONTEXT, "term_type", "sku", "entry.priced", "entry.product")
    )


def plan_products() -> Column:
    """A plan document's products by sku: they are a list in some documents, of whose entries
    the last one of a sku counts, and a map in others."""
    is_list = F.ltrim("products").startswith("[")
    listed = F.from_json(F.when(is_list, F.col("products")), schemas.PLAN_PRODUCT_LIST)
    named = F.from_json(F.when(~is_list, F.col("products")), schemas.PLAN_PRODUCT_MAP)
    entry = F.transform(
        F.filter(listed, lambda p: p["sku"] != ""),
        lambda p: F.struct(p["sku"], F.struct(p["productFamily"], p["attributes"])),
    )
    return F.coalesce(F.map_from_entries(entry), last_wins(named))


def plan_entries(documents: DataFrame) -> DataFrame:
    """One row per plan that has a sku, and its product.

    Products are looked up in the document's own map while the plans are unfolded, so nothing
    is shuffled.  A document names few skus; its many rates are inside the plans.
    """
    with_sku = F.filter("terms.savingsPlan", lambda plan: plan["sku"] != "")
    entries = F.transform(
        with_sku,
        lambda plan: F.struct(
            plan["sku"].alias("sku"),
            plan.alias("priced"),
            F.try_element_at("all_products", plan["sku"]).alias("product"),
        ),
    )
    return documents.withColumn("all_products", plan_products()).select(
        *_CONTEXT, F.inline(entries)
    )


def described(entries: DataFrame) -> DataFrame:
    """Entries with the columns that come from their product; a price without one is kept."""
    return (
        entries.withColumn("product_family", F.col("product.productFamily"))
        .withColumn("attributes", X.json_or_null(F.col("product.attributes")))
        .withColumn("service_name", X.service_name(F.col("attributes")))
        .drop("product")
    )


def service_rates(rows: DataFrame) -> DataFrame:
    """Explode sku -> term -> price dimension; of repeated members the last counts."""
    terms = rows.select("*", F.explode(last_wins("priced")).alias("term_id", "term")).drop(
        "priced"
    )
    return (
        terms.withColumn("term_attributes", X.json_or_null(F.col("term.termAttributes")))
        .withColumn("offer_term_code", F.col("term.offerTermCode"))
        .withColumn("effective_date", X.effective_date(F.col("term.effectiveDate")))
        .select("*", F.explode(last_wins("term.priceDimensions")).alias("rate_id", "rate"))
        .drop("term")
    )


def base_columns(run_date: date, ingested_at: datetime) -> dict[str, Column]:
    """Columns that both kinds of document fill the same way."""
    return {
        "ingestion_date": F.lit(run_date),
        "service_code": F.col("service_code"),
        "service_name": F.col("service_name"),
        "region_code": F.col("region_code"),
        "version": X.effective_version(
            F.col("target_version"), F.col("document_version")
        ),
        "publication_date": X.publication_ts(F.col("publicationDate")),
        "offer_type": F.col("offer_type"),
        "sku": F.col("sku"),
        "product_family": F.col("product_family"),
        "attributes": F.col("attributes"),
        "source_url": F.col("offer_url"),
        "ingested_at": F.lit(ingested_at).cast("timestamp"),
    }


def _history_rows(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return rows.select(*[columns[f.name].alias(f.name) for f in schemas.HISTORY])


def flatten_service_offers(
    documents: DataFrame,
    *,
    run_date: date,
    ingested_at: datetime,
    include_reserved: bool = True,
) -> DataFrame:
    """Service documents (with target columns) -> history rows."""
    entries = priced_entries(documents, include_reserved=include_reserved)
    rates = service_rates(described(entries))
    rates = rates.withColumn("prices", last_wins("rate.pricePerUnit"))
    prices = F.col("prices")
    columns = base_columns(run_date, ingested_at) | {
        "rate_code": X.rate_code(F.col("rate.rateCode"), F.col("term_id")),
        "offer_term_code": F.col("offer_term_code"),
        "term_type": F.col("term_type"),
        "price_per_unit": X.exact_price(X.picked_price(prices)),
        "currency": X.picked_currency(prices),
        "unit": F.col("rate.unit"),
        "starting_range": X.tier_bound(F.col("rate.beginRange")),
        "ending_range": X.tier_bound(F.col("rate.endRange")),
        "effective_date": F.col("effective_date"),
        "description": F.col("rate.description"),
        "term_attributes": F.col("term_attributes"),
        "price_per_unit_raw": X.map_or_null(prices),
    }
    return _history_rows(rates, columns)


def plan_rates(rows: DataFrame) -> DataFrame:
    """Explode plan -> rate."""
    return (
        rows.withColumn(
            "term_attributes",
            X.plan_term_attributes(
                F.col("priced.leaseContractLength"),
                F.col("priced.description"),
                F.col("priced.effectiveDate"),
            ),
        )
        .withColumn("effective_date", X.effective_date(F.col("priced.effectiveDate")))
        .withColumn("plan_description", F.col("priced.description"))
        .select("*", F.explode("priced.rates").alias("rate"))
        .drop("priced")
    )


def flatten_plan_offers(
    documents: DataFrame, *, run_date: date, ingested_at: datetime
) -> DataFrame:
    """Plan documents (with target columns) -> history rows."""
    rates = plan_rates(described(plan_entries(documents)))
    price = F.col("rate.discountedRate.price")
    columns = base_columns(run_date, ingested_at) | {
        "rate_code": F.col("rate.rateCode"),
        "offer_term_code": F.lit(None).cast("string"),
        "term_type": F.lit("SavingsPlan"),
        "price_per_unit": X.exact_price(price),
        "currency": F.lit(X.USD),
        "unit": F.col("rate.discountedRate.unit"),
        "starting_range": F.lit(None).cast(schemas.TIER),
        "ending_range": F.lit(None).cast(schemas.TIER),
        "effective_date": F.col("effective_date"),
        "description": X.description(F.col("rate.description"), F.col("plan_description")),
        "term_attributes": F.col("term_attributes"),
        "price_per_unit_raw": X.plan_raw_price(price),
    }
    return _history_rows(rates, columns)


def flatten_all_offers(
    service_documents: DataFrame,
    plan_documents: DataFrame,
    *,
    run_date: date,
    ingested_at: datetime,
    include_reserved: bool = True,
) -> DataFrame:
    """Dispatch by kind: each kind has its own pipeline, the rows are one table."""
    services = flatten_service_offers(
        service_documents,
        run_date=run_date,
        ingested_at=ingested_at,
        include_reserved=include_reserved,
    )
    plans = flatten_plan_offers(
        plan_documents, run_date=run_date, ingested_at=ingested_at
    )
    return services.unionByName(plans)


def rows_per_target(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*schemas.VERSION_KEY, "source_url").agg(
        F.count(F.lit(1)).alias("rows_loaded")
    )


def empty_targets(targets: DataFrame, loaded: DataFrame) -> DataFrame:
    """Targets whose document produced no row."""
    found = loaded.select(
        *schemas.VERSION_KEY, F.col("source_url").alias("offer_url")
    ).distinct()
    return targets.join(found, [*schemas.VERSION_KEY, "offer_url"], "left_anti")
