"""Index documents -> targets (service, region, offer type, version, url)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.functions import exprs as X
from ratebook.sources import indexes as I


def service_jobs(
    services: DataFrame,
    plans: DataFrame,
    *,
    service_filter: str,
    include_plans: bool,
    with_index: bool = True,
) -> DataFrame:
    """Services that name a region index, plus the plans (never filtered)."""
    wanted = X.service_codes(service_filter)
    jobs = services.where(F.col("region_index_url") != "") if with_index else services
    if wanted:
        jobs = jobs.where(F.col("service_code").isin(wanted))
    jobs = jobs.withColumn("offer_type", F.lit("service"))
    return jobs.unionByName(plans) if include_plans else jobs


def targets_of(jobs: DataFrame, entries: DataFrame, *, base_url: str) -> DataFrame:
    """Region entries with a version url, resolved to absolute urls."""
    url = X.absolute_url(F.col("version_url"), base_url)
    return (
        jobs.withColumn("index_path", X.url_path(F.col("region_index_url")))
        .join(entries.where(F.col("version_url") != ""), "index_path")
        .withColumn("offer_url", url)
        .withColumn("version", X.version_from_url(F.col("offer_url")))
        .select(*schemas.TARGET)
    )


def rejects_of(jobs: DataFrame, indexes: DataFrame) -> DataFrame:
    """(service_code, offer_type, index_path, reason, record) of services whose index
    cannot be used: none named, not landed, or not readable."""
    unnamed = F.coalesce(F.col("region_index_url"), F.lit("")) == ""
    read = indexes.groupBy("index_path").agg(
        F.count(F.lit(1)).alias("landed"),
        # Spark does not read the corrupt record column alone.
        F.max(F.struct("_corrupt_record", "regions"))["_corrupt_record"].alias("record"),
    )
    return (
        jobs.withColumn(
            "index_path", F.when(~unnamed, X.url_path(F.col("region_index_url")))
        )
        .join(read, "index_path", "left")
        .withColumn(
            "reason",
            F.when(unnamed, "no index named")
            .when(F.col("landed").isNull(), "index not landed")
            .when(F.col("record").isNotNull(), "index not readable"),
        )
        .where(F.col("reason").isNotNull())
        .select("service_code", "offer_type", "index_path", "reason", "record")
    )


def discover_rejects(
    spark,
    master_path: str,
    region_index_root: str,
    *,
    service_filter: str = "",
    include_plans: bool = True,
) -> DataFrame:
    """The services on offer that `discover_targets` leaves out."""
    jobs = service_jobs(
        I.read_master_index(spark, master_path),
        I.plan_codes(spark),
        service_filter=service_filter,
        include_plans=include_plans,
        with_index=False,
    )
    return rejects_of(jobs, I.read_region_indexes(spark, region_index_root))


def discover_targets(
    spark,
    master_path: str,
    region_index_root: str,
    *,
    base_url: str,
    service_filter: str = "",
    include_plans: bool = True,
) -> DataFrame:
    """Every (service, region) document on offer.  A region index that is missing
    or unreadable takes only its own service out."""
    jobs = service_jobs(
        I.read_master_index(spark, master_path),
        I.plan_codes(spark),
        service_filter=service_filter,
        include_plans=include_plans,
    )
    indexes = I.readable(I.read_region_indexes(spark, region_index_root))
    return targets_of(jobs, I.region_entries(indexes), base_url=base_url)
