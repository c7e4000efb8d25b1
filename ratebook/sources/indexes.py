"""Master and region index documents, and the literal plan codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.functions import exprs as X

# Fixed values.
PLAN_CODES = (
    "AWSComputeSavingsPlan",
    "AWSDatabaseSavingsPlans",
    "AWSMachineLearningSavingsPlans",
)
PLAN_INDEX_PATH = "/savingsPlan/v1.0/aws/{code}/current/region_index.json"


def read_master_index(spark: SparkSession, path: str) -> DataFrame:
    """(service_code, region_index_url), one row per listed service."""
    return (
        spark.read.schema(schemas.MASTER_INDEX)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.explode("offers").alias("service_code", "meta"))
        .select(
            "service_code", F.col("meta.currentRegionIndexUrl").alias("region_index_url")
        )
    )


def plan_codes(spark: SparkSession) -> DataFrame:
    """(service_code, region_index_url, offer_type) of the plans."""
    rows = [(c, PLAN_INDEX_PATH.format(code=c), "savings_plan") for c in PLAN_CODES]
    return spark.createDataFrame(
        rows, "service_code string, region_index_url string, offer_type string"
    )


def read_region_indexes(spark: SparkSession, root: str) -> DataFrame:
    """Landed region indexes, one `index_path=<escaped path>` folder each."""
    return (
        spark.read.schema(schemas.REGION_INDEX)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(root)
    )


def readable(indexes: DataFrame) -> DataFrame:
    return indexes.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def rejected(indexes: DataFrame) -> DataFrame:
    """Indexes that could not be read; the others survive."""
    return indexes.where(F.col("_corrupt_record").isNotNull()).select(
        "index_path", F.col("_corrupt_record").alias("record"), "regions"
    )


def region_entries(indexes: DataFrame) -> DataFrame:
    """(index_path, region_code, version_url) from either shape of `regions`."""
    is_list = F.ltrim("regions").startswith("[")
    named = (
        indexes.where(~is_list)
        .select(
            "index_path",
            F.explode(F.from_json("regions", schemas.REGION_MAP)).alias(
                "region_code", "meta"
            ),
        )
    )
    listed = (
        indexes.where(is_list)
        .select(
            "index_path",
            F.explode(F.from_json("regions", schemas.REGION_LIST)).alias("meta"),
        )
        .where(F.col("meta.regionCode") != "")
        .select("index_path", F.col("meta.regionCode").alias("region_code"), "meta")
    )
    columns = (
        "index_path",
        "region_code",
        X.first_filled(
            F.col("meta.currentVersionUrl"), F.col("meta.versionUrl")
        ).alias("version_url"),
    )
    return named.select(*columns).unionByName(listed.select(*columns))
