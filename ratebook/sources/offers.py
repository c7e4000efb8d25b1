"""Landed offer documents.

A landing directory holds one `offer_url=<escaped url>` folder per document.  A large one has
a level above them, `bucket=<n>`, the CRC-32 of the url modulo the number of buckets: a load then
lists and opens the buckets of its own targets alone, however many targets there are.

* layout "file":  one JSON document per file, plain or `.gz`.
* layout "lines": one JSON document, or one slice of it, per line.  A document too
  large for one task is landed as several slices numbered by a top-level `slice`
  member; each slice carries the product entries of the skus it prices, so a slice
  is flattened on its own and no task ever holds more than one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.sources.files import Files

BUCKETS = ("OnDemand", "Reserved")  # fixed values
# Bytes of a document to a byte of its gzip file, about.
GZIP_RATIO = 10


def bucket_of(offer_url: Column, buckets: int) -> Column:
    return F.crc32(offer_url.cast("binary")) % buckets


def bucket_folders(root: str, targets: DataFrame, buckets: int) -> list[str]:
    """The folders that can hold the targets' documents: `buckets` at most, and as literals,
    so that nothing depends on a join's size.  Without buckets, the root."""
    if not buckets:
        return [root]
    files = Files(targets.sparkSession)
    wanted = targets.select(bucket_of(F.col("offer_url"), buckets).alias("bucket")).distinct()
    folders = [f"{root}/bucket={r.bucket}" for r in wanted.collect() if r.bucket is not None]
    return sorted(f for f in folders if files.exists(f))


def _read(
    spark: SparkSession, root: str, schema: str, layout: str, folders: list[str] | None
) -> DataFrame:
    if layout not in ("file", "lines"):
        raise ValueError(f"unknown landing layout {layout!r}")
    folders = [root] if folders is None else folders
    if not folders:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("multiLine", layout == "file")
        .option("basePath", root)
        # An unreadable offer document fails the run (an index does not, see indexes).
        .option("mode", "FAILFAST")
        .json(folders)
        .drop("bucket")
        .withColumn("slice", F.coalesce("slice", F.lit(0)))
    )


def read_service_offers(
    spark: SparkSession,
    root: str,
    *,
    layout: str = "lines",
    include_reserved: bool = True,
    folders: list[str] | None = None,
) -> DataFrame:
    """Service documents; unread term buckets are skipped by the parser."""
    buckets = BUCKETS if include_reserved else BUCKETS[:1]
    return _read(spark, root, schemas.service_offer(buckets), layout, folders)


def read_plan_offers(
    spark: SparkSession, root: str, *, layout: str = "lines", folders: list[str] | None = None
) -> DataFrame:
    return _read(spark, root, schemas.PLAN_OFFER, layout, folders)


def read_offer_headers(
    spark: SparkSession, root: str, *, layout: str = "lines"
) -> DataFrame:
    """Top-level scalars only: products and terms are skipped, never built."""
    return _read(spark, root, schemas.OFFER_HEADER, layout, None)


def landed_documents(
    spark: SparkSession, root: str, folders: list[str] | None = None
) -> DataFrame:
    """(offer_url, bytes) of the documents in a landing directory, from its listing
    alone.  Compressed ones count as about what they unfold to."""
    none = spark.createDataFrame([], "offer_url string, bytes bigint")
    folders = [root] if folders is None else folders
    if not folders:
        return none
    files = spark.read.format("binaryFile").option("basePath", root).load(folders)
    if "offer_url" not in files.columns:  # nothing landed yet
        return none
    unfolded = F.when(F.col("path").endswith(".gz"), F.col("length") * GZIP_RATIO)
    return files.groupBy(F.col("offer_url").cast("string").alias("offer_url")).agg(
        F.sum(F.coalesce(unfolded, "length")).alias("bytes")
    )


def of_targets(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents of the given targets, with the target's own columns.

    With targets from `written_keys` the documents are not shuffled.  `offer_url` is
    their partition column, so only the folders of these targets are opened (dynamic
    partition pruning).
    """
    wanted = (
        targets.select(*schemas.TARGET)
        # Not blank, as a range: the optimizer prunes by selective predicates only.
        .where(F.col("offer_url") > "")
        .distinct()
        .withColumnRenamed("version", "target_version")
    )
    return documents.withColumnRenamed("version", "document_version").join(
        wanted, "offer_url"
    )
