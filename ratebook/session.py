"""Session settings the jobs rely on."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# Of files as they are stored, which hold some ten times that in memory.
PARTITION_BYTES = 32 * 1024 * 1024
# Of stored history that one task deals to a shuffle.  Beyond 200 partitions Spark holds all of
# a task's rows until they are in order, which is some forty times that, or spills them.
DEALT_BYTES = 8 * 1024 * 1024

SETTINGS = {
    # All timestamps are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A malformed price or date fails the load instead of becoming NULL.
    "spark.sql.ansi.enabled": "true",
    # A repeated member of a JSON object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The same when a map is put together again from its entries.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: coalesced partitions, split skewed join partitions,
    # broadcast of sides that turn out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task sorts: history rows take some ten times their shuffled bytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Enough shuffle partitions for the input, never fewer than the session's own.
    AQE merges the ones that turn out small."""
    needed = math.ceil(input_bytes / PARTITION_BYTES)
    if needed > int(spark.conf.get(_SHUFFLE_PARTITIONS)):
        spark.conf.set(_SHUFFLE_PARTITIONS, str(needed))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """The same for the jobs of one block."""
    before = spark.conf.get(_SHUFFLE_PARTITIONS)
    size_shuffles(spark, input_bytes)
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_PARTITIONS, before)


@contextmanager
def narrow_splits(spark: SparkSession) -> Iterator[None]:
    """Tables are read by tasks of at most `DEALT_BYTES` in the jobs of one block."""
    before = spark.conf.get(_SPLIT_BYTES)
    spark.conf.set(_SPLIT_BYTES, str(DEALT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT_BYTES, before)


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ratebook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
