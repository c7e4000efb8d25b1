"""Content of a day's snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.operators.keys import in_keys, not_in_keys

# A hot sku is spread by its rate code, so no single range holds all of its rows.
CLUSTER_BY = ("service_code", "region_code", "sku", "rate_code")


def pairs_in_changed(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the changed (service, region) pairs."""
    return in_keys(rows, pairs.select(*schemas.PAIR))


def pairs_not_in_changed(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    return not_in_keys(rows, pairs.select(*schemas.PAIR))


def carry_forward(previous: DataFrame, pairs: DataFrame, run_date: date) -> DataFrame:
    """Previous day's rows of every pair that did not change, dated `run_date`.

    With pairs from `written_keys` a broadcast anti join, which shuffles nothing.
    """
    kept = pairs_not_in_changed(previous, pairs)
    return kept.withColumn("ingestion_date", F.lit(run_date)).select(
        *schemas.HISTORY.names
    )


def clustered(rows: DataFrame) -> DataFrame:
    """Physical order of the serving tables: tight min/max per file and row group."""
    return rows.repartitionByRange(*CLUSTER_BY).sortWithinPartitions(*CLUSTER_BY)


def compose(
    base: DataFrame | None,
    fresh: DataFrame | None,
    pairs: DataFrame | None,
    run_date: date,
) -> DataFrame:
    """Snapshot = rows carried from `base` + fresh rows.

    `base` is today's partition on a same-day rerun (its changed pairs are
    replaced), the latest earlier partition on a new day, None on the first run.
    """
    if base is None:
        return fresh
    if pairs is None:
        pairs = base.select(*schemas.PAIR).where(F.lit(False))
    carried = carry_forward(base, pairs, run_date)
    return carried if fresh is None else carried.unionByName(fresh)


def pair_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*schemas.PAIR).agg(F.count(F.lit(1)).alias("rows"))
