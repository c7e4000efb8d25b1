"""Data-quality guards of the load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class LoadRefused(RuntimeError):
    """The load would leave the live table without data."""


def require_targets(n_targets: int) -> None:
    if not n_targets:
        raise LoadRefused("no targets discovered; the live table is left as it is")


def require_landed(wanted: DataFrame, landed: DataFrame) -> int:
    """Bytes to read.  A document on offer that was not landed fails the load: taking
    it for empty would drop its rows and record its version."""
    missing, example, size = (
        wanted.join(landed, "offer_url", "left")
        .agg(
            F.count_if(F.col("bytes").isNull()),
            F.min(F.when(F.col("bytes").isNull(), F.col("offer_url"))),
            F.coalesce(F.sum("bytes"), F.lit(0)),
        )
        .first()
    )
    if missing:
        raise LoadRefused(f"{missing} documents are not landed, such as {example}")
    return size


def require_some_data(fresh_rows: int, today_has_data: bool, has_previous: bool) -> None:
    if not (fresh_rows or today_has_data or has_previous):
        raise LoadRefused(
            "nothing to serve: the documents hold no price, and no day was loaded before"
        )


def is_noop(any_changed: bool, today_has_data: bool, force: bool) -> bool:
    return not any_changed and today_has_data and not force


def require_day(rows: DataFrame, day: date) -> DataFrame:
    """Fail when a row belongs to another day's partition."""
    own = F.col("ingestion_date")
    other = F.raise_error(F.lit(f"a row is not dated {day}"))
    return rows.withColumn(
        "ingestion_date", F.when(own != F.lit(day), other).otherwise(own)
    )


def require_columns(rows: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Fail the job that evaluates `rows` when a required column is NULL.

    Checked in the same pass that writes the rows; the files of a failed write are
    never published, so a load is all or nothing.
    """
    checked = {
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"required column {c} is NULL"))
        )
        for c in required
    }
    return rows.withColumns(checked)
