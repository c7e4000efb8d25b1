"""Gzip newline-delimited JSON sink for flattened rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratebook.sources.files import Files


def write_ndjson(df: DataFrame, path: str) -> int:
    """Write rows as gzip NDJSON and return their number; no rows, no files.

    Rows are counted while they are written, so they are worked out once; what an empty
    result leaves is removed.  Every row carries every column, nulls included.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .json(path)
    )
    if not seen.get["rows"]:
        Files(df.sparkSession).remove(path)
    return seen.get["rows"]
