"""Key sets: small frames that large tables are filtered by or joined with."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratebook.scratch import read_written

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64


class Keys(NamedTuple):
    frame: DataFrame
    rows: int


def written_keys(keys: DataFrame, path: str, limit: int = BROADCAST_BYTES) -> Keys:
    """Write a frame of string columns and measure it on the way.

    The frame read back carries a broadcast hint when its rows fit the limit in
    memory.  Beyond it a join shuffles both sides and AQE splits the partitions of
    hot keys, so no size is ever assumed.
    """
    widths = [
        F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(_ROW_OVERHEAD)
        for c in keys.columns
    ]
    seen = Observation()
    keys.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(reduce(lambda a, b: a + b, widths)), F.lit(0)).alias("bytes"),
    ).write.parquet(path)
    frame = read_written(keys, path)
    small = seen.get["bytes"] <= limit
    return Keys(F.broadcast(frame) if small else frame, seen.get["rows"])


def in_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return rows.join(keys, keys.columns, "left_semi")


def not_in_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return rows.join(keys, keys.columns, "left_anti")
