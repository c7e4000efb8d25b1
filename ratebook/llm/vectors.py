"""Vectors that take part in searches, and the pieces both searches share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    return F.coalesce(
        F.forall(
            vector,
            lambda x: F.coalesce(
                ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)
            ),
        )
        & (F.size(vector) > 0),
        F.lit(False),
    )


def usable(
    table: DataFrame, id_col: str, vector_col: str, nonzero: bool
) -> DataFrame:
    """(vec_id, v): one row an id, components as doubles, all of the commonest length.

    Rows without an id, and vectors of another length than most, take no part; of several
    vectors of one id the least (in array order) does.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("v")))
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    common = (
        rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    )
    if common is None:
        return rows
    return rows.where(F.size("v") == common["d"]).groupBy("vec_id").agg(F.min("v").alias("v"))


def few_copies(rows: DataFrame, most: int) -> DataFrame:
    """The `most` smallest ids of each vector.

    Equal vectors have equal scores, and ties go to smaller ids: the others can never be among
    the nearest.  Spark keeps the limit on the map side, so a vector may have any number of
    copies.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return rows.withColumn("copy", place).where(F.col("copy") <= most).drop("copy")


def matrix(column) -> np.ndarray:
    """Rows of equal length from an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten())
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to smaller ids: query_id, rank, vec_id, score."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
