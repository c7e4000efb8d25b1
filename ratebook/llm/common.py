"""What the operators of this package share."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ratebook
from ratebook.scratch import new_folder, written

#: Rows and bytes that reach a Python worker at once.
ARROW_ROWS = "1000"
ARROW_BYTES = "16m"
#: A missing id is ordered after every other; this value stands for it inside jobs.
NO_ID = (1 << 63) - 1

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and this package on every executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(ratebook.__file__).parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for path in sorted(root.rglob("*.py")):
                archive.write(path, path.relative_to(root.parent))
        name = os.path.join(tempfile.mkdtemp(prefix="ratebook-"), "ratebook.zip")
        Path(name).write_bytes(packed.getvalue())
        spark.sparkContext.addPyFile(name)
        _SHIPPED.add(application)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the cluster's shared folder and go on from the files."""
    return written(df, new_folder(df.sparkSession, name))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns cannot clash, a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, sig, text): the id with nulls last, and a hash that tells repeated ids apart.

    Rows that agree in both id and text agree in every result.
    """
    plain = texts(docs, id_col, text_col)
    return plain.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("did"),
        F.xxhash64("text").alias("sig"),
        "text",
    )


def whole(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, sig, row): as `keyed`, with all columns of a row in one, where no name can clash."""
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("sig"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )


def real_id(name: str = "did") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias("doc_id")


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def slices(batch: pa.RecordBatch, column: str, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text, one row at least."""
    array = batch.column(column)
    if not len(array):
        return
    ends = np.cumsum(
        np.asarray(pc.fill_null(pc.binary_length(array), 0), dtype=np.int64)
    )
    start = 0
    while start < len(array):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, end - start)
        start = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
