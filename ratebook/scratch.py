"""Work folders on the cluster's shared storage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a session that is one local process may go without: it gets one temporary folder.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_DIR
    )
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="ratebook-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder nobody used before; nothing is ever overwritten in place."""
    return f"{shared_root(spark)}/{name}-{uuid4().hex}"


def written(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write `df` once and go on from the files.

    Cuts lineage, survives lost executors, and gives Catalyst the real size of
    the data for its join choice.  `options` are the writer's.
    """
    df.write.options(**options).parquet(path)
    return read_written(df, path)


def read_written(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)
