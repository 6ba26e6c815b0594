"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and
reading it back, so a lost executor never forces a recomputation of everything
before the cut.  Tables are deleted with the phase that made them (``scratch``), or
when the application ends.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder; a temporary one is set only on a local master where none is configured."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = kept.get() if kept.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
        folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return folder.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/gridloom-{name}-{uuid.uuid4().hex}"
    fs, where = _hadoop(spark, path)
    fs.deleteOnExit(where)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder (or ``folder``) and return a scan of what was written."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``materialize`` for tables of one phase, which are deleted at its end.

    Spark keeps the shuffle files of a plan until the driver finds that nothing refers
    to it; a long job asks for that between its phases, or they add up.
    """
    folder = new_folder(spark, name)
    yield lambda df, table: materialize(df, table, folder)
    drop_folder(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
