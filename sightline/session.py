"""Session settings every job relies on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    # Event times are UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Rows of whole texts that Spark takes at a time: its defaults are made for narrow rows.
_TEXT_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.parquet.columnarReaderBatchSize": 512,
}


# Paths staged by the running thread inside ``released_after``.
_STAGED = threading.local()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings the operators depend on."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the rows in a batch for tables with a whole text a row; lower settings stay.

    Batches are held by the reader, by Spark's Arrow writer and by the Python worker of
    every running task. Their size changes no result.
    """
    for name, rows in _TEXT_ROWS.items():
        # A number below 1 stands for no bound.
        if not 0 < int(spark.conf.get(name, "0")) <= rows:
            spark.conf.set(name, rows)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="sightline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage, lets later passes read only the columns they need, and
    gives Catalyst the real byte size: a small staged table becomes a broadcast
    side by itself, a large one does not.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if getattr(_STAGED, "paths", None) is not None:
        _STAGED.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a written table, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def released_after(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stage`` wrote inside the block once its outputs are written."""
    outer, _STAGED.paths = getattr(_STAGED, "paths", None), []
    try:
        yield
    finally:
        for path in _STAGED.paths:
            delete(spark, path)
        _STAGED.paths = outer


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` without its columns of these names, plus ``columns``, evaluated once.

    Catalyst pushes filters through projections and so repeats costly expressions
    in every predicate that reads them. It does not push them through a generator:
    the columns are the one row an inline array yields.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
