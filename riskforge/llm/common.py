"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskforge
from riskforge.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    if not df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Like ``cut``, as a compressed Parquet table in the shared folder, with
    further options of the writer. The shuffle files of the write are released at
    its end: nothing reads them again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.options(compression="zstd", **options).parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries planned inside hand their Python functions at most ``rows`` rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries run inside hand their Python functions about ``most`` bytes at a time, one row at least."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(riskforge.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="riskforge-code-"), "riskforge_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "riskforge")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def spread(df: DataFrame) -> DataFrame:
    """Rows for Python functions: the package is sent to the workers, and rows
    are dealt anew only when the input has fewer splits than the application
    has cores."""
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def small_side(df: DataFrame, rows: int, most: int = 10_000) -> DataFrame:
    """Broadcast a join side whose row count was found to be small; beyond that
    leave the join to sort-merge and adaptive splitting of hot keys."""
    return F.broadcast(df) if rows <= most else df
