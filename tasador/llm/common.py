"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.session import checkpoint_dir


@lru_cache(maxsize=None)
def ship_package(application_id: str) -> None:
    """Send this package to the executors, whose Python need not have it installed."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tasador"), "zip", top, "tasador")
    SparkSession.active().sparkContext.addPyFile(archive)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark.sparkContext.applicationId)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in
    ``spark.checkpoint.dir``. Only a local master may go without that
    setting; it then gets a scratch folder of this machine."""
    base = checkpoint_dir(spark)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: a shared folder is needed")
        base = tempfile.mkdtemp(prefix="tasador-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tasador-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: later
    stages neither recompute it nor lose it with an executor. ``options`` are the writer's."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a ``written`` table that nothing reads any more: all that came of it is written too."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside, so that a task
    holds few long texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings ``values`` for what is run inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def utf8(text: str = "text") -> Column:
    """The UTF-8 bytes of a text column, null as no bytes."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")
