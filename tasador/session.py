"""Session helpers.

Library code never creates a session of its own: every operator takes the
caller's ``SparkSession`` or ``DataFrame``. These helpers are for tests, the
benchmark and command-line use.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "tasador") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@lru_cache(maxsize=None)
def ship_package(application_id: str) -> None:
    """Send this package to the executors, whose Python need not have it installed:
    the operators that work in Arrow batches name its functions."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tasador_operators"), "zip", top, "tasador")
    SparkSession.active().sparkContext.addPyFile(archive)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local tests, the benchmark) fall back to a fresh scratch folder."""
    d = checkpoint_dir(spark)
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that they share")
        d = tempfile.mkdtemp(prefix="tasador-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def broadcast_checked(df, rows: int = 100_000):
    """``df``, computed once, marked for broadcast if it has at most ``rows``
    rows; beyond that as it is, for Spark to join by a shuffle. For tables of
    one row a group, joined back to all rows: these then stay where they are."""
    from pyspark.sql import functions as F
    small = materialize(df)
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def materialize(df):
    """Compute ``df`` once and cut its lineage.

    With a checkpoint folder named by the cluster (``spark.checkpoint.dir``)
    this is an eager ``checkpoint()``: the rows are written to that shared,
    reliable storage, so later stages neither recompute the upstream plan
    nor lose the data with an executor. Without one (plain local runs) it
    falls back to ``persist(MEMORY_AND_DISK)``."""
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    if checkpoint_dir(df.sparkSession):
        # Persist first so the checkpoint write reads the cached rows
        # instead of recomputing the plan a second time.
        out = cached.checkpoint(eager=True)
        cached.unpersist()
        return out
    return cached


def stored(df, name: str):
    """``df`` as a parquet table in the cluster's checkpoint folder: in fewer bytes than ``materialize``, whose
    files hold whole rows. Without that folder ``materialize``. Its lifetime is the folder's."""
    folder = checkpoint_dir(df.sparkSession)
    if not folder:
        return materialize(df)
    path = f"{folder.rstrip('/')}/tasador-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
