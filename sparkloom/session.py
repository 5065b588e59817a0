"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "sparkloom", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE, skew joins and UTC; `master` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return ship_package(builder.getOrCreate())


_SHIPPED: set[str] = set()
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "2000"  # rows hold whole texts or vectors, so Spark's 10 000 are many megabytes in every worker


def ship_package(spark: SparkSession) -> SparkSession:
    """Makes this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, BATCH_ROWS)
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="sparkloom-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "sparkloom.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        path = os.path.join(folder, f)
                        z.write(path, os.path.join("sparkloom", os.path.relpath(path, root)))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    (tests on one machine) a temporary folder is made, once per session, and
    removed at exit; on any other master a missing setting is an error, because
    executors would write to disks of their own.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Lets the folder's file system delete a scratch folder when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Writes `df` to the shared folder and continues from there.

    The rows survive the loss of any executor, the plan of an iterative job stays
    short, and its statistics are those of the written rows; a checkpoint would
    compute the rows twice and carry estimates on from loop to loop.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
