"""Session helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_REMOVED_AT_EXIT: set[str] = set()


def local_session(cpus: int | str = 8, app: str = "seriesworks", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SERIESWORKS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must be able to read.

    A path without a scheme belongs to the cluster's default file system.

    Only a local session without that setting gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="seriesworks-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder; the driver removes it when it ends."""
    context = spark.sparkContext
    path = f"{shared_folder(spark).rstrip('/')}/seriesworks-{context.applicationId}"
    if path not in _REMOVED_AT_EXIT:
        _REMOVED_AT_EXIT.add(path)
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        atexit.register(_remove, target, context._jsc.hadoopConfiguration())
    return path


def _remove(target, settings) -> None:
    """Delete a folder, if the JVM is still there to do it."""
    with contextlib.suppress(Exception):
        target.getFileSystem(settings).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later stages then start from that table: an expensive input is not computed again,
    a lost executor costs no more than its own task, and the reader prunes columns and
    knows the size.  The table goes when the application ends, or by :func:`release`.
    """
    path = f"{application_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table of :func:`cut_lineage` that nothing reads any more, as when its successor is written."""
    context = df.sparkSession.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
    _remove(target, context._jsc.hadoopConfiguration())
