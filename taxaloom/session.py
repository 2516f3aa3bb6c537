"""Session settings and the cut of a long lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call sites of single columns are not worth their cost in long plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, memory: str = "12g", **settings: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings the session."""
    folder = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="taxaloom-")}
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("taxaloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**SETTINGS, **folder, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own: set[tuple[str, str]] = set()  # folders of this driver's applications


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, in ``spark.checkpoint.dir``.

    If that is unset, it is below the warehouse, which executors share as well.
    Hadoop's file system removes the folder when the application ends.
    """
    context = spark.sparkContext
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{parent.rstrip('/')}/taxaloom-{context.applicationId}"
    if (context.applicationId, folder) not in _own:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own.add((context.applicationId, folder))
    return folder


_scope: ContextVar[str | None] = ContextVar("folder of the running scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`cut` writes within are removed at the end, as those of a
    micro-batch once its output is written."""
    folder = f"{shared_folder(spark)}/scope-{uuid.uuid4().hex}"
    outer = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(outer)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start from the written table: earlier joins are not computed
    again, a lost executor costs nothing, and join sizes are known from files.
    """
    spark = df.sparkSession
    path = f"{_scope.get() or shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` stored in buckets of ``columns`` and sorted by them: joins on all of
    these neither shuffle nor sort it. There are as many buckets as partitions
    of a shuffle, so that the other side is dealt out alike."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"taxaloom_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *columns)  # a task writes one bucket
        .write.bucketBy(buckets, *columns).sortBy(*columns)
        .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    )
    return spark.table(name)
