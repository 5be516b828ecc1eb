"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and local runs; on a cluster spark-submit supplies these."""
    return (
        SparkSession.builder.master(master)
        .appName("cascata")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CASCATA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the master is local and none is named (tests, one machine) is a folder of this
    machine set; elsewhere that is an error, as each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder, so that no run overwrites another."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, label: str) -> DataFrame:
    """Write an intermediate that is used several times and read it back.

    The copy lies in the shared folder, so it outlives lost executors, and its readers get
    column pruning and true sizes, which lets Spark choose the joins.
    """
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    stored._folder = path
    for made in _jobs():
        made.append(path)
    return stored


_at_work = threading.local()


def _jobs() -> list[list[str]]:
    """Folders that intermediates went to, of each job that is at work in this thread."""
    if not hasattr(_at_work, "jobs"):
        _at_work.jobs = []
    return _at_work.jobs


def discard(rows: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these rows; nothing may read them any more."""
    _delete(rows.sparkSession, rows._folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediates stored within, by this thread, are deleted at the end; what a job returns must not read them."""
    made: list[str] = []
    _jobs().append(made)
    try:
        yield
    finally:
        _jobs().pop()
        for folder in made:
            _delete(spark, folder)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a job that stores rows go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    former = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if former is None else spark.conf.set(key, former)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python tasks import it; once per application.

    Not needed when the job was submitted with the package in ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "cascata")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
