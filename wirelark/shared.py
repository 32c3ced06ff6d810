"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables stored in each open ``scratch``, the innermost last.
_open: list[list[str]] = []


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine gets a folder of its own, which goes when Python ends; on a cluster a
    folder of the driver's machine would be of no use to the executors, so that fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="wirelark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        root = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored_at(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet in the shared folder and read back, which cuts its lineage; and the path.

    ``by``: columns that have a folder for each value, so that a reader of some values opens those alone; they come last.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    if _open:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's own file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is stored inside go when it has been written; a frame that is run again makes them anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end: what is made inside must be written by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            removed(spark, path)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """What ``make`` gives, stored; the tables that were stored on the way are deleted."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with scratch(spark):
        df = make()
        df.write.mode("overwrite").parquet(path)
        schema = df.schema
    if _open:
        _open[-1].append(path)
    return spark.read.schema(schema).parquet(path), path
