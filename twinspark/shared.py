"""Tables cut out of the lineage, in the folder that driver and executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary one; a cluster must name one that all its machines share."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="twinspark-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def place(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path: in ``folder``, else in that of the ``scratch`` around, else in the shared one."""
    return f"{folder or _scratch.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str = "t", folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back, so that later stages survive a lost executor; ``place`` says where."""
    spark = df.sparkSession
    path = place(spark, name, folder)
    schema = df.schema
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables written within go to a folder of their own, which is deleted at the end; the folder around is given.

    Each thread has its own. What outlives it must be written to the folder around (``settled`` does that).
    """
    outer = _scratch.get() or shared_dir(spark)
    own = f"{outer}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(own)
    try:
        yield outer
    finally:
        _scratch.reset(token)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` gives, written; the tables that it wrote on its way, and only these, are deleted."""
    with scratch(spark) as outer:
        return table(make(), name, outer)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once a session, so that they need no path to it."""
    sc = spark.sparkContext
    if not getattr(sc, "_twinspark_shipped", False):
        root = Path(__file__).resolve().parent
        copy = Path(tempfile.mkdtemp(prefix="twinspark-"))
        shutil.copytree(root, copy / "tree" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(str(copy / "twinspark"), "zip", copy / "tree"))
        sc._twinspark_shipped = True
    return spark
