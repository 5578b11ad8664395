"""Intermediate tables, written once so that later jobs do not depend on the
executors that computed them, and who removes them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Spark then removes the shuffle files of a query when it ends, not when the driver
#: happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Paths made since the innermost scope was opened, or nothing outside of all.
_OPEN: ContextVar[list[str] | None] = ContextVar("open", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``, or
    below the warehouse, which a cluster shares too, if there is none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        _check_shared(spark, root)
    path = f"{root.rstrip('/')}/weblode-{uuid4().hex}"
    made = _OPEN.get()
    if made is not None:
        made.append(path)
    return path


def _check_shared(spark: SparkSession, root: str) -> None:
    """A warehouse in a local folder is shared by nobody but a local master."""
    master = spark.conf.get("spark.master", "local")
    if root.startswith(("file:", "/")) and not master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {root} is a local one")


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch tables made inside and removes them at the end, however
    that comes. Results that read them have to be written inside::

        with scope(spark):
            search_batch(store, queries).write.parquet(out)

    Scopes may be nested; each removes its own."""
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        remove(spark, *made)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Changes a setting of the session for what is run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tidy(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written inside leaves no shuffle files behind on the executors."""
    return setting(spark, CLEANUP, "true")


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as a scratch table and return a scan of it."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    with tidy(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
