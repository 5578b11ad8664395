"""Pages and documents kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.functions.urls import self_url


# A scan of at least so many bytes is cut by its files and row groups alone.
SPREAD_BYTES = 256 << 20
# Bytes on disk of a piece of a table of texts. What a task holds of the words of
# its texts is many times as much, so this must not grow with the table.
TEXT_BYTES = 8 << 20
#: Rows of a key that may come into one piece.
ROWS_PER_KEY = 100


def _size(scan: DataFrame) -> int:
    """Bytes of the files of a scan."""
    spark, size = scan.sparkSession, 0
    for path in scan.inputFiles():
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).getLen()
    return size


def spread(scan: DataFrame) -> DataFrame:
    """Share out a scan that is small on disk, for example one file with a
    single row group, over all cores. A larger one stays as it is: no shuffle,
    and ``spark.sql.files.maxPartitionBytes`` cuts it."""
    files = len(scan.inputFiles())
    if not files or files > 64 or _size(scan) >= SPREAD_BYTES:
        return scan
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism)


def spread_texts(scan: DataFrame, key: str | None = None) -> DataFrame:
    """Share out a scan of texts over all cores, in pieces of about ``TEXT_BYTES``
    however large it, its files and their row groups are. With a ``key`` its rows
    come into one piece, so that what is then grouped by it is not shuffled again;
    unless any key has more than ``ROWS_PER_KEY`` rows, which could be too much for one."""
    pieces = max(scan.sparkSession.sparkContext.defaultParallelism, -(-_size(scan) // TEXT_BYTES))
    if key is None or not scan.groupBy(key).count().where(F.col("count") > ROWS_PER_KEY).isEmpty():
        return scan.repartition(pieces)
    return scan.repartition(pieces, key)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(url, html)`` from a parquet table with full page addresses."""
    scan = spark.read.parquet(path).select(self_url(F.col("url")).alias("url"), "html")
    return spread_texts(scan, "url")


def read_documents(spark: SparkSession, path: str, key: str, text: str) -> DataFrame:
    """``(url, text)`` from a parquet table of plain documents, keyed by any
    column."""
    scan = spark.read.parquet(path).select(F.col(key).cast("string").alias("url"), F.col(text).alias("text"))
    return spread_texts(scan, "url")
