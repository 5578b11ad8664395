"""Keyed parquet tables: create-only, append and merge writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.functions.urls import bucket_of
from weblode.scratch import scope, stage, tidy
from weblode.sources.publish import Publication, publishing, settle


class KeyCollision(ValueError):
    """A row with the same key is already there."""


def check_unique(rows: DataFrame, keys: list[str]) -> None:
    """Fail if two rows share a key."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise KeyCollision(f"rows share a key ({', '.join(keys)})")


def check_new(rows: DataFrame, stored: DataFrame, keys: list[str]) -> None:
    """Fail if a row of ``rows`` has a key that ``stored`` has. The stored side
    is the one that is streamed: it is the large one, and stays in place while
    the new rows are few enough to be broadcast."""
    if not stored.join(rows.select(*keys), keys, "left_semi").isEmpty():
        raise KeyCollision(f"key ({', '.join(keys)}) is already stored")


def create_table(
    rows: DataFrame, path: str, keys: list[str], max_records_per_file: int = 0,
    partition_by: list[str] | None = None, mode: str = "errorifexists", checked: bool = False,
) -> None:
    """Write a new table; fail if it exists (unless ``mode`` is overwrite) or,
    unless the caller has ``checked`` that, if two rows share a key."""
    if not checked:
        check_unique(rows, keys)
    _write(rows, path, max_records_per_file, partition_by, mode)


def append_rows(
    rows: DataFrame, path: str, keys: list[str], max_records_per_file: int = 0,
    partition_by: list[str] | None = None, mode: str = "append", checked: bool = False,
) -> None:
    """Add rows to a table; unless ``checked``, fail before writing if two rows
    share a key or a key is taken."""
    if not checked:
        check_unique(rows, keys)
        check_new(rows, rows.sparkSession.read.parquet(path), keys)
    _write(rows, path, max_records_per_file, partition_by, mode)


def _write(
    rows: DataFrame, path: str, max_records_per_file: int, partition_by: list[str] | None, mode: str
) -> None:
    writer = rows.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    writer = writer.option("compression", "zstd")  # halves ids in hex
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with tidy(rows.sparkSession):
        writer.parquet(path)


def merge_rows(rows: DataFrame, path: str, keys: list[str], target: str) -> None:
    """Write to ``target`` the table at ``path`` with ``rows`` set in it: a
    known key takes the new values and keeps columns that ``rows`` lacks."""
    check_unique(rows, keys)
    stored = rows.sparkSession.read.parquet(path)
    kept = stored.join(rows.select(*keys), keys, "left_anti")
    lacking = [c for c in stored.columns if c not in rows.columns]
    if lacking:
        rows = rows.join(stored.select(*keys, *lacking), keys, "left")
    kept.unionByName(rows, allowMissingColumns=True).write.parquet(target)


def create_bucketed(
    rows: DataFrame, root: str, name: str, keys: list[str], buckets: int, max_records_per_file: int = 0
) -> None:
    """Write a new table ``name`` below ``root`` in folders by a hash of its
    first key, so that merges can be made in place."""
    spark = rows.sparkSession
    check_unique(rows, keys)
    rows = rows.withColumn("bucket", bucket_of(F.col(keys[0]), buckets))
    with publishing(spark, root) as publication:
        _write(_by_bucket(rows, keys), publication.place(name), max_records_per_file, ["bucket"], "errorifexists")


def _by_bucket(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *keys)


def merged_parts(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The buckets of ``stored`` that hold a key of ``rows``, with the rows set in
    them: a known key takes the new values and keeps columns that ``rows``
    lacks. Both have a column ``bucket``."""
    unknown = [c for c in rows.columns if c not in stored.columns]
    if unknown:
        raise ValueError(f"columns the table does not have: {unknown}")
    touched = [row["bucket"] for row in rows.select("bucket").distinct().collect()]  # as many as buckets at most
    stored, keys = stored.where(F.col("bucket").isin(touched)), ["bucket", *keys]
    kept = stored.join(rows.select(*keys), keys, "left_anti")
    lacking = [c for c in stored.columns if c not in rows.columns]
    if lacking:
        rows = rows.join(stored.select(*keys, *lacking), keys, "left")
    return kept.unionByName(rows.select(*stored.columns))


def merge_bucketed(
    rows: DataFrame, root: str, name: str, keys: list[str], buckets: int, max_records_per_file: int = 0
) -> None:
    """Set ``rows`` in a table of ``create_bucketed``, see ``merged_parts``. Only
    buckets with a changed key are written again, and replaced together; the
    files of all others stay. Rows may lack columns but have no new ones."""
    spark = rows.sparkSession
    with scope(spark), publishing(spark, root) as publication:
        rows = stage(rows.withColumn("bucket", bucket_of(F.col(keys[0]), buckets)))
        check_unique(rows, keys)
        merged = merged_parts(rows, spark.read.parquet(f"{root}/{name}"), keys)
        put_parts(merged, publication, name, keys, max_records_per_file)


def put_parts(
    merged: DataFrame, publication: Publication, name: str, keys: list[str], max_records_per_file: int = 0
) -> None:
    _write(_by_bucket(merged, keys), publication.place(name, "parts"), max_records_per_file, ["bucket"], "errorifexists")


def read_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    settle(spark, root)
    return spark.read.parquet(f"{root}/{name}").drop("bucket")
