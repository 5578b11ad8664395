"""Tab-separated text files with packed lists.

======== ====================================
postings ``word \\t url|count|url|count…``
nodes    ``url|rank \\t link|link…``
======== ====================================

Lists never grow with the corpus: a key with a long one has several lines, in
any file, and every reader has to expect that. The readers here put them
together again. A tab, line break or
``|`` in a URL would break the format, so the writers fail on it; parquet has
no such limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.operators.index import ENTRIES_PER_LIST, posting_lists
from weblode.operators.links import adjacency_lists

# Reducer output (fixed pattern), or a text file written by Spark.
_PART_FILE = r".*/part-(?:r-[0-9]*|[0-9]+-[^/]*\.txt(?:\.[a-z0-9]+)?)\z"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the part files below ``path``, split at tabs."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .text(path)
    )
    parts = files.where(F.col("_metadata.file_path").rlike(_PART_FILE))
    return parts.select(F.split("value", "\t").alias("fields"))


def read_packed_postings(spark: SparkSession, path: str) -> DataFrame:
    """``(word, url, count)``."""
    fields = F.col("fields")
    items = _lines(spark, path).where(F.size(fields) > 1).select(
        fields[0].alias("word"), F.split(fields[1], r"\|").alias("items")
    )

    def pair(i: Column) -> Column:
        url, count = F.get("items", 2 * i), F.get("items", 2 * i + 1)
        return F.struct(url.alias("url"), count.cast("bigint").alias("count"))

    last = F.floor(F.size("items") / 2).cast("int") - 1
    indexes = F.when(last >= 0, F.sequence(F.lit(0), last))
    pairs = items.select("word", F.inline(F.transform(indexes, pair)))
    return pairs.select("word", "url", "count")


def _keyed(lines: DataFrame) -> DataFrame:
    fields, key = F.col("fields"), F.split(F.col("fields")[0], r"\|")
    return lines.select(
        key[0].alias("url"), F.get(key, F.lit(1)).cast("double").alias("rank"),
        F.get(fields, F.lit(1)).alias("links"),
    )


def read_packed_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``(url, rank)``; the link lists are not looked at."""
    return _keyed(_lines(spark, path)).select("url", "rank").distinct()


def read_packed_nodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``ranks(url, rank)`` and ``edges(src, dst)``. A missing or empty list
    means no links."""
    nodes = _keyed(_lines(spark, path))
    linked = nodes.where(F.col("links") != "")
    edges = linked.select(
        F.col("url").alias("src"), F.explode(F.split("links", r"\|")).alias("dst")
    )
    return nodes.select("url", "rank").distinct(), edges


def _packable(url: str) -> Column:
    column = F.col(url)
    return F.when(
        column.rlike(r"[|\t\r\n]"),
        F.raise_error(F.concat(F.lit("cannot pack URL with | or tab: "), column)),
    ).otherwise(column)


def _write(lines: DataFrame, path: str, mode: str) -> None:
    lines.write.mode(mode).text(path)


def write_packed_postings(
    postings: DataFrame, path: str, mode: str = "errorifexists", per_list: int = ENTRIES_PER_LIST
) -> None:
    """Write a stored ``postings`` table, lines sorted by word in each file."""
    lists = posting_lists(postings.withColumn("url", _packable("url")), per_list)
    lines = lists.sortWithinPartitions("word").select(F.concat_ws("\t", "word", "postings"))
    _write(lines, path, mode)


def write_packed_nodes(
    edges: DataFrame,
    path: str,
    ranks: DataFrame | None = None,
    mode: str = "errorifexists",
    per_list: int = ENTRIES_PER_LIST,
) -> None:
    """Write stored ``edges`` with rank 1 for each source, or with ``ranks``,
    where a node without links keeps its line with an empty list."""
    packable = edges.select(_packable("src").alias("src"), _packable("dst").alias("dst"))
    lists = adjacency_lists(packable, per_list).withColumnRenamed("src", "url")
    if ranks is None:
        nodes = lists.withColumn("rank", F.lit("1"))
    else:
        known = ranks.select(_packable("url").alias("url"), F.col("rank").cast("string"))
        nodes = known.join(lists, "url", "left")
    key = F.concat_ws("|", "url", "rank")
    line = F.concat(key, F.lit("\t"), F.coalesce("links", F.lit("")))
    _write(nodes.sortWithinPartitions("url").select(line), path, mode)
