"""Row numbers, and the first rows, of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblode.operators.skew import MAX_BROADCAST_KEYS
from weblode.scratch import stage


def row_numbers(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Add ``n``, the row number within ``keys`` by ``order``.

    A group that is too large for one task is cut into ranges of the order:
    rows are sorted within each range, and continue after the ranges before
    it. Ranges and places are fixed by writing them to a scratch table: ``at``
    counts up within a range from its number times 2^33, so rows of a group
    in a range have consecutive ones, and no second shuffle has to number them.
    """
    ranges = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stage(ranges.withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("range", F.shiftright("at", 33))
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = placed.groupBy(*keys, "range").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    offsets = stage(sizes.select(*keys, "range", (before - F.col("first") + 1).alias("offset")))
    if offsets.count() <= MAX_BROADCAST_KEYS:
        offsets = F.broadcast(offsets)
    return (
        placed.join(offsets, [*keys, "range"])
        .withColumn("n", F.col("at") + F.col("offset"))
        .drop("at", "range", "offset")
    )


def first_rows(
    df: DataFrame, keys: list[str], order: list[Column], most: int, spread_by: str | None = None, parts: int = 64
) -> DataFrame:
    """Rows numbered up to ``most`` within ``keys`` by ``order``, with their number ``n``.

    Every task keeps the ``most`` first rows of a group before anything is
    shuffled (Spark limits groups early as long as ``most`` is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1,000 by default). With
    ``spread_by``, the rows' own key, what the tasks keep of one group goes to ``parts``
    tasks first, so that a group all tasks have rows of is no burden for the last one. All
    rows of a task go to the same part, so it keeps no more of a group than without.
    """
    if spread_by:
        df = df.withColumn("part", F.spark_partition_id() % parts)
        own = F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order))
        df = df.withColumn("n", own).where(F.col("n") <= most).drop("n", "part")
    return df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("n") <= most)
