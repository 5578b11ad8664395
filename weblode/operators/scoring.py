"""How pages with a word are scored and ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value.
COUNT_CAP = 20


def capped_count(count: Column) -> Column:
    return F.least(count, F.lit(COUNT_CAP))


def score(rank: Column, count: Column) -> Column:
    """Null for a page without a rank."""
    return rank + capped_count(count) / F.lit(COUNT_CAP).cast("double")


def best_first() -> list[Column]:
    return [F.col("score").desc_nulls_last(), F.col("website_id").asc()]


def scored(hits: DataFrame, page_rank: DataFrame, *more: str) -> DataFrame:
    """Hits with ``pagerank`` and ``score`` in place of their count, and ``more``
    columns of the table of ranks."""
    keys = ["bucket", "website_id"] if "bucket" in hits.columns else ["website_id"]
    ranked = hits.join(page_rank.select(*keys, "value", *more), keys, "left")
    return ranked.select(
        *[c for c in hits.columns if c not in ("count", "bucket")],
        F.col("value").alias("pagerank"),
        score(F.col("value"), F.col("count")).alias("score"),
        *more,
    )
