"""Spreading keys that own too many rows.

A word on every page, or a page with a third of all links, would put its rows
into one task. Such heavy keys are split into slots of bounded size; all others
stay in slot 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from weblode.scratch import stage

# Upper bound for a broadcast table of heavy keys.
MAX_BROADCAST_KEYS = 100_000


def slots_needed(rows: str, rows_per_slot: int):
    return F.ceil(F.col(rows) / F.lit(rows_per_slot)).cast("int")


def heavy_keys(df: DataFrame, key: str, rows_per_slot: int) -> DataFrame:
    """Keys with more than ``rows_per_slot`` rows and the slots they need."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    heavy = counts.where(F.col("n") > rows_per_slot)
    return stage(heavy.select(key, slots_needed("n", rows_per_slot).alias("slots")))


def assign_slots(
    df: DataFrame, key: str, spread_by: str, heavy: DataFrame, n_heavy: int
) -> DataFrame:
    """Add ``slot``, unless there are no heavy keys. ``heavy`` (key, slots) has
    ``n_heavy`` rows, and is broadcast only while those are few; beyond that
    the join shuffles, and adaptive execution splits the skewed side."""
    if n_heavy == 0:
        return df
    if n_heavy <= MAX_BROADCAST_KEYS:
        heavy = F.broadcast(heavy)
    slot = F.pmod(F.xxhash64(spread_by), F.col("slots")).cast("int")
    return (
        df.join(heavy, key, "left")
        .withColumn("slot", F.coalesce(slot, F.lit(0)))
        .drop("slots")
    )


def group_in_parts(
    df: DataFrame, key: str, spread_by: str, rows_per_part: int
) -> GroupedData:
    """``df`` grouped by key, ``part`` (from 0) and ``parts``. A key with more
    than ``rows_per_part`` rows has several parts, all others have one. Rows go
    to parts by a hash of ``spread_by``. Reads ``df`` twice."""
    heavy = heavy_keys(df, key, rows_per_part)
    n_heavy = heavy.count()
    if n_heavy <= MAX_BROADCAST_KEYS:
        heavy = F.broadcast(heavy)
    hashed = F.conv(F.substring(F.md5(spread_by), 1, 8), 16, 10).cast("bigint")
    parts = F.coalesce("slots", F.lit(1))
    placed = df.join(heavy, key, "left") if n_heavy else df.withColumn("slots", F.lit(1))
    placed = placed.withColumns({"parts": parts, "part": F.pmod(hashed, parts).cast("int")})
    return placed.groupBy(key, "part", "parts")
