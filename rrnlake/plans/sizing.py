"""Checks on the size of data before a plan depends on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000
PART_ROWS = 1 << 17


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint when it is counted to be at most max_rows rows.

    Meant for narrow rows (ids and coordinates). Above the bound df comes back
    without a hint and the planner shuffles, with its bloom filter in front.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def parts_for(df: DataFrame, rows: int = PART_ROWS) -> int:
    """Partitions of at most about `rows` rows each, one per core at least. Counts df, so meant for written tables."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores for heavy per-row work on a scan of few input splits.

    Scans with at least one split per core keep their partitions and are not
    shuffled. Not for plans with shuffles: asking those for their partitions
    would run them.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want, *keys) if df.rdd.getNumPartitions() < want else df
