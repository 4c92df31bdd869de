"""Global order without a global window.

A window over one big contig, or over a whole genome set, is one task. Here the
order is a dense index built from a range sort, and neighbour access runs on
blocks of that index, each with a copy of the row on either side. Blocks have a
fixed number of rows however the keys are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.plans.durable import durable

BLOCK = 1 << 18
_ROW_BITS = 33  # low bits of monotonically_increasing_id() count rows of a partition


def dense_index(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Number all rows 1..n in key order.

    The sorted rows are written once: range bounds come from a sample, and a
    second run of the sort could place them differently.
    """
    placed = durable(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _ROW_BITS)
    # One row per partition of the sort, so the window and the broadcast are small.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1) + 1)
        .drop("_part", "_slot", "_before")
    )


def with_neighbours(df: DataFrame, index: str, fields: list[str], block: int = BLOCK) -> DataFrame:
    """Add structs `prev` and `next` with the fields of the rows at index-1 and index+1."""
    home = F.floor((F.col(index) - 1) / block)
    first = (F.col(index) - 1) % block == 0
    last = F.col(index) % block == 0
    copies = F.array_compact(
        F.array(
            F.struct(home.alias("block"), F.lit(True).alias("home")),
            F.when(first, F.struct((home - 1).alias("block"), F.lit(False).alias("home"))),
            F.when(last, F.struct((home + 1).alias("block"), F.lit(False).alias("home"))),
        )
    )
    order = Window.partitionBy("_b.block").orderBy(index)
    near = F.struct(*fields)
    return (
        df.withColumn("_b", F.explode(copies))
        .withColumn("prev", F.lag(near).over(order))
        .withColumn("next", F.lead(near).over(order))
        .filter("_b.home")
        .drop("_b")
    )


def number_within(df: DataFrame, group: str, index: str, name: str, block: int = BLOCK) -> DataFrame:
    """Number rows 1..n per group in index order, for an index that is already dense.

    Rows are counted per block of the index, so no task sees a whole group.
    """
    placed = df.withColumn("_block", F.floor((F.col(index) - 1) / block))
    sizes = placed.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_block").orderBy(index)
    return (
        placed.withColumn("_in", F.row_number().over(inside))
        .join(offsets, [group, "_block"])
        .withColumn(name, F.col("_before") + F.col("_in"))
        .drop("_block", "_in", "_before")
    )
