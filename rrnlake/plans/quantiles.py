"""Exact medians that do not gather the values of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BIN_BITS = 12


def weighted_median(
    counts: DataFrame, key: str, value: str, weight: str, name: str, bin_bits: int = BIN_BITS
) -> DataFrame:
    """Interpolated median per key of a whole number `value` seen `weight` times.

    Two steps of a radix select: find the bins that hold the middle ranks from
    counts per bin, then look only at the values inside those bins. `key` may be
    a struct; NULL fields in it are ordinary values.
    """
    binned = counts.filter(F.col(weight) > 0).withColumn("_bin", F.shiftright(value, bin_bits))
    bins = binned.groupBy(key, "_bin").agg(F.sum(weight).alias("_bn"))
    upto = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(key)
    middle = (
        bins.withColumn("_cum", F.sum("_bn").over(upto))
        .withColumn("_total", F.sum("_bn").over(total))
        .withColumn("_r1", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_r2", F.floor(F.col("_total") / 2) + 1)
        .withColumn("_below", F.col("_cum") - F.col("_bn"))
        .filter((F.col("_below") < F.col("_r2")) & (F.col("_cum") >= F.col("_r1")))
        .select(F.col(key).alias("_key"), F.col("_bin").alias("_mbin"), "_below", "_r1", "_r2")
    )
    inside = Window.partitionBy(key, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        binned.join(middle, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bin") == F.col("_mbin")))
        .withColumn("_cum", F.col("_below") + F.sum(weight).over(inside))
        .groupBy(key)
        .agg(
            F.min(F.when(F.col("_cum") >= F.col("_r1"), F.col(value))).alias("_lo"),
            F.min(F.when(F.col("_cum") >= F.col("_r2"), F.col(value))).alias("_hi"),
        )
        .select(key, ((F.col("_lo") + F.col("_hi")) / 2).alias(name))
    )
