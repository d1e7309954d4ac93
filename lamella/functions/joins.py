"""Joins and running sums in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hot_keys(rows: DataFrame, on: list[str], share: int = 1000) -> DataFrame:
    """(on, _hot): keys with more than a `share`-th of all rows, of which there are fewer than `share`, so they can be broadcast."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("_n") * share > F.col("_total")).select(*on, F.lit(True).alias("_hot"))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str, by: Column, hot: DataFrame | None = None, ways: int = 32) -> DataFrame:
    """left joined with right, inner or left; rows of left's hot keys are spread over `ways` partitions by the hash of `by`.

    right's rows of hot keys are there once in each of them; `by` must be a function of the row, so that a repeated task gives
    the same partitions. hot: as hot_keys(left) gives, which is the default. Null keys meet nothing, as in any join.
    """
    hot = F.broadcast(hot_keys(left, on) if hot is None else hot)
    a = left.join(hot, on, "left").withColumn("_way", F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(ways)).cast("int")).otherwise(0)).drop("_hot")
    b = right.join(hot, on, "left").withColumn("_way", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return a.join(b, [*on, "_way"], how).drop("_way")


def prefix_sums(rows: DataFrame, by: list[str], order: str, value: str, block: int = 4096) -> DataFrame:
    """rows with `before`, the sum of `value` over the rows of the same `by` with a smaller `order`, a whole number, none twice.

    Sums are made on two levels: within blocks of the order, and over the sums of the blocks, so that the rows of a group,
    however many, are in one task only as one number a block.
    """
    cut = rows.withColumn("_block", F.floor(F.col(order) / block))
    sums = cut.groupBy(*by, "_block").agg(F.sum(value).alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*by, "_block", F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    within = F.sum(value).over(Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return cut.join(sums, [*by, "_block"]).withColumn("before", F.coalesce(within, F.lit(0)) + F.col("_earlier")).drop("_block", "_earlier")


def few_join(rows: DataFrame, keys: DataFrame, on: str, most: int = 1_000_000) -> DataFrame:
    """rows whose `on`, a whole number, is among the keys: where these are at most `most`, rows stay where they are."""
    few = keys.limit(most + 1).count() <= most
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")
