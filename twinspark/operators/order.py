"""Global numbers and running sums without a single task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinspark.shared import table


def running(df: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the inclusive running sum of ``value`` in the order ``by`` (a key): range partitions, each summed
    by itself, plus the totals of those before it."""
    parts = table(df.withColumn("_value", value.cast("long")).repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")
    inside = F.sum("_value").over(Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    totals = parts.groupBy("_part").agg(F.sum("_value").alias("_n"))  # one row a partition
    base = totals.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.withColumn(name, inside).join(base, "_part").withColumn(name, F.col(name) + F.col("_base")).drop("_value", "_part", "_n", "_base")


def numbered(df: DataFrame, by: list[str], name: str, start: int = 0) -> DataFrame:
    """``df`` with its place in the order ``by``, from ``start``."""
    return running(df, by, F.lit(1), name).withColumn(name, F.col(name) - 1 + start)


def following(df: DataFrame, by: str, last: Column, name: str) -> DataFrame:
    """``df`` with the next value of the unique column ``by``, and ``last`` where there is none."""
    placed = numbered(df, [by], "_at")
    after = placed.select((F.col("_at") - 1).alias("_at"), F.col(by).alias(name))
    return placed.join(after, "_at", "left").withColumn(name, F.coalesce(name, last)).drop("_at")
