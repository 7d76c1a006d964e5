"""Where a limit falls in the order of each group, without sorting a group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import settle

#: Order values that one window may hold, whatever the size of a group.
VALUES = 200_000


def ranged(counts: DataFrame, group: str, value: str, buckets: int) -> DataFrame:
    """``counts`` cut into ``buckets`` ranges of (group, value), stored; ``_bucket`` numbers them in order."""
    return settle(counts.repartitionByRange(buckets, group, value).withColumn("_bucket", F.spark_partition_id()))


def _first_beyond(sums: DataFrame, group: str, order: str) -> DataFrame:
    """Of each group, the row in which ``_left`` falls (the last one if it falls behind them all), with ``_before``."""
    earlier = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter("_before < _left")
    fields = [F.col(c) for c in placed.columns if c != group]
    return placed.groupBy(group).agg(F.max_by(F.struct(*fields), F.col(order)).alias("_row")).select(group, "_row.*")


def cut(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Of each group, the value in which its ``_left``-th row falls, and ``_left`` within that value.

    ``counts`` is settled: ``(group, value, _n, _left)``, one row for each value
    of a group. Where it is long, it is cut into ranges of about ``VALUES`` rows
    first: a window over the sums of the ranges finds the range, a second one
    runs inside that range only.
    """
    n = counts.count()
    if n > VALUES:
        rows = ranged(counts, group, value, -(-n // VALUES))
        sums = rows.groupBy(group, "_bucket").agg(F.sum("_n").alias("_n"), F.first("_left").alias("_left"))
        found = settle(_first_beyond(sums, group, "_bucket").select(
            group, "_bucket", (F.col("_left") - F.col("_before")).alias("_left")))
        counts = rows.drop("_left").join(found, [group, "_bucket"]).drop("_bucket")
    placed = _first_beyond(counts, group, value)
    return placed.select(group, value, (F.col("_left") - F.col("_before")).alias("_left"))
