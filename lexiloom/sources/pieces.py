"""Text files whose records aren't lines, read by as many tasks as they have splits.

A file is scanned as pieces between separators, wherever the separators stand.
Whether a piece starts inside a quoted text depends on all pieces before it; but
a piece alone tells what state it ends in for either state that it may start in.
Such functions compose, so states are found as prefix sums are: within each
run of a split for both of its possible starts, then across the runs of a file
(a row each), which decides between the two. A record is what lies between two pieces
that open one, and the pieces of a record, a few as a rule, meet in one group.

What is quadratic or whole-file nowhere occurs; a file that never closes its
quotes is one record from there on, as it is for a sequential reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.session import settle

SPLIT = ["file", "block"]
#: What states are found over: runs of a split's pieces, so that no window holds more than a run, however large a split.
RUN = [*SPLIT, "run"]
RUN_BITS = 12


def scan(spark: SparkSession, path: str | list[str], separator: str | None = None) -> DataFrame:
    """``(file, block, run, i, value)``: pieces, numbered upwards within a split, which ``block`` is the first byte of.

    ``run`` cuts the pieces of a split into runs of 4,096 at most, numbered upwards too.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"), "value").withColumn("run", F.shiftright("i", RUN_BITS))


def numbered(spark: SparkSession, path: str | list[str], folders: bool = False) -> DataFrame:
    """``(file, line, value)``: every line with its number in the file, from 0, however the file is split.

    With ``folders`` the part files of a folder, in the order of their names, are one
    text: ``file`` is then the folder, and the numbers run through its files.

    One pass counts the lines of each split, a second one adds what lies before
    it. A second pass that is split in another way than the first would be
    numbered wrongly, so it fails.
    """
    counted = scan(spark, path).groupBy(*SPLIT).agg(F.min("i").alias("_first"), F.count("*").alias("_n"))
    text = F.regexp_extract("file", "^(.*)/", 1) if folders else F.col("file")
    earlier = Window.partitionBy(text).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = settle(counted).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    at = F.col("i") - F.col("_first")
    same = (at >= 0) & (at < F.col("_n"))
    line = F.when(same, F.col("_before") + at).otherwise(F.raise_error(F.lit("the files were split in another way while they were read")).cast("bigint"))
    return scan(spark, path).join(settle(splits), SPLIT, "left").select(text.alias("file"), line.alias("line"), "value")


def _odd(n: Column) -> Column:
    return n % 2 == 1


def running(rows: DataFrame, per: list[str], *order: str) -> DataFrame:
    """States within each group of ``per``: adds start0, start1 (at a row's start) and after0, after1 (at its end).

    The number tells whether the group starts outside (0) or inside (1). ``end0``
    and ``end1`` tell the same of the row alone.
    """
    upto = Window.partitionBy(*per).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(F.when(F.col("end0") & ~F.col("end1"), 1).otherwise(0)).over(upto)
    # A row that ends alike from both states hides what was before it.
    fixed = F.last(F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("end"), F.col("_swaps").alias("swaps"))), True).over(upto)
    since = F.col("_fixed.end") != _odd(F.col("_swaps") - F.col("_fixed.swaps"))
    place = Window.partitionBy(*per).orderBy(*order)
    return (
        rows.withColumn("_swaps", swaps).withColumn("_fixed", fixed)
        .withColumn("after0", F.coalesce(since, _odd(F.col("_swaps")))).withColumn("after1", F.coalesce(since, ~_odd(F.col("_swaps"))))
        .withColumn("start0", F.lag("after0", 1, False).over(place)).withColumn("start1", F.lag("after1", 1, True).over(place))
        .drop("_swaps", "_fixed")
    )


def run_starts(rows: DataFrame, **totals: Column) -> DataFrame:
    """``(file, block, run, inside, <totals>)`` of each run, settled: the state at its start and totals over it.

    ``rows`` come from ``running`` over the runs; ``totals`` are aggregates.
    """
    ends = rows.groupBy(*RUN).agg(F.max_by(F.struct("after0", "after1"), F.col("i")).alias("end"), *(c.alias(n) for n, c in totals.items()))
    named = settle(ends).select(*RUN, F.col("end.after0").alias("end0"), F.col("end.after1").alias("end1"), *totals)
    return running(named, ["file"], "block", "run").select(*RUN, F.col("start0").alias("inside"), *totals)


def before(runs: DataFrame, name: str) -> Column:
    """The sum of a column over the earlier runs of the file."""
    earlier = Window.partitionBy("file").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(earlier), F.lit(0))


def gathered(rows: DataFrame, separator: str, *sums: str) -> DataFrame:
    """``(file, record, text, <sums>)``: the pieces of each record in order, joined by ``separator``."""
    pieces = F.array_sort(F.collect_list(F.struct("block", "i", "value")))
    joined = F.array_join(F.transform(pieces, lambda p: p["value"]), separator)
    return rows.groupBy("file", "record").agg(joined.alias("text"), *(F.sum(c).alias(c) for c in sums))
