"""Records of delimited files whose quoted cells may hold line breaks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.sources import pieces


def walk(line: str, inside: bool) -> tuple[bool, int]:
    """Whether a line ends inside a quoted cell, and how many cells it ends, if it starts inside one or not.

    A quote opens a cell only at its start, is doubled inside, and closes it else.
    """
    at = ended = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True, ended
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at)
        if at < 0:
            return False, ended
        at, ended = at + 1, ended + 1


def _walked(lines: pa.Array) -> pa.Array:
    found = [(*walk(line, False), *walk(line, True)) for line in lines.to_pylist()]
    columns = [pa.array([f[i] for f in found], kind) for i, kind in ((0, pa.bool_()), (2, pa.bool_()), (1, pa.int64()), (3, pa.int64()))]
    return pa.StructArray.from_arrays(columns, ["end0", "end1", "cells0", "cells1"])


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, record, text, cells)``: the records of delimited files, numbered from 1 in each file (the header).

    Records without a character are left out (their numbers too); cells are counted by the commas between them.
    """
    walked = F.arrow_udf(_walked, "end0 boolean, end1 boolean, cells0 long, cells1 long")
    lines = pieces.scan(spark, path, "\n").withColumn("_w", walked(F.col("value"))).select("*", "_w.*").drop("_w")
    rows = pieces.running(lines, pieces.RUN, "i")

    def opened(state: str):
        return F.sum(F.when(F.col(state), 0).otherwise(1))

    runs = pieces.run_starts(rows, opened0=opened("start0"), opened1=opened("start1"))
    runs = runs.withColumn("opened", F.when(F.col("inside"), F.col("opened1")).otherwise(F.col("opened0")))
    starts = runs.select(*pieces.RUN, F.col("inside").alias("_inside"), pieces.before(runs, "opened").alias("_earlier"))
    inside = F.when(F.col("_inside"), F.col("start1")).otherwise(F.col("start0"))
    here = F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(pieces.Window.partitionBy(*pieces.RUN).orderBy("i"))
    placed = rows.join(starts, pieces.RUN).withColumn("inside", inside).withColumn("record", F.col("_earlier") + here)
    counted = placed.withColumn("cells", F.when(F.col("inside"), F.col("cells1")).otherwise(F.col("cells0")))
    whole = pieces.gathered(counted, "\n", "cells")
    text = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r$", "")
    return whole.select("file", "record", text.alias("text"), (F.col("cells") + 1).alias("cells")).filter("text <> ''")
