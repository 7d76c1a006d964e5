"""Exact token counts for every context limit, from a length histogram.

Documents are counted by encoded length with map-side combining; suffix and
prefix sums over the histogram then answer totals, quantiles and truncated
totals for any limit. The sums are taken in blocks of lengths and over the
blocks, so no task sorts the whole histogram.

Defined results
- a null or empty text has length 0; repeated rows count each;
- an empty table has an empty histogram, and no rows for any question;
- other columns of the input don't matter.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.byte_tokens import ids_of
from lexiloom.llm.frames import per_batch, stored

BLOCK = 256


def lengths(documents: DataFrame, path: str) -> DataFrame:
    """The encoded length of every document's whole text."""
    def count(batch: pa.RecordBatch) -> dict:
        return {"length": pa.array([len(ids_of(path, t)) for t in batch.column("text").to_pylist()], pa.int64())}
    return documents.select("text").mapInArrow(per_batch(count), "length long")


def histogram(encoded: DataFrame) -> DataFrame:
    """length and n_documents, stored."""
    return stored(encoded.groupBy("length").agg(F.count("*").alias("n_documents")))


def with_sums(counted: DataFrame) -> DataFrame:
    """For each length as a context limit: how much lies at and above it, and below it.

    n_at_least and tokens_at_least are suffix sums; truncated_total is what is
    left of the corpus if every document is cut at the limit; share is the part
    of the documents that fit into it.
    """
    tokens = F.col("length") * F.col("n_documents")
    blocked = counted.withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = blocked.groupBy("block").agg(F.sum("n_documents").alias("n"), F.sum(tokens).alias("t"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    # A row for each 256 lengths: a few thousand, however many documents there are.
    blocks = blocks.select(
        "block", *(F.coalesce(F.sum(c).over(above), zero).alias(f"{c}_above") for c in ("n", "t")),
        *(F.sum(c).over(whole).alias(f"{c}_all") for c in ("n", "t")))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc())
    summed = blocked.join(blocks, "block").select(
        "length", "n_documents", "n_all", "t_all",
        (F.sum("n_documents").over(inside) + F.col("n_above")).alias("n_at_least"),
        (F.sum(tokens).over(inside) + F.col("t_above")).alias("tokens_at_least"))
    below = F.col("t_all") - F.col("tokens_at_least")
    return summed.select(
        F.col("length").alias("context_limit"), "n_documents", "n_at_least", "tokens_at_least",
        (below + F.col("length") * F.col("n_at_least")).alias("truncated_total"),
        (1 - (F.col("n_at_least") - F.col("n_documents")) / F.col("n_all")).alias("share"),
        F.col("n_all").alias("all_documents"), F.col("t_all").alias("all_tokens"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, n_at_least (documents of more tokens than fit, or just as many) and truncated_total of any limits."""
    wanted = sums.sparkSession.range(1).select(F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("asked"))
    # The least length that is not below the limit has the sums of all limits from the length before it.
    least = sums.crossJoin(F.broadcast(wanted)).groupBy("asked").agg(
        F.min_by(F.struct("n_at_least", "tokens_at_least"), F.when(F.col("context_limit") >= F.col("asked"), F.col("context_limit"))).alias("s"),
        F.first("all_tokens").alias("t"))
    n, tokens = F.coalesce("s.n_at_least", F.lit(0)), F.coalesce("s.tokens_at_least", F.lit(0))
    return least.select(F.col("asked").alias("context_limit"), n.alias("n_at_least"),
                        (F.col("t") - tokens + F.col("asked") * n).alias("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share and the least length that holds at least that share of the documents."""
    wanted = sums.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, shares))).alias("asked"))
    return sums.crossJoin(F.broadcast(wanted)).where("share >= asked").groupBy(F.col("asked").alias("share")).agg(
        F.min("context_limit").alias("length"))
