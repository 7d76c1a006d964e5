"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments, and every segment is an index of its own. In round
s all index entries at distance s from a query's segment are looked up, and the
codes found are verified. Codes that differ in fewer than ``segments * (s + 1)``
bits have been found by then, as one of their segments differs in at most s. A
query is done once its kth verified distance is below that; the others go on.

The index holds different codes, each with its ``k`` least ids: more of one code
can't be among the best, so copies of one vector make no hot entry. Codes that
are farther than a query's kth so far are dropped where they are met, and what
is left is kept to k for each query before it is shuffled.

Defined results
- the neighbours of a query are the k rows of least (distance, id), the query's
  own row included; with fewer than k rows, all of them;
- vectors that are null, hold nulls or have other than ``BITS`` components have
  no code: they are neither queries nor neighbours;
- a component that is NaN sets its bit, as Spark orders NaN above all numbers;
- ids that repeat with the same code count once; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored

BITS = 64


def sign_code(vector: Column) -> Column:
    """Bit i is set where component i is at least 0."""
    bits = F.transform(vector, lambda x, i: F.when(x >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when((F.size(vector) == BITS) & ~F.exists(vector, lambda x: x.isNull()), code)


def masks(width: int, distance: int) -> Column:
    """All values of ``width`` bits with ``distance`` of them set."""
    return F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: F.bit_count(m) == distance)


def _first(rows: DataFrame, per: str | list[str], k: int, *order: str) -> DataFrame:
    """The first k rows of each value; Spark drops the others in each task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, segments: int = 4) -> DataFrame:
    """query_id, vec_id, distance and rank of the k nearest rows; both tables have vec_id and code."""
    if segments < 4 or BITS % segments:
        raise ValueError("segments must divide the bits into parts of 16 at most")
    width = BITS // segments
    low = F.lit((1 << width) - 1)

    def cut(code: Column) -> Column:
        return F.array(*(F.shiftrightunsigned(code, i * width).bitwiseAND(low) for i in range(segments)))

    codes = _first(vectors.where("code IS NOT NULL").select("vec_id", "code").distinct(), "code", k, "vec_id").groupBy("code").agg(
        F.collect_list("vec_id").alias("ids"))
    index = stored(codes.select("code", "ids", F.posexplode(cut(F.col("code"))).alias("segment", "value")))
    pending = stored(queries.where("code IS NOT NULL").select(
        F.col("vec_id").alias("query_id"), F.col("code").alias("q"), F.lit(BITS).alias("bound")).distinct())
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best, done = None, []
    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
    for s in range(width + 1):
        near = F.explode(masks(width, s))
        # Dealt out by query first, into a stated number: a few bytes of queries make millions of probes, and
        # Spark would merge partitions by those bytes.
        dealt = pending.repartition(tasks, "query_id", "q")
        parts = dealt.select("query_id", "q", "bound", F.posexplode(cut(F.col("q"))).alias("part_no", "part")).withColumn("mask", near)
        probes = parts.select("query_id", "q", "bound", "part_no", F.col("part").bitwiseXOR(F.col("mask")).alias("probe"))
        # What is farther than the kth so far can't be among the best. Probes outgrow the
        # statistics of the table they are made of, so they must never be the broadcast side.
        met = (F.col("part_no") == F.col("segment")) & (F.col("probe") == F.col("value")) & (distance <= F.col("bound"))
        found = probes.join(index.hint("merge"), met).select(
            "query_id", "q", distance.alias("distance"), F.explode("ids").alias("vec_id"))
        seen = found if best is None else found.union(best)
        best = stored(_first(seen.distinct(), ["query_id", "q"], k, "distance", "vec_id"))
        # Whatever differs in at most this many bits has been found.
        covered = segments * (s + 1) - 1 if s < width else BITS
        state = best.groupBy("query_id", "q").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        closed = state.where((F.col("kth") <= covered) & ((F.col("n") >= k) | F.lit(covered >= BITS))).select("query_id", "q")
        done.append(best.join(closed, ["query_id", "q"], "left_semi"))
        if s < width:
            bound = F.when(F.col("n") >= k, F.col("kth")).otherwise(BITS).alias("bound")
            pending = stored(pending.select("query_id", "q").join(closed, ["query_id", "q"], "left_anti")
                             .join(state, ["query_id", "q"], "left").select("query_id", "q", bound))
            if pending.isEmpty():
                break
            best = best.join(pending, ["query_id", "q"], "left_semi").select("query_id", "q", "distance", "vec_id")
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole.select("query_id", "vec_id", F.col("distance").cast("int").alias("distance"), F.col("place").alias("rank"))
