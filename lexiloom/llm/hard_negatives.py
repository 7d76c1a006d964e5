"""Hard negatives by segment summary filtering.

A vector is cut into segments, and of each segment the mean and the deviation
are stored. A segment's share of an inner product is its width times the product
of the means, give or take the width times the product of the deviations; summed,
that bounds a score. Pairs are bounded by 4 segments first, what may still count
by 16, and only what is left then is scored exactly. Scores are exact integers.

Anchors meet all rows in blocks: rows are dealt into parts of about ``PART``
rows and anchors into strips of about ``STRIP``, and a group is one part and one
strip, whatever the labels and however many copies a vector has. From each group
come at most the first few rows of an anchor, which a window (limited in the map
tasks already) cuts to the first few of all. Two passes: the positives, then the
negatives in the score bands that the positives define.

Defined results
- rows with a null id or label, a null vector, or components that are null, not
  finite or of 2**LIMIT_BITS or more in size after scaling (whose products may not
  fit 64 bits) take no part; missing components of shorter vectors count as zero;
- repeated rows are rows of their own; a row is no partner of its own id;
- positives with a score below zero have no negatives (the band is empty);
- other columns of the input don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored

LEVELS = (4, 16)
LIMIT_BITS = 27
PART, STRIP = 4096, 4096
#: Anchors that are bounded at a time.
CHUNK = 64
NONE = np.iinfo(np.int64).min


def prepared(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and x (integers) of the rows that take part; ``vectors`` has vec_id, embedding and label."""
    values = F.transform("embedding", lambda v: F.lit(float(scale)) * v.cast("double"))
    whole = F.forall(values, lambda v: F.coalesce(F.abs(v) < float(1 << LIMIT_BITS), F.lit(False)))
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return rows.where(whole).select("vec_id", "label", F.transform(values, lambda v: F.floor(v).cast("int")).alias("x"))


def summaries(x: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each of ``level`` segments of equal width."""
    parts = x.reshape(len(x), level, -1).astype(np.float64)
    return parts.mean(-1), parts.std(-1)


def _summarised(width: int):
    """Rows padded to ``width`` components, with their summaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            x = np.zeros((batch.num_rows, width), np.int32)
            size = np.diff(lists.offsets.to_numpy())
            x[np.arange(width) < size[:, None]] = lists.flatten().to_numpy()
            made = [m for level in LEVELS for m in summaries(x, level)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _lists(x), *map(_lists, made)], ["vec_id", "label", "x", *NAMES])
    return run


NAMES = [f"{kind}{level}" for level in LEVELS for kind in ("mean", "dev")]


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.ravel()))


class Rows:
    """Some rows of a group as arrays."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.row = table["row"].to_numpy()
        self.ids, self.labels = table["vec_id"].to_numpy(), table["label"].to_numpy()

        def matrix(name: str) -> np.ndarray:
            return pa.concat_arrays(table[name].chunks).flatten().to_numpy().reshape(table.num_rows, -1)

        self.x = matrix("x")
        self.levels = {level: (matrix(f"mean{level}"), matrix(f"dev{level}")) for level in LEVELS}
        self.norm = np.sqrt((self.x.astype(np.float64) ** 2).sum(1))

    def taken(self, at: np.ndarray) -> Rows:
        part = object.__new__(Rows)
        part.row, part.ids, part.labels, part.x, part.norm = self.row[at], self.ids[at], self.labels[at], self.x[at], self.norm[at]
        part.levels = {level: (m[at], d[at]) for level, (m, d) in self.levels.items()}
        return part


def bounds(a: Rows, b: Rows, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores that the summaries of a level allow, for all pairs."""
    width = a.x.shape[1] // level
    (mean_a, dev_a), (mean_b, dev_b) = a.levels[level], b.levels[level]
    middle = width * (mean_a @ mean_b.T)
    # A little of the norms keeps rounding on the safe side.
    reach = width * (dev_a @ dev_b.T) + 1e-9 * np.outer(a.norm, b.norm) + 1e-6
    return middle - reach, middle + reach


def scores(a: Rows, b: Rows) -> np.ndarray:
    """Exact inner products; floating point serves while it is exact."""
    if a.norm.max(initial=0) * b.norm.max(initial=0) < 1 << 52:
        return (a.x.astype(np.float64) @ b.x.T.astype(np.float64)).astype(np.int64)
    return a.x.astype(np.int64) @ b.x.T.astype(np.int64)


def kth_largest(values: np.ndarray, k: int, without) -> np.ndarray:
    """Of each row, as a column; ``without`` where a row has fewer values."""
    if values.shape[1] < k:
        return np.full((len(values), 1), without)
    return np.partition(values, -k, axis=1)[:, -k:][:, :1]


def first_k(values: np.ndarray, k: int) -> np.ndarray:
    """Marks the k greatest values of each row that aren't NONE; of equal ones the first."""
    kth = kth_largest(values, k, NONE)
    equal = (values == kth) & (values != NONE)
    room = k - (values > kth).sum(1, keepdims=True)
    return (values > kth) | (equal & (equal.cumsum(1) <= room))


def _positives(anchors: Rows, rows: Rows, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and score of the first k rows of each anchor's label."""
    wanted = (anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids)
    at = np.arange(len(rows.ids))
    for level in LEVELS:
        part = rows.taken(at)
        low, high = bounds(anchors, part, level)
        wanted = wanted & (high >= kth_largest(np.where(wanted, low, -np.inf), k, -np.inf))
        some = wanted.any(0)
        at, wanted = at[some], wanted[:, some]
    found = np.where(wanted, scores(anchors, rows.taken(at)), NONE)
    i, j = np.nonzero(first_k(found, k))
    return i, at[j], found[i, j]


def _negatives(anchors: Rows, rows: Rows, least: np.ndarray, most: np.ndarray, k: int):
    """Anchor, band, row and score of the first k rows of other labels in each band from ``least`` to ``most``."""
    wanted = anchors.labels[:, None] != rows.labels
    at = np.arange(len(rows.ids))
    bands = [(b, least[:, b, None], most[:, b, None]) for b in range(least.shape[1])]
    for level in LEVELS:
        part = rows.taken(at)
        low, high = bounds(anchors, part, level)
        alive = np.zeros(wanted.shape, bool)
        for _, a, z in bands:
            inside = wanted & (low >= a) & (high <= z)
            floor = np.maximum(kth_largest(np.where(inside, low, -np.inf), k, -np.inf), a)
            alive |= wanted & (high >= floor) & (low <= z)
        some = alive.any(0)
        at, wanted = at[some], alive[:, some]
    exact = scores(anchors, rows.taken(at))
    made = []
    for b, a, z in bands:
        found = np.where(wanted & (exact >= a) & (exact <= z), exact, NONE)
        i, j = np.nonzero(first_k(found, k))
        made.append((i, np.full(len(i), b), at[j], found[i, j]))
    return tuple(np.concatenate(x) for x in zip(*made))


def _chunked(table: pa.Table) -> Iterator[tuple[pa.Table, Rows]]:
    for first in range(0, table.num_rows, CHUNK):
        part = table.slice(first, CHUNK)
        yield part, Rows(part)


def _in_blocks(rows: DataFrame, anchors: DataFrame, parts: int, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` on each group of one part of the rows and one strip of the anchors."""
    strips = anchors.agg(F.max("strip")).first()[0]
    strips = 1 if strips is None else strips + 1
    left = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = rows.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    return left.groupBy("part", "strip").cogroup(right.groupBy("part", "strip")).applyInArrow(fn, schema)


def _dealt(rows: DataFrame, name: str, size: int, n: int) -> DataFrame:
    return rows.withColumn(name, F.pmod("row", F.lit(max(1, -(-n // size)))).cast("int"))


def _first(rows: DataFrame, per: list[str], k: int) -> DataFrame:
    """The first k rows of each value, with their rank; Spark drops the others in each task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*per).orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 10, least_percent: int = 30,
         most_percent: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and x (as ``prepared`` gives them); ``is_anchor`` is an SQL condition on vec_id.
    A negative's score lies between the two percentages of the positive's.
    """
    kind, label = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    widest = vectors.agg(F.max(F.size("x"))).first()[0] or 1
    width = -(-widest // LEVELS[-1]) * LEVELS[-1]
    schema = f"vec_id {kind}, label {label}, x array<int>, " + ", ".join(f"{n} array<double>" for n in NAMES)
    rows = stored(vectors.mapInArrow(_summarised(width), schema).withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    parts = max(1, -(-n // PART))
    rows = _dealt(rows, "part", PART, n)
    anchors = rows.where(is_anchor).drop("part")
    anchors = stored(_dealt(anchors.withColumn("row", F.monotonically_increasing_id()), "strip", STRIP, anchors.count()))

    def near(strip: pa.Table, part: pa.Table) -> pa.Table:
        made = []
        if strip.num_rows and part.num_rows:
            whole = Rows(part.sort_by("vec_id"))
            for _, some in _chunked(strip):
                i, j, score = _positives(some, whole, positives)
                made.append((some.row[i], whole.ids[j], score))
        columns = [np.concatenate(x) for x in zip(*made)] or [np.zeros(0, np.int64)] * 3
        return pa.table({"anchor": columns[0], "vec_id": pa.array(columns[1], strip.schema.field("vec_id").type), "score": columns[2]})

    chosen = stored(_first(_in_blocks(rows, anchors, parts, near, f"anchor long, vec_id {kind}, score long"), ["anchor"], positives))
    listed = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("bands"))
    banded = stored(anchors.join(listed.withColumnRenamed("anchor", "row"), "row"))

    def beside(strip: pa.Table, part: pa.Table) -> pa.Table:
        made = []
        if strip.num_rows and part.num_rows:
            whole = Rows(part.sort_by("vec_id"))
            for table, some in _chunked(strip):
                bands = table["bands"].to_pylist()
                low, high = np.ones((len(bands), positives), np.int64), np.zeros((len(bands), positives), np.int64)
                for i, of_anchor in enumerate(bands):
                    for j, b in enumerate(of_anchor):  # rounded up below, down above
                        low[i, j], high[i, j] = -(-least_percent * b["score"] // 100), most_percent * b["score"] // 100
                i, b, j, score = _negatives(some, whole, low, high, negatives)
                made.append((some.row[i], b + 1, whole.ids[j], score))
        columns = [np.concatenate(x) for x in zip(*made)] or [np.zeros(0, np.int64)] * 4
        return pa.table({"anchor": columns[0], "positive": pa.array(columns[1], pa.int32()),
                         "vec_id": pa.array(columns[2], strip.schema.field("vec_id").type), "score": columns[3]})

    found = _first(_in_blocks(rows, banded, parts, beside, f"anchor long, positive int, vec_id {kind}, score long"),
                   ["anchor", "positive"], negatives)
    named = stored(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")).join(chosen.select(
        "anchor", F.col("rank").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "anchor"))
    return stored(found).join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
