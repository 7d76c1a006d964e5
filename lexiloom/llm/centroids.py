"""Exact k-means rounds with ns-bounds.

Every vector keeps, for each centroid, the distance found when it was last
evaluated and the round of that evaluation. The history of centroids is kept
too, so a stored distance is loosened by the norm of the centroid's *total*
displacement since then, which is never more than the sum of its drifts. A
vector whose own distance, so loosened, stays below all others keeps its
cluster unseen; else its own distance is evaluated, and then those centroids
that may still be nearer. Distances are exact integers, the bounds only decide
what is evaluated, so results are those of plain rounds.

A round is one narrow stage over the stored state, and a sum by cluster and
component with map-side combining: ``k`` times the number of components, whatever
the data, reach the driver. The state of each round is written to the shared
folder, so a lost executor costs a re-read. Hot clusters don't matter: rows
aren't grouped by cluster, only partial sums are.

Defined results
- vectors that are null, have other than ``components`` components, or null or
  non-finite ones, or ones of 2**LIMIT_BITS or more in size after scaling (whose
  distances don't fit 64 bits), take no part and are not returned;
- a null id counts as an empty one for the seeding; repeated rows and ids are
  vectors of their own; of equal hashes, the lesser vector comes first;
- fewer vectors than ``k`` give as many centroids; none give no rows;
- other columns of the input don't matter and are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored

LIMIT_BITS = 26
ROWS = 4096


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, where the size allows it."""
    values = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    whole = F.forall(values, lambda x: F.coalesce(F.abs(x) < float(1 << LIMIT_BITS), F.lit(False)))  # neither null nor NaN
    return F.when(whole, F.transform(values, lambda x: F.floor(x).cast("int")))


def points(vectors: DataFrame, components: int, scale: int) -> DataFrame:
    """vec_id and x (integers) of the vectors that take part."""
    kept = vectors.where(F.size("embedding") == components).select("vec_id", scaled(F.col("embedding"), scale).alias("x"))
    return kept.where("x IS NOT NULL")


def seeds(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose salted ids have the least hashes."""
    mark = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(mark.alias("mark"), "x").orderBy("mark", "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal lengths as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.ravel(), kind))


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one centroid each, or all to the same."""
    difference = x - centre
    return np.einsum("ij,ij->i", difference, difference)


def displacements(history: np.ndarray, now: np.ndarray) -> np.ndarray:
    """[round, centroid]: how far each centroid has moved since that round."""
    return np.sqrt(((history.astype(np.float64) - now) ** 2).sum(-1))


def assign(x: np.ndarray, cluster: np.ndarray, found: np.ndarray, when: np.ndarray, history: np.ndarray) -> int:
    """Brings cluster, found (squared distances) and when (rounds) up to the last centroids; counts evaluations.

    The distance to a vector's own cluster is exact afterwards.
    """
    centroids, now = history[-1], len(history) - 1
    moved = displacements(history, centroids)
    rows, numbers = np.arange(len(x)), np.arange(len(centroids))
    # A little slack keeps rounding on the safe side.
    lower = (np.sqrt(found) - moved[when, numbers]) * (1 - 1e-9) - 1e-9
    own = np.sqrt(found[rows, cluster]) + moved[when[rows, cluster], cluster]
    lower[rows, cluster] = np.inf
    unsure = np.flatnonzero(lower.min(1, initial=np.inf) <= own * (1 + 1e-9) + 1e-9)
    # The distance of the own centroid first: it closes most cases.
    mine = cluster[unsure]
    found[unsure, mine] = distances(x[unsure], centroids[mine])
    when[unsure, mine] = now
    upper = np.sqrt(found[unsure, mine])[:, None] * (1 + 1e-9) + 1e-9
    near = lower[unsure] <= upper
    evaluated = len(unsure) + int(near.sum())
    for j in numbers:
        at = unsure[near[:, j]]
        found[at, j] = distances(x[at], centroids[j])
        when[at, j] = now
    near[np.arange(len(unsure)), mine] = True
    cluster[unsure] = np.where(near, found[unsure], np.iinfo(np.int64).max).argmin(1)  # of equal ones the first
    return evaluated


def _start(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = np.stack([distances(x, c) for c in centroids], 1)
    return found.argmin(1), found, np.zeros(found.shape, np.int64)


def _round(history: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                x = _matrix(batch.column("x")).astype(np.int64)
                if len(history) == 1:
                    cluster, found, when = _start(x, history[0])
                    evaluated = found.size
                else:
                    cluster = batch.column("cluster").to_numpy().astype(np.int64)
                    found = _matrix(batch.column("found")).astype(np.int64)
                    when = _matrix(batch.column("when")).astype(np.int64)
                    evaluated = assign(x, cluster, found, when, history)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("x"), pa.array(cluster, pa.int32()), _lists(found, pa.int64()),
                     _lists(when, pa.int16()), pa.array(np.append(evaluated, np.zeros(len(x) - 1, np.int64)))],
                    ["vec_id", "x", "cluster", "found", "when", "evaluated"])
    return run


def _sums(k: int):
    """Of each task: the sum of every component and the number of vectors, by cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster = _matrix(batch.column("x")).astype(np.int64), batch.column("cluster").to_numpy()
            total = np.zeros((k, x.shape[1]), np.int64) if total is None else total
            for j in np.unique(cluster):
                total[j] += x[cluster == j].sum(0)
            count += np.bincount(cluster, minlength=k)
        if total is not None:
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(count[some]), _lists(total[some], pa.int64())], ["cluster", "n", "total"])
    return run


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floored means of the clusters; empty ones stay."""
    parts = state.select("x", "cluster").mapInArrow(_sums(len(centroids)), "cluster int, n long, total array<long>")
    sums = (parts.select("cluster", "n", F.posexplode("total").alias("i", "value"))
            .groupBy("cluster", "i").agg(F.sum("value").alias("value"), F.sum("n").alias("n")))
    after = centroids.copy()
    for r in sums.collect():  # k times the number of components
        after[r["cluster"], r["i"]] = r["value"] // r["n"]
    return after


def cluster(rows: DataFrame, start: np.ndarray, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """State of all points (vec_id, x, cluster, distance, evaluated) after the rounds and a last assignment; the centroids."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, x array<int>, cluster int, found array<long>, when array<short>, evaluated long"
    history = start[None]
    state = stored(rows.mapInArrow(_round(history), schema))
    for _ in range(rounds):
        history = np.concatenate([history, _moved(state, history[-1])[None]])
        state = stored(state.mapInArrow(_round(history), schema))
    centroids = history[-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.column("cluster").to_numpy()
                found = distances(_matrix(batch.column("x")).astype(np.int64), centroids[own])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("vec_id", "x", "cluster")), pa.array(found), batch.column("evaluated")],
                    ["vec_id", "x", "cluster", "distance", "evaluated"])
    return state.mapInArrow(measured, f"vec_id {kind}, x array<int>, cluster int, distance long, evaluated long"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, components: int = 64, scale: int = 64, salt: str = "1:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector (vec_id, embedding) that takes part."""
    rows = stored(points(vectors, components, scale))
    start = seeds(rows, k, salt)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(start):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state, centroids = cluster(rows, start, rounds)
    measured = stored(state.select("vec_id", "cluster", "distance"))
    sums = {r["cluster"]: r["s"] for r in measured.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    # k rows at most: they are looked up in a map, so a hot cluster's rows stay where they are.
    per = F.create_map(*(x for j, s in sums.items() for x in (F.lit(j), F.lit(s).cast("long"))))
    digest = F.create_map(*(x for j in sums for x in (F.lit(j), F.lit(centroid_digest(centroids[j])))))
    return measured.select("vec_id", "cluster", "distance", per[F.col("cluster")].alias("cluster_inertia"),
                           F.lit(sum(sums.values())).cast("long").alias("inertia"), digest[F.col("cluster")].alias("centroid_sha256"))
