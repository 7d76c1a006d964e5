"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Pieces are dealt at random into blocks of about ``block`` pieces, each a
packing problem of its own with several islands. An island is one row: the
block's lengths and a small population of assignments. In each epoch every
island evolves by itself in a task; then its elite moves to the next island of
the block. Crossover injects whole well-filled bins of one parent into the
other, drops the bins that hold duplicates of their pieces, and best-fits the
pieces that this displaces. The pieces in the bins that stay open are dealt
into new, fewer blocks and packed again, so blocks cost no more than their last
few bins. No step holds more than a block; hot sources or copies don't matter,
as rows are dealt by a number of their own.

Defined results
- a null text is an empty one: a piece with the end id alone;
- only documents longer than a sequence are cut; the first piece is the shorter one;
- repeated rows and ids are documents of their own; an empty table gives no rows;
- other columns of the input are not returned.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.byte_tokens import ids_of
from lexiloom.llm.frames import tidied
from lexiloom.session import settle

#: A derived column: crc32 of a piece's ids as unsigned little-endian 32-bit integers.
CRC32 = ("long", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
PIECE = "row long, doc_id {}, piece int, start long, length long"


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece."""
    first = length % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(documents: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
           derive: dict[str, tuple[str, pa.DataType, Callable]] | None = None) -> DataFrame:
    """The pieces of documents (doc_id, text), stored, with a number of their own (``row``).

    ``derive`` names columns made from a piece's ids: (Spark type, Arrow type,
    function); by default the ids themselves.
    """
    derive = derive or {"ids": ("array<int>", pa.list_(pa.int32()), lambda ids: ids.astype(np.int32))}
    source = documents.select("doc_id", "text")
    schema = ", ".join([PIECE.format(source.schema["doc_id"].dataType.simpleString()), *(f"{n} {t}" for n, (t, *_) in derive.items())])
    names = ["row", "doc_id", "piece", "start", "length", *derive]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            taken, numbers, made = [], [], [[] for _ in derive]
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(ids_of(path, text), np.uint32(end_id))
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    taken.append(i)
                    numbers.append((row, k, start, length))
                    row += 1
                    for column, (_, _, fn) in zip(made, derive.values()):
                        column.append(fn(ids[start:start + length]))
            r, k, s, n = np.array(numbers, np.int64).reshape(-1, 4).T
            columns = [pa.array(r), batch.column("doc_id").take(pa.array(taken, pa.int64())), pa.array(k.astype(np.int32)), pa.array(s), pa.array(n)]
            columns += [pa.array(v, t) for v, (_, t, _) in zip(made, derive.values())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return settle(source.mapInArrow(tidied(run), schema))


def best_fit(order: np.ndarray, lengths: np.ndarray, assigned: np.ndarray, fills: list[int], capacity: int) -> None:
    """Puts pieces, in this order, where the least room is left; opens bins as needed. Changes assigned and fills."""
    wide = len(lengths) + len(fills) + 1
    room = sorted((capacity - f) * wide + b for b, f in enumerate(fills) if 0 < f < capacity)
    placed = []
    for n in lengths[order].tolist():
        k = bisect_left(room, n * wide)
        if k < len(room):
            left, b = divmod(room.pop(k), wide)
            left -= n
        else:
            b, left = len(fills), capacity - n
            fills.append(0)
        placed.append(b)
        fills[b] = capacity - left
        if left:
            insort(room, left * wide + b)
    assigned[order] = placed


def compact(assigned: np.ndarray) -> np.ndarray:
    """Bins numbered without gaps, in the same order."""
    return (np.cumsum(np.bincount(assigned) > 0) - 1)[assigned].astype(np.int32)


def fitness(assigned: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins are better; among equals, well-filled bins beside nearly empty ones."""
    fills = np.bincount(assigned, lengths) / capacity
    return -len(fills) + float((fills**2).mean())


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Injects about a third of the bins of ``a``, best-filled more likely, into ``b``; loosens the emptiest bins."""
    fills = np.bincount(a, lengths)
    chosen = rng.random(len(fills)) < 0.6 * (fills / capacity) ** 4
    injected = chosen[a]
    child = b + len(fills)
    spoilt = np.zeros(b.max() + 1, bool)
    spoilt[b[injected]] = True
    rest = np.bincount(b, lengths)
    spoilt[np.argsort(rest, kind="stable")[:1 + len(rest) // 50]] = True
    loose = spoilt[b] & ~injected
    child[injected] = a[injected]
    child[loose] = -1
    settled = np.flatnonzero(~loose)
    child[settled] = compact(child[settled])
    filled = np.bincount(child[settled], lengths[settled]).astype(int).tolist() if len(settled) else []
    order = np.flatnonzero(loose)
    best_fit(order[np.argsort(-lengths[order], kind="stable")], lengths, child, filled, capacity)
    return compact(child)


def seed(lengths: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Best fit, longest first, the order disturbed by ``noise``."""
    assigned = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths * (1 + noise * rng.random(len(lengths))), kind="stable")
    best_fit(order, lengths, assigned, [], capacity)
    return compact(assigned)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, size: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """A population of ``size``, best first. Ends early at the least number of bins that the sum allows."""
    least = -(-int(lengths.sum()) // capacity)
    ranked = sorted(((fitness(p, lengths, capacity), i, p) for i, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    while len(ranked) < size:
        made = seed(lengths, capacity, rng, 0.15 * len(ranked))
        ranked.append((fitness(made, lengths, capacity), len(ranked), made))
        if made.max() + 1 <= least:
            break
    ranked.sort(key=lambda x: (-x[0], x[1]))
    for g in range(generations):
        if ranked[0][2].max() + 1 <= least:
            break
        i, j = rng.choice(len(ranked), 2, replace=len(ranked) < 2)
        child = crossover(ranked[i][2], ranked[j][2], lengths, capacity, rng)
        ranked.append((fitness(child, lengths, capacity), size + g, child))
        ranked = sorted(ranked, key=lambda x: (-x[0], x[1]))[:size]
    return [p for *_, p in ranked]


def _island_task(capacity: int, generations: int, size: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for block, island, lengths, population in zip(*(batch.column(c).to_pylist() for c in ("block", "island", "lengths", "population"))):
                rng = np.random.default_rng([block, island, epoch])
                parents = [np.frombuffer(p, np.int32) for p in population]
                states.append([p.tobytes() for p in evolve(np.array(lengths), parents, capacity, generations, size, rng)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("island"), batch.column("lengths"), pa.array(states, pa.list_(pa.binary()))],
                ["block", "island", "lengths", "population"])
    return run


def _place(capacity: int):
    """Of a block's best assignment: block, row, bin, fill of the bin, offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, lengths, best in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "lengths", "best"))):
                bins, n = np.frombuffer(best, np.int32), np.array(lengths)
                order = np.lexsort((np.array(rows), bins))
                before = np.append(0, n[order].cumsum()[:-1])
                opens = np.append(True, bins[order][1:] != bins[order][:-1])
                offset = np.empty(len(n), np.int64)
                offset[order] = before - np.maximum.accumulate(np.where(opens, before, 0))
                yield pa.RecordBatch.from_pydict({
                    "block": np.full(len(n), block, np.int64), "row": np.array(rows, np.int64), "length": n,
                    "bin": bins.astype(np.int64), "fill": np.bincount(bins, n).astype(np.int64)[bins], "offset": offset})
    return run


def _packed(rows: DataFrame, count: int, level: int, capacity: int, block: int, islands: int, epochs: int,
            generations: int, size: int) -> DataFrame:
    """block, row, length, bin, fill and offset of rows (row, length), after one level of blocks."""
    blocks = max(1, -(-count // block))
    dealt = rows.groupBy(F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("row", "length"))).alias("items"))
    dealt = settle(dealt.select("block", F.col("items.row").alias("rows"), F.col("items.length").alias("lengths")))
    parts = -(-blocks * islands // 16)  # so that a task holds about 16 islands
    state = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths",
                         F.array().cast("array<binary>").alias("population"))
    for epoch in range(epochs):
        evolved = settle(state.repartition(parts, "block", "island").mapInArrow(
            tidied(_island_task(capacity, generations, size, epoch)),
            "block long, island int, lengths array<long>, population array<binary>"))
        # The elite of each island joins the population of the next one.
        elite = evolved.select("block", ((F.col("island") + 1) % islands).alias("island"), F.get("population", F.lit(0)).alias("elite"))
        state = evolved.join(elite, ["block", "island"]).select(
            "block", "island", "lengths", F.array_append("population", F.col("elite")).alias("population"))
    best = evolved.select("block", "island", F.get("population", F.lit(0)).alias("best"))
    scored = best.mapInArrow(tidied(_count_bins), "block long, island int, bins int, best binary")
    chosen = scored.groupBy("block").agg(F.min_by("best", F.struct("bins", "island")).alias("best"))
    return settle(dealt.join(chosen, "block").repartition(parts, "block").mapInArrow(
        tidied(_place(capacity)), "block long, row long, length long, bin long, fill long, offset long"))


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins = [int(np.frombuffer(b, np.int32).max()) + 1 for b in batch.column("best").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("island"), pa.array(bins, pa.int32()), batch.column("best")],
            ["block", "island", "bins", "best"])


def pack(items: DataFrame, capacity: int = 1024, block: int = 2048, levels: int = 3, islands: int = 4,
         epochs: int = 3, generations: int = 16, size: int = 8) -> DataFrame:
    """row, sequence_id and offset of each item (row: unique, length: 1 to ``capacity``).

    Each of the ``islands`` breeds ``generations`` children in a population of ``size``, ``epochs`` times over.
    """
    rows, done = items.select("row", "length"), []
    for level in range(levels):
        count = rows.count()
        if level and not count:
            break
        placed = _packed(rows, count, level, capacity, block, islands, epochs, generations, size)
        number = (F.col("block") * F.lit(1 << 32) + F.col("bin")) * levels + level
        last = level == levels - 1 or count <= block
        closed = placed if last else placed.where(F.col("fill") == capacity)
        done.append(closed.select("row", number.alias("sequence_id"), "offset"))
        if last:
            break
        rows = placed.where(F.col("fill") < capacity).select("row", "length")
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole


def pack_documents(documents: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, derive=None, **how) -> DataFrame:
    """doc_id, piece, start, length, the derived columns, sequence_id and offset of every piece."""
    made = pieces(documents, path, capacity, end_id, derive)
    return made.join(pack(made, capacity, **how), "row").drop("row")
