"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidates.

**Signature.** Each shingle is a mixed 64-bit number; its upper part names one
of ``BANDS * ROWS`` bins, and a bin holds the least number that falls into it.
An empty bin takes the value of the first filled one in an order of its own
(optimal densification), so bins of two sets agree with a chance that is the
sets' similarity, however small the sets are. ``BANDS`` bands of ``ROWS`` bins:
a pair at the threshold 0.8 shares no bucket with a chance of 5 in 10**8.

**Candidates.** Sets that are equal are one node. In a bucket, one node (the
centre) is paired with the others: a star, no more pairs than members. Pairs are
confirmed on the full sets and links give components. A bucket whose members
(but the centre, which has met everyone) are one component is settled, since
more links would change nothing. The other buckets are searched in blocks: their
members are cut into chunks of about ``CHUNK_SHINGLES`` numbers, and a block is
two chunks. Inside a block, pairs of different components whose signatures agree
in ``LEAST_AGREEING`` bins (at a similarity of 0.8, all but 5 in 10**12 do) are
confirmed on the full sets, unless what is known of the block joins them
already. Only links leave a block, never pairs. So no link between two members
of a bucket is lost.

Only numbers travel: texts are read a second time for the nodes that share a
bucket, and only their sets are stored.

Defined results
- a null text, or one without words, has the empty set and is linked with
  nothing: its ``component_id`` is its own id; fewer words than a shingle are one
  shingle; shingles are told apart by 64-bit hashes;
- repeated rows and repeated ids are rows of their own, judged by their text;
- ``component_id`` is the least id that can be reached (null if all are null),
  ``kept`` is false for a null id;
- other columns of the input don't matter and are not returned;
- a very long text costs one task its words and 8 bytes a shingle;
- an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.components import connected_components
from lexiloom.llm.frames import stored, without_nulls

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
CHUNK_SHINGLES = 1 << 16
LEAST_AGREEING = 72
#: Hashes of words that a task keeps: a limit of memory, not of results.
KEPT_WORDS = 1 << 18
BATCH_BYTES = 4 << 20
_random = np.random.default_rng(12)
_STEPS = _random.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: The order in which each bin, when empty, looks for a filled one.
_ORDER = np.stack([_random.permutation(BINS) for _ in range(BINS)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """The set of word shingles of a text, as ascending 64-bit numbers."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n, size = len(hashes), min(self.size, len(hashes))
        total = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            total = _mixed(total * _STEPS[i] + hashes[i:n - size + 1 + i])
        return np.unique(total)


def signature(ordered: np.ndarray) -> np.ndarray:
    """The densified bins of a set that isn't empty; ``ordered`` ascends, and so do the bins."""
    at = ((ordered >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    filled, values = np.zeros(BINS, bool), np.zeros(BINS, np.uint64)
    values[at[first].astype(np.int64)] = ordered[first]
    filled[at[first].astype(np.int64)] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(1)]]
    return values


def hashes_of_bands(bins: np.ndarray) -> np.ndarray:
    rows = bins.reshape(BANDS, ROWS)
    total = np.zeros(BANDS, np.uint64)
    for i in range(ROWS):
        total = _mixed(total * _STEPS[32 + i] + rows[:, i])
    return total.view(np.int64)


def _described(size: int):
    """Of each text: its number of shingles, a digest of the set and its band hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            counts, keys, bands = [], [], []
            for text in batch.column("text"):
                found = shingles.of(text.as_py())
                counts.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(hashes_of_bands(signature(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_key", "n", "key", "bands"])
    return run


def _sets(size: int):
    """node and set of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            first, sets, held = 0, [], 0
            for i, text in enumerate(batch.column("text"), 1):
                sets.append(shingles.of(text.as_py()).view(np.int64))
                held += sets[-1].nbytes
                if held >= BATCH_BYTES or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("node").slice(first, i - first), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])
                    first, sets, held = i, [], 0
    return run


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have ``percent`` of their union in common."""
    sized = sets.select("node", "shingles", F.size("shingles").cast("long").alias("n"))
    right = sized.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"), F.col("n").alias("n_b"))
    # Members bring their sets to the centre, whose own is joined last: the pairs of a
    # hot centre are a plain exchange that Spark can split.
    half = pairs.join(right, "b")
    left = sized.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"), F.col("n").alias("n_a"))
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return half.join(left, "a").select("a", "b", "n_a", "n_b", shared.alias("common")).where(
        F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _within_size(percent: int) -> Column:
    """Sets of too different sizes can't be similar."""
    return F.lit(100) * F.least("n", "n_c") >= F.lit(percent) * F.greatest("n", "n_c")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their component, of the buckets that hold more than one, and the number of chunks of each bucket."""
    placed = stored(members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root"))
    chunks = F.ceil(F.sum("n") / F.lit(CHUNK_SHINGLES)).cast("int").alias("chunks")
    mixed = stored(placed.groupBy("band", "h").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), chunks)
                   .where("x <> y").select("band", "h", "chunks"))
    return stored(placed.join(mixed, ["band", "h"]))


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets have ``percent`` of their union in common."""
    at = np.searchsorted(one, other)
    common = int((one[np.minimum(at, len(one) - 1)] == other).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that join what is linked in a block: between its two chunks, or within its only one.

    A pair is left to the first band whose bucket it shares: that bucket is open as well.
    """
    nodes, comps, chunks = (table[c].to_numpy() for c in ("node", "comp", "chunk"))
    band, low, high = (table[c][0].as_py() for c in ("band", "low", "high"))
    sets = [s.values.to_numpy().view(np.uint64) for s in table["shingles"]]
    sizes = np.array([len(s) for s in sets])
    bins = np.stack([signature(s) for s in sets])
    buckets = np.stack([hashes_of_bands(b) for b in bins])
    root = {c: c for c in comps.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    made: list[tuple[int, int]] = []
    for i in range(len(nodes)):
        others = np.flatnonzero((comps != comps[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])))
        others = others[others > i] if low == high else others[chunks[others] == high] if chunks[i] == low else others[:0]
        others = others[~(buckets[others, :band] == buckets[i, :band]).any(1)]
        others = others[(bins[others] == bins[i]).sum(1) >= LEAST_AGREEING]
        for j in others.tolist():
            a, b = find(int(comps[i])), find(int(comps[j]))
            if a != b and similar(sets[i], sets[j], percent):
                root[max(a, b)] = min(a, b)
                made.append((int(nodes[i]), int(nodes[j])))
    return pa.table({"a": pa.array([a for a, _ in made], pa.int64()), "b": pa.array([b for _, b in made], pa.int64())})


def _links_in_blocks(pending: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = pending.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = dealt.select("band", "h", "node", "comp", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    return (blocks.join(sets, "node").groupBy("band", "h", "low", "high")
            .applyInArrow(lambda table: _block_links(table, percent), "a long, b long"))


def link(members: DataFrame, sets: DataFrame, percent: int = 80) -> DataFrame:
    """node and root of every node with a link, but for the roots; ``members`` has band, h, node and n."""
    bucket = ["band", "h"]
    centres = stored(members.groupBy(*bucket).agg(F.min_by(F.struct("node", "n"), "node").alias("c"))
                     .select(*bucket, F.col("c.node").alias("centre"), F.col("c.n").alias("n_c")))
    others = stored(members.join(centres, bucket).where("node <> centre"))
    pairs = stored(others.where(_within_size(percent)).select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    stars = stored(connected_components(confirmed(pairs, sets, percent)))
    pending = _open(others.select(*bucket, "node", "n"), stars)
    if pending.isEmpty():
        return stars
    more = stored(_links_in_blocks(pending, sets, percent))
    return stored(connected_components(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)))


def near_duplicates(documents: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``documents`` (doc_id, text).

    Two rows are linked where their shingle sets have at least ``percent`` of their union in common, 80 or more.
    """
    if percent < 80:
        raise ValueError("the bands find pairs from a similarity of 0.8 on")
    texts = documents.select("doc_id", without_nulls("text")).withColumn("text_key", text_key(F.col("text")))
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = stored(texts.mapInArrow(_described(size), f"doc_id {kind}, text_key binary, n long, key binary, bands array<long>"))
    # One node for each different set, with the row that stands for it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("first")
    nodes = stored(rows.where("n > 0").groupBy("key").agg(first, F.first("n").alias("n"), F.first("bands").alias("bands"))
                   .select(F.monotonically_increasing_id().alias("node"), "key", "n", "bands", "first.doc_id", "first.text_key"))
    each = nodes.select("node", "n", F.posexplode("bands").alias("band", "h"))
    # Stored, so that the join has plain exchanges on both sides, which Spark can split where a bucket is hot.
    shared = stored(each.groupBy("band", "h").agg(F.count("*").alias("members")).where("members > 1").select("band", "h"))
    members = stored(each.join(shared, ["band", "h"], "left_semi"))
    wanted = stored(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_key"))
    same = (texts["text_key"] == wanted["text_key"]) & texts["doc_id"].eqNullSafe(wanted["doc_id"])
    chosen = texts.join(wanted, same).select("node", "text").dropDuplicates(["node"])
    sets = stored(chosen.mapInArrow(_sets(size), "node long, shingles array<long>"))
    roots = link(members, sets, percent)
    rooted = stored(nodes.select("node", "key", "doc_id").join(roots, "node", "left").select(
        "key", "doc_id", F.coalesce("root", "node").alias("root")))
    ids = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    classes = stored(rooted.join(ids, "root").select("key", "component_id"))
    found = rows.select("doc_id", "n", "key").join(classes, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
