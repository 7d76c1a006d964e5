"""Files that are one JSON array each, read by as many tasks as they have splits.

No text is shuffled but that of elements that go over the end of a split. Each
of three passes over the files takes the pieces of a split in order: the first
tells what a split does to the state and the depth, a row each, the second
gives the elements within splits, the third what is left of them at their ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.session import settle
from lexiloom.sources import pieces

#: A split: ``part`` is the task that reads it, for a file that is given twice.
SPLIT = [*pieces.SPLIT, "part"]
#: How much text is walked at once, and a piece more.
SLICE_BYTES = 4 << 20
_QUOTE, _OPENS, _CLOSES = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
for _character, _kind in (('"', _QUOTE), ("{", _OPENS), ("[", _OPENS), ("]", _CLOSES)):
    _KINDS[ord(_character)] = _kind
_BACKSLASH = ord("\\")


class Walked(NamedTuple):
    """What pieces that follow each other do: whether each ends inside a string and shifts the depth, if the first starts outside one."""

    inside: np.ndarray
    #: The shift of each piece by its brackets and the brace behind it, if the first piece starts outside a string, and if inside.
    shifts: tuple[np.ndarray, np.ndarray]


def walk(data: np.ndarray, ends: np.ndarray) -> Walked:
    """Pieces, each with its closing brace, as one text; ``ends`` are 0 and the ends of the pieces in it."""
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    # What is behind a backslash that isn't itself escaped is no bracket and no quote. A brace ends each run of backslashes of a piece.
    slashes = np.flatnonzero(data == _BACKSLASH)
    if len(slashes):
        starts = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) > 1, slashes, 0))
        behind = np.searchsorted(slashes, at) - 1
        run = np.where((behind >= 0) & (slashes[behind] == at - 1), at - starts[behind], 0)
        at = at[run % 2 == 0]
    kinds = kinds[at]
    quotes = kinds == _QUOTE
    inside = (np.cumsum(quotes) - quotes) % 2 == 1
    depth = np.where(quotes, 0, np.where(kinds == _OPENS, 1, -1))
    bounds = np.searchsorted(at, ends)

    def total(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])[bounds]

    ends_inside = total(quotes)[1:] % 2 == 1
    return Walked(ends_inside, (np.diff(total(np.where(inside, 0, depth))) - ~ends_inside, np.diff(total(np.where(inside, depth, 0))) - ends_inside))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut where a split ends and into parts of about ``SLICE_BYTES``: the split, the pieces' rows, their text and the ends of the pieces in it."""
    last = -1
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        number = batch.column("i").to_numpy()
        if number[0] <= last or (np.diff(number) <= 0).any():
            raise ValueError("the pieces are not in their order")
        last = number[-1]
        value = batch.column("value").cast(pa.large_binary())
        ends = np.frombuffer(value.buffers()[1], np.int64)[value.offset:value.offset + n + 1]
        data = np.frombuffer(value.buffers()[2], np.uint8)
        cut = np.diff((ends[:-1] - ends[0]) // SLICE_BYTES) > 0
        for name in SPLIT:
            column = batch.column(name)
            cut |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(cut) + 1).tolist(), n]
        for first, end in zip(cuts, cuts[1:]):
            rows = batch.slice(first, end - first)
            yield tuple(rows.column(name)[0].as_py() for name in SPLIT), rows, data[ends[first]:ends[end]], ends[first:end + 1] - ends[first]


@dataclass
class _Effect:
    """Of a split so far: whether it changes the state, how it shifts the depth, and its least shift behind a piece that ends outside strings, from both states."""

    odd: bool = False
    shift: list[int] = field(default_factory=lambda: [0, 0])
    least: list[int | None] = field(default_factory=lambda: [None, None])

    def take(self, walked: Walked) -> None:
        for s in (0, 1):
            state = self.odd ^ s
            shifts = self.shift[s] + np.cumsum(walked.shifts[state])
            outside = shifts[walked.inside == state]
            if len(outside):
                least = int(outside.min())
                self.least[s] = least if self.least[s] is None else min(self.least[s], least)
            self.shift[s] = int(shifts[-1])
        self.odd = bool(self.odd ^ walked.inside[-1])


_EFFECTS = "file string, block bigint, part bigint, odd boolean, shift0 bigint, shift1 bigint, least0 bigint, least1 bigint"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split, its effect."""
    found: dict[tuple[str, int, int], _Effect] = {}
    for split, _, data, ends in _stretches(batches):
        found.setdefault(split, _Effect()).take(walk(data, ends))
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4)
    schema = pa.schema([(c.split()[0], t) for c, t in zip(_EFFECTS.split(", "), types)])
    if found:
        rows = [(*split, e.odd, *e.shift, *e.least) for split, e in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class _Open:
    """Of a split so far: the state and the depth, the text behind the last end of an element, and the piece of that end."""

    start: pa.RecordBatch
    inside: bool
    depth: int
    last: int | None = None
    held: list[bytes] = field(default_factory=list)

    def text(self, more: bytes = b"") -> pa.RecordBatch:
        """The held text as a row; what starts in an earlier split is named after that one."""
        own = self.last is not None
        names = ["file", *SPLIT[1:], *SPLIT[1:]] if own else ["file", "from_block", "from_part", *SPLIT[1:]]
        columns = [self.start.column(name) for name in names]
        text = pa.array([b"".join([*self.held, more])], pa.binary())
        return pa.RecordBatch.from_arrays([*columns[:3], pa.array([self.last], pa.int64()), *columns[3:], text], _TEXT_NAMES)


_TEXTS = "file string, block bigint, part bigint, row bigint, at_block bigint, at_part bigint, text binary"
_TEXT_NAMES = [c.split()[0] for c in _TEXTS.split(", ")]


def _texts(rest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that end in the split that they start in or, for ``rest``, what is in front of the first end in a split and behind the last.

    ``block`` and ``part`` are the split that an element starts in, and ``row`` is
    the piece behind which it starts, known where it starts.
    """
    splits: dict[tuple[str, int, int], _Open] = {}
    for split, rows, data, ends in _stretches(batches):
        if split not in splits:
            # Taken, so that the whole batch isn't kept.
            start = rows.slice(0, 1).take(pa.array([0]))
            inside, depth = (start.column(name)[0].as_py() for name in ("inside", "depth"))
            if inside is None:
                raise ValueError("the files were split in another way while they were read")
            splits[split] = _Open(start, inside, depth)
        now = splits[split]
        walked = walk(data, ends)
        depths = now.depth + np.cumsum(walked.shifts[now.inside])
        closed = np.flatnonzero((walked.inside == now.inside) & (depths <= 1))
        now.inside, now.depth = bool(now.inside ^ walked.inside[-1]), int(depths[-1])
        if not len(closed):
            if rest or now.last is not None:
                now.held.append(data.tobytes())
            continue
        at, number = ends[closed + 1], rows.column("i").to_numpy()[closed]
        if rest == (now.last is None):
            yield now.text(data[:at[0]].tobytes())
        if not rest and len(closed) > 1:
            text = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
            same = [rows.column(name).slice(0, len(text)) for name in SPLIT]
            yield pa.RecordBatch.from_arrays([*same, pa.array(number[:-1]), *same[1:], text], _TEXT_NAMES)
        now.held, now.last = [data[at[-1]:].tobytes()], int(number[-1])
    if rest:
        for split in splits.values():
            yield split.text()


def elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block, row, text)``: the objects of JSON arrays, as text; (block, row) follows their order.

    Files are cut at closing braces. A piece shifts the depth by its brackets
    outside strings; an element ends with the piece that brings the depth back
    to that of the array. A file with a single object, or several, gives those.
    What isn't an object stays in front of the object behind it.
    """
    # The row number of the scan has its task in front of 33 bits.
    cut = pieces.scan(spark, path, "}").select(
        *pieces.SPLIT, F.shiftright("i", 33).alias("part"), "i", F.concat("value", F.lit("}")).cast("binary").alias("value"))
    effects = settle(cut.mapInArrow(_effects, _EFFECTS))
    earlier = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    states = effects.withColumn("inside", F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1)
    chosen = {name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0")) for name in ("shift", "least")}
    depths = states.withColumns(chosen).withColumn("depth", F.coalesce(F.sum("shift").over(earlier), F.lit(0)))
    # An element is named after the piece behind which it starts: of its split, or of an earlier one.
    ended = F.when(F.col("depth") + F.col("least") <= 1, F.struct("block", "part"))
    origin = F.last(ended, True).over(earlier)
    starts = depths.withColumn("_from", origin).select(*SPLIT, "inside", "depth", *(
        F.coalesce(F.col(f"_from.{name}"), F.lit(-1).cast("bigint")).alias(f"from_{name}") for name in ("block", "part")))
    # A row for each split: broadcast, so that the pieces stay where and in the order that they are in.
    placed = cut.join(F.broadcast(settle(starts)), SPLIT, "left")
    whole = placed.mapInArrow(partial(_texts, False), _TEXTS).select("file", "block", "row", F.col("text").cast("string").alias("text"))
    parts = placed.mapInArrow(partial(_texts, True), _TEXTS)
    joined = F.array_sort(F.collect_list(F.struct("at_block", "at_part", F.col("text").cast("string").alias("text"))))
    over = parts.groupBy("file", "block", "part").agg(F.coalesce(F.max("row"), F.lit(-1).cast("bigint")).alias("row"), F.array_join(joined["text"], "").alias("text"))
    text = F.regexp_replace("text", r"^[\s,\[]+", "")
    found = whole.unionByName(over.select("file", "block", "row", "text"))
    return found.select("file", "block", "row", text.alias("text")).filter(F.contains("text", F.lit("{")))
