"""Repeated long strings, by prefix-free parsing of the corpus.

**Parsing.** A rolling hash of ``TRIGGER`` bytes marks trigger strings; a phrase
runs from one trigger to the end of the next. Where a string of ``length`` bytes
occurs twice, both occurrences hold the same triggers at the same places: its
start lies in a suffix of one phrase of the dictionary (the ``a`` bytes before
its first trigger), and what follows is a stretch of the parse.

**Order.** Only strings of ``length`` bytes matter, and only whether they are
equal, so the corpus order that suffix arrays of dictionary and parse combine
into is needed to that depth alone, and up to equality. It is built by naming,
as in prefix doubling: prefix hashes give each stretch of the parse behind a
phrase suffix a name, and equal names are neighbours in the order. Suffixes of
a phrase are named together in bands of ``BANDS`` widths, so that a row stands
for a whole band of starts:

- ``c`` names what all starts of the band have in common (its core), ``f`` names
  all that they cover together;
- a core that occurs once: no start of the band is repeated;
- core and whole occur twice: all of them are;
- else the band is split, with one member of each different whole of that core.

The last bands are single starts, whose two names are 128 bits of the string
itself. A core shared by very many documents is only ever counted, never
gathered: every step is a grouped count with map-side combining, or a join whose
large side Spark can split.

Defined results
- a null text is an empty one; matches never cross documents; texts shorter than
  ``length`` bytes keep everything; an empty table gives no rows;
- texts are told apart by their SHA-256: repeated rows are copies of each other,
  and all bytes of copies of at least ``length`` bytes are removed;
- other columns of the input don't matter to the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored, tidied, without_nulls

TRIGGER = 16
#: One position in 64 is a trigger, on average.
TRIGGER_BITS = 6
BANDS = (128, 16, 1)
CHUNK = 1 << 18
# A place is 18 bits of partition, 37 of an address in it (of the band's anchor) and 8 of the width down to the least start.
# Every document starts at a page of its own. Inputs of more partitions are read by as many tasks as have a number.
PARTITION_BITS, WIDTH_BITS, ADDRESS_BITS, PAGE_BITS = 18, 8, 37, 14
_random = np.random.default_rng(20)
_BYTES = _random.integers(1, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (6364136223846793005, 3935559000370003845)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Names:
    """Names of all stretches of some bytes: two polynomials modulo 2**64 over random byte values."""

    powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint64),) * 2] * 2

    @classmethod
    def forget(cls) -> None:
        cls.powers = [(np.ones(1, np.uint64),) * 2] * 2

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.sums = []
        for h, base in enumerate(_BASES):
            if len(Names.powers[h][0]) <= self.size:
                Names.powers[h] = tuple(
                    np.append(np.uint64(1), np.full(self.size + CHUNK, x, np.uint64)).cumprod(dtype=np.uint64)
                    for x in (base, pow(base, -1, 1 << 64)))
            terms = np.zeros(self.size + 1, np.uint64)
            np.multiply(_BYTES[h][data], Names.powers[h][0][:self.size], out=terms[1:])
            self.sums.append(terms.cumsum(dtype=np.uint64))

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[which][end] - self.sums[which][start]) * Names.powers[which][1][start]
        raw ^= raw >> np.uint64(29)
        return (raw * _MIX).view(np.int64)

    def rolling(self, first: int, last: int) -> np.ndarray:
        """Hashes of the TRIGGER bytes behind each position from first until last."""
        raw = (self.sums[0][first + TRIGGER:last + TRIGGER] - self.sums[0][first:last]) * Names.powers[0][1][first:last]
        return raw * _MIX

    def triggers(self) -> np.ndarray:
        """Positions whose next TRIGGER bytes are a trigger string."""
        return np.flatnonzero(self.rolling(0, max(self.size - TRIGGER + 1, 0)) >> np.uint64(64 - TRIGGER_BITS) == 0)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from low to high of each range, and the range that each is from."""
    count = np.maximum(high - low + 1, 0)
    of = np.repeat(np.arange(len(low)), count)
    return low[of] + np.arange(len(of)) - np.repeat(count.cumsum() - count, count), of


def split(names: Names, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, width: int):
    """(anchor, low, skip, c, f, source) of the bands of ``width`` starts that hold the starts from low to high.

    Bands hang below their anchors; ``skip`` starts right at the anchor are not of the band, but of another.
    """
    k, of = _ranges(np.zeros(len(anchor), np.int64), (anchor - low) // width)
    top = anchor[of] - k * width
    bottom, last = np.maximum(top - width + 1, low[of]), np.minimum(top, high[of])
    kept = bottom <= last
    top, bottom, last, of = top[kept], bottom[kept], last[kept], of[kept]
    return top, bottom, top - last, names.of(0, top, top - width + 1 + length), names.of(1, bottom, last + length), of


def _least_anchors(names: Names, low: int, high: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For starts without a trigger in their string: anchors instead, and the least start of each (they ascend).

    The anchor is the place in the string whose rolling hash is least, the first of equal ones.
    """
    reach = length - TRIGGER + 1
    found = []
    for first in range(low, high + 1, CHUNK):
        last = min(high, first + CHUNK - 1)
        count = last - first + reach
        least = (names.rolling(first, first + count) >> np.uint64(24) << np.uint64(24)) | np.arange(count, dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        n = last - first + 1
        least = np.minimum(least[:n], least[reach - size:reach - size + n])
        anchor = first + (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        opens = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        found.append((anchor[opens], first + opens))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def first_bands(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """(document, anchor, low, skip, c, f) of all bands of the documents that lie in ``data`` from starts to ends."""
    names = Names(data)
    at = names.triggers()
    document = np.searchsorted(starts, at, side="right") - 1
    inside = at + TRIGGER <= ends[document] if len(at) else np.zeros(0, bool)
    at, document = at[inside], document[inside]
    fresh = np.append(True, document[1:] != document[:-1])[:len(at)]
    before = np.where(fresh, starts[document] - 1, np.append(-1, at[:-1])[:len(at)])
    # Starts whose first trigger lies in the string; the rest have none in it and stand alone.
    reach = np.maximum(before + 1, at - (length - TRIGGER))
    bands = split(names, at, reach, np.minimum(at, ends[document] - length), length, BANDS[0])
    final = starts - 1
    final[document] = at  # the last trigger of a document is the one that stays
    low, high = np.append(before + 1, final + 1), np.append(reach - 1, ends - length)
    owner = np.append(document, np.arange(len(starts)))
    high = np.minimum(high, ends[owner] - length)
    some = np.flatnonzero(low <= high)
    runs = [_least_anchors(names, int(low[i]), int(high[i]), length) for i in some]
    if not runs:
        return document[bands[5]], *bands[:5]
    anchor, least = (np.concatenate(x) for x in zip(*runs))
    of = np.repeat(some, [len(a) for a, _ in runs])
    # The starts of an anchor end where those of the next one, or the run, do.
    upto = np.where(np.append(of[1:] == of[:-1], False), np.append(least[1:], 0) - 1, high[of])
    more = split(names, anchor, least, upto, length, BANDS[0])
    return tuple(np.append(x, y) for x, y in zip((document[bands[5]], *bands[:5]), (owner[of][more[5]], *more[:5])))


def first_address(partition: int, page: int) -> int:
    """The address of a page of a partition; refuses what has no number of its own."""
    if partition >> PARTITION_BITS or page >> (ADDRESS_BITS - PAGE_BITS):
        raise OverflowError(f"partition {partition}, page {page}: more than 2**{PARTITION_BITS} partitions, or one of more than 2**{ADDRESS_BITS} bytes")
    return (partition << ADDRESS_BITS) + (page << PAGE_BITS)


def _parse(length: int):
    """Rows of bands (c, f, place) and of documents (place, key, n_bytes) of at least ``length`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, page = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            whole = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            long_enough = np.flatnonzero(np.diff(offsets) >= length)
            groups = (offsets[long_enough] - (offsets[long_enough[0]] if len(long_enough) else 0)) // CHUNK
            for rows in np.split(long_enough, np.flatnonzero(np.diff(groups)) + 1):
                if not len(rows):
                    continue
                first = offsets[rows[0]]
                starts, ends = offsets[rows] - first, offsets[rows + 1] - first
                owner, anchor, low, skip, c, f = first_bands(whole[first:offsets[rows[-1] + 1]], starts, ends, length)
                pages = ((ends - starts) >> PAGE_BITS) + 1
                base = first_address(partition, page) + ((pages.cumsum() - pages) << PAGE_BITS)
                page += int(pages.sum())
                first_address(partition, page)
                place = ((base[owner] + anchor - starts[owner]) << WIDTH_BITS) + (anchor - low + 1)
                n, d = len(place), len(rows)
                yield pa.RecordBatch.from_pydict({
                    "c": pa.array(np.append(c, np.zeros(d, np.int64))), "f": pa.array(np.append(f, np.zeros(d, np.int64))),
                    "place": pa.array(np.append(place, base << WIDTH_BITS)),
                    "skip": pa.array(np.append(skip, np.zeros(d, np.int64)).astype(np.int32)),
                    "key": pa.concat_arrays([pa.nulls(n, pa.binary()), batch.column("key").take(pa.array(rows))]),
                    "n_bytes": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(ends - starts)])})
    return run


def _listed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """anchor, low and high of each row's bands."""
    lists = batch.column("bands")
    columns = [lists.values.field(c).to_numpy() for c in ("anchor", "low", "high")]
    offsets = lists.offsets.to_numpy()
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield tuple(c[a:b] for c in columns)


def _union(low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """The maximal runs (start, end) that the strings from low to high of each band cover."""
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order] + length)
    opens = np.flatnonzero(np.append(True, low[1:] > end[:-1]))
    return np.stack([low[opens], end[np.append(opens[1:] - 1, len(end) - 1)]], 1)


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in a task; 16 bytes are kept of each."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for key in batch.column("key").to_pylist():
            fresh.append(key[:16] not in seen)
            seen.add(key[:16])
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _uncovered(length: int):
    """The keys of texts that keep a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [_union(*bands[1:], length).tolist() == [[0, n]] for n, bands in zip(batch.column("n_bytes").to_pylist(), _listed(batch))]
            yield batch.select(["key"]).filter(pa.array([not w for w in whole], pa.bool_()))
    return run


def _resplit(length: int, width: int):
    """Bands of ``width`` of the listed bands (anchor, low) of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, text, (anchor, low, high) in zip(batch.column("base").to_pylist(), batch.column("text"), _listed(batch)):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                top, bottom, skip, c, f, _ = split(Names(data), anchor, low, high, length, width)
                yield pa.RecordBatch.from_pydict({
                    "c": c, "f": f, "place": ((base + top) << WIDTH_BITS) + (top - bottom + 1), "skip": skip.astype(np.int32)})
    return run


def resolve(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of bands all of whose starts are repeated, and of those that must be split: one of each different whole."""
    # Stored, so that both sides of each join are plain exchanges: Spark can split those of a hot core.
    shared = stored(bands.groupBy("c").agg(F.count("*").alias("n")).where("n > 1").select("c"))
    open_cores = stored(bands.join(shared, "c", "left_semi"))
    wholes = stored(open_cores.groupBy("c", "f").agg(F.count("*").alias("n"), F.min("place").alias("place"),
                                                    F.min_by("skip", "place").alias("skip")))
    repeated = open_cores.join(wholes.where("n > 1").select("c", "f"), ["c", "f"], "left_semi").select("place", "skip")
    undecided = stored(wholes.where("n = 1").select("c").distinct())
    return stored(repeated), stored(wholes.join(undecided, "c", "left_semi").select("place", "skip"))


def _located(places: DataFrame, pages: DataFrame) -> DataFrame:
    """key, base, n_bytes, and the anchor, least and last start of each place."""
    found = places.withColumn("page", F.shiftright("place", WIDTH_BITS + PAGE_BITS)).join(pages, "page")
    anchor = F.shiftright("place", WIDTH_BITS) - F.col("base")
    width = F.col("place").bitwiseAND(F.lit((1 << WIDTH_BITS) - 1))
    return found.select("key", "base", "n_bytes", anchor.alias("anchor"), (anchor - width + 1).alias("low"),
                        (anchor - F.col("skip")).alias("high"))


def key_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _spans(length: int):
    """The maximal removed runs of each text, and the bytes that remain (none where the text isn't needed for them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, texts = [], [], []
            for n, text, bands in zip(batch.column("n_bytes").to_pylist(), batch.column("text"), _listed(batch)):
                runs = _union(*bands[1:], length)
                data = (text.as_py() or "").encode()
                edges = [0, *runs.ravel().tolist(), n]
                spans.append([{"start": a, "end": b} for a, b in runs.tolist()])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                texts.append(kept[-1].decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary()), pa.array(texts, pa.string())], ["key", "spans", "kept", "kept_text"])
    return run


def repeated_spans(documents: DataFrame, length: int = 400) -> DataFrame:
    """key (SHA-256), spans, kept (bytes) and kept_text of every different text of ``documents`` with something to remove.

    ``kept_text`` lacks the characters that were cut in two.
    """
    texts = documents.select(without_nulls("text")).withColumn("key", key_of(F.col("text")))
    # No shuffle: partitions are only put together where there are more than numbers for them.
    parsed = stored(texts.coalesce(1 << PARTITION_BITS).mapInArrow(tidied(_parse(length), Names.forget), "c long, f long, place long, skip int, key binary, n_bytes long"))
    heads = parsed.where("n_bytes IS NOT NULL").select(F.shiftright("place", WIDTH_BITS).alias("base"), "key", "n_bytes")
    pages = heads.select("*", F.explode(F.sequence(
        F.shiftright("base", PAGE_BITS), F.shiftright("base", PAGE_BITS) + F.shiftright("n_bytes", PAGE_BITS))).alias("page"))

    def gathered(places: DataFrame) -> DataFrame:
        """The bands of each document, as many as its length allows."""
        return _located(places, pages).groupBy("base", "key", "n_bytes").agg(
            F.collect_list(F.struct("anchor", "low", "high")).alias("bands"))

    repeated, pending = resolve(parsed.where("n_bytes IS NULL").select("c", "f", "place", "skip"))
    partly = gathered(repeated).select("key", "n_bytes", "bands").mapInArrow(tidied(_uncovered(length)), "key binary")
    # Only texts that are split further or keep a part are needed again, one of each.
    wanted = stored(partly.union(_located(pending, pages).select("key")).distinct())
    # Copies go where they are read, so a hot text sends one of each task to the join.
    fewer = texts.select("key", "text").mapInArrow(tidied(_without_copies), "key binary, text string")
    needed = stored(fewer.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))
    found = repeated
    for width in BANDS[1:]:
        listed = gathered(pending).join(needed, "key").select("base", "text", "bands")
        bands = stored(listed.mapInArrow(tidied(_resplit(length, width), Names.forget), "c long, f long, place long, skip int"))
        more, pending = resolve(bands)
        found = found.union(more)
    # Copies have the same spans: one of them is enough.
    whole = stored(gathered(found))
    one = whole.groupBy("key").agg(F.min("base").alias("base"))
    spans = whole.join(one, ["base", "key"], "left_semi").join(needed, "key", "left")
    return stored(spans.select("key", "n_bytes", "text", "bands").mapInArrow(
        tidied(_spans(length)), "key binary, spans array<struct<start:long,end:long>>, kept binary, kept_text string"))


def cut_documents(documents: DataFrame, length: int = 400) -> DataFrame:
    """Every row without its repeated bytes, in text and, where there is such a column, n_chars."""
    spans = repeated_spans(documents, length).select("key", "kept_text")
    rows = documents.select(F.struct("*").alias("row"), key_of(F.coalesce("text", F.lit(""))).alias("key"))
    kept, row = F.col("kept_text"), F.col("row")
    changed = row.withField("text", F.coalesce(kept, row["text"]))
    if "n_chars" in documents.columns:
        changed = changed.withField("n_chars", F.when(kept.isNull(), row["n_chars"]).otherwise(F.char_length(kept)))
    return rows.join(spans, "key", "left").select(changed.alias("row")).select("row.*")
