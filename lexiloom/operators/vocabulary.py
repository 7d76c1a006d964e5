"""Vocabulary look-up for term tables of any length: one pass over each text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.session import settle

#: Characters of terms in one automaton (some 100 bytes of memory each), and of texts that meet it at a time.
SHARD_CHARACTERS = 1_000_000
PART_CHARACTERS = 16_000_000


def automaton(terms: list[tuple[int, str]]) -> ahocorasick.Automaton | None:
    """Finds all of some terms ``(ord, term)`` in one pass; of a term that repeats, the lowest ``ord`` counts."""
    if not terms:
        return None
    found = ahocorasick.Automaton()
    for entry in sorted(terms, reverse=True):
        found.add_word(entry[1], entry)
    found.make_automaton()
    return found


def _first_terms(texts: pa.ChunkedArray | pa.Array, low: pa.ChunkedArray | pa.Array, found: ahocorasick.Automaton | None) -> pa.RecordBatch:
    hits = [None if t is None or found is None else min((entry for _, entry in found.iter(t)), default=None) for t in low.to_pylist()]
    kept = pa.array([h is not None for h in hits], pa.bool_())
    hits = [h for h in hits if h is not None]
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return pa.RecordBatch.from_arrays(
        [texts.filter(kept), pa.array([o for o, _ in hits], pa.int64()), pa.array([t for _, t in hits], pa.string())], ["text", "ord", "original"])


def _in_one_pass(terms: list[tuple[int, str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms)
        for batch in batches:
            yield _first_terms(batch.column("text"), batch.column("low"), found)
    return run


def _in_blocks(terms: pa.Table, texts: pa.Table) -> pa.Table:
    """One shard of the terms against one part of the texts."""
    found = automaton(list(zip(terms["ord"].to_pylist(), terms["original"].to_pylist())))
    return pa.Table.from_batches([_first_terms(texts["text"], texts["low"], found)])


def lookup_terms(texts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """For each distinct text, the first term (lowest ``ord``, then the term) that its lower-case form contains.

    ``terms`` is ``(ord, original)``. They become automata, each of terms of
    about ``SHARD_CHARACTERS``, so the time taken grows with the length of the
    texts and not with the number of terms, however short one is. A single
    automaton's terms are sent to all tasks: that bounds what is sent. Several
    meet the texts in blocks of one shard and one part of them, so texts are
    read once for each shard. Texts are made distinct first: a hot text is
    looked up once. Texts without a term are left out, and empty terms match
    nothing.
    """
    known = settle(terms.filter("original <> ''").select(F.col("ord").cast("bigint").alias("ord"), "original"))
    low = F.lower("text")
    different = texts.select(F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    shards = -(-(known.agg(F.sum(F.char_length("original"))).first()[0] or 0) // SHARD_CHARACTERS)
    schema = "text string, ord bigint, original string"
    if shards <= 1:
        sent = [(r["ord"], r["original"]) for r in known.collect()]  # SHARD_CHARACTERS at most
        hits = different.select("text", low.alias("low")).mapInArrow(_in_one_pass(sent), schema)
    else:
        stored = settle(different)
        parts = -(-(stored.agg(F.sum(F.char_length("text"))).first()[0] or 0) // PART_CHARACTERS) or 1
        each = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (shards, parts)]
        left = known.withColumn("shard", F.pmod(F.xxhash64("original"), F.lit(shards)).cast("int")).withColumn("part", each[1])
        right = stored.select("text", low.alias("low"), F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int").alias("part")).withColumn("shard", each[0])
        met = left.groupBy("part", "shard").cogroup(right.groupBy("part", "shard")).applyInArrow(_in_blocks, schema)
        hits = met.groupBy("text").agg(F.min(F.struct("ord", "original")).alias("hit")).select("text", "hit.*")
    return hits.select(F.col("text").alias(text), "ord", "original")
