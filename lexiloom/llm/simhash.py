"""SimHash near-duplicates by covering locality-sensitive hashing.

Every fingerprint bit carries one of the 15 non-zero vectors of four bits (of
``2**(radius+1) - 1`` vectors of ``radius + 1`` bits in general). Table v keeps
the bits whose vector has an odd product with v. Any ``radius`` vectors have a
common v orthogonal to them all, so two fingerprints within the radius agree on
all kept bits of at least one table: no link is lost.

A bucket with more than ``bucket_limit`` different fingerprints is split again:
its members agree on the kept bits, so they differ in the others only, and the
same construction on those bits gives finer tables. After the last split a
bucket can hold 2**(free bits) fingerprints, a few hundred, whatever the data.
Only fingerprints, not documents, enter the tables: copies are one member.

Defined results
- a null or empty text has no words and the fingerprint zero, linked like any
  other; fewer words than a shingle are one shingle; shingles count as often as
  they occur;
- repeated rows and repeated ids are rows of their own, judged by their text;
- ``component_id`` is the least id that can be reached (null if all are null);
- other columns of the input don't matter and are not returned;
- an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.components import connected_components
from lexiloom.llm.frames import tidied, without_nulls
from lexiloom.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
BITS = 64


def shingles(text: Column, size: int) -> Column:
    """The word shingles of a text as an array of structs of words, repeats included."""
    words = F.split(F.btrim(F.translate(text, UPPER, LOWER), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    n = F.size(words)
    columns = [F.slice(words, F.lit(i + 1), F.greatest(n - size + 1, F.lit(0))) for i in range(size)]
    names = [f"w{i}" for i in range(size)]
    whole = F.struct(F.array_join(words, " ").alias("w0"), *(F.lit(None).cast("string").alias(c) for c in names[1:]))
    zipped = F.arrays_zip(*(c.alias(name) for c, name in zip(columns, names)))
    return F.when(n >= size, zipped).otherwise(F.array(whole))


def fingerprints(texts: DataFrame, size: int = 3) -> DataFrame:
    """``key`` and ``fp`` (64 bits as a long) of every different text with words.

    ``texts`` has columns key (the same for equal texts only) and text. One text
    of each key is counted, the map tasks drop most copies. Two counters share a
    long, 32 bits each: a text of 2 GB, the most there can be, has 2**30 shingles.
    """
    different = texts.where(F.btrim("text", F.lit(BLANKS)) != "").groupBy("key").agg(F.first("text").alias("text"))
    rows = different.select("key", F.inline(shingles(F.col("text"), size)))
    hashed = rows.select("key", F.xxhash64(F.concat_ws(" ", *(f"w{i}" for i in range(size)))).alias("h"))
    pair = F.lit((1 << 32) | 1)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(pair)).alias(f"s{i}") for i in range(32)]
    counted = hashed.groupBy("key").agg(F.count("*").alias("n"), *sums)

    def bit(i: int) -> Column:
        count = F.col(f"s{i % 32}")
        count = F.shiftrightunsigned(count, 32) if i >= 32 else count.bitwiseAND(F.lit((1 << 32) - 1))
        return F.when(2 * count > F.col("n"), F.lit((1 << i) - (1 << BITS if i == 63 else 0))).otherwise(F.lit(0))

    whole = bit(0)
    for i in range(1, BITS):
        whole = whole.bitwiseOR(bit(i))
    return counted.select("key", whole.alias("fp"))


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over some bit positions: any ``radius`` of them are all outside at least one mask."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << b for j, b in enumerate(bits) if ((j % vectors + 1) & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def finer_masks(masks: list[int], radius: int) -> list[list[int]]:
    """For each mask, masks that keep its bits and cover the bits that it leaves free."""
    return [[m | extra for extra in covering_masks([b for b in range(BITS) if not m >> b & 1], radius)] for m in masks]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> 63 else value


def _literal(masks: list[int]) -> Column:
    return F.array(*(F.lit(_signed(m)) for m in masks))


def _bucketed(rows: DataFrame, masks: Column, per: int) -> DataFrame:
    """tab, key, fp: a row for each finer mask of a row's table."""
    return (rows.select("fp", F.col("tab"), F.posexplode(masks).alias("i", "mask"))
            .select((F.col("tab") * per + F.col("i")).cast("int").alias("tab"),
                    F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))


def _forest(radius: int):
    """Of each bucket, edges that join all of its members that links within the radius join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(0):
                x = np.sort(np.array(members.as_py(), np.int64))
                near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= radius
                root = np.arange(len(x))
                for i, j in zip(*np.nonzero(np.triu(near, 1))):
                    if root[i] != root[j]:
                        root[root == max(root[i], root[j])] = min(root[i], root[j])
                        a.append(x[j])
                        b.append(x[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _edges_of(small: DataFrame, radius: int) -> DataFrame:
    lists = small.groupBy("tab", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return lists.select("fps").mapInArrow(tidied(_forest(radius)), "a long, b long")


def links(fps: DataFrame, radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """Edges (a, b) between different fingerprints that have the same components as all links within the radius."""
    per = (1 << (radius + 1)) - 1
    found = []
    coarse = covering_masks(list(range(BITS)), radius)
    fine = [m for masks in finer_masks(coarse, radius) for m in masks]
    finest = [m for masks in finer_masks(fine, radius) for m in masks]
    rows = fps.select("fp", F.lit(0).alias("tab"))
    for depth, level in enumerate((coarse, fine, finest)):
        groups = [level[i:i + per] for i in range(0, len(level), per)]
        chosen = _literal(groups[0]) if depth == 0 else F.get(F.array(*map(_literal, groups)), F.col("tab"))
        bucketed = _bucketed(rows, chosen, per)
        # Stored, so that the join has plain exchanges on both sides, which Spark can split where a bucket is hot.
        shared = settle(bucketed.groupBy("tab", "key").agg(F.count("*").alias("members")).where("members > 1"))
        sized = settle(bucketed.join(shared, ["tab", "key"]))
        if depth == 2:
            found.append(_edges_of(sized, radius))
            break
        found.append(_edges_of(sized.where(F.col("members") <= bucket_limit), radius))
        rows = sized.where(F.col("members") > bucket_limit).select("fp", "tab")
        if rows.isEmpty():
            break
    return reduce(DataFrame.union, found)


def classified(documents: DataFrame, size: int = 3, radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """doc_id, key (of the text), fp (long), root (of the component, a fingerprint) and component_id of every row."""
    texts = documents.select("doc_id", without_nulls("text")).withColumn("key", text_key(F.col("text")))
    known = settle(fingerprints(texts.select("key", "text"), size))
    rows = settle(texts.select("doc_id", "key").join(known, "key", "left")
                  .select("doc_id", "key", F.coalesce("fp", F.lit(0)).alias("fp")))
    least = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(least.select("fp"), radius, bucket_limit))
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp")


def near_duplicates(documents: DataFrame, size: int = 3, radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """doc_id, fp (long) and component_id of every row of ``documents`` (doc_id, text)."""
    return classified(documents, size, radius, bucket_limit).select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, size: int = 3, radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """One row of every component, that of the least id (null comes last; of equal ids, the least text hash)."""
    found = classified(documents, size, radius, bucket_limit)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    chosen = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias("id"), F.col("first.key").alias("chosen"))
    rows = documents.select(F.struct("*").alias("row"), "doc_id", text_key(F.coalesce("text", F.lit(""))).alias("key"))
    same = (rows["key"] == chosen["chosen"]) & rows["doc_id"].eqNullSafe(chosen["id"])
    return rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "key"]).select("row.*")


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
