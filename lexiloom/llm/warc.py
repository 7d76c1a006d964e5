"""WARC archives with a two-level capture index.

Archives are written by the tasks that hold the pages: each record is a gzip
member of its own, so it can be read by range. The index holds a line for each
capture, sorted by the url's key (host reversed) and cut into compressed blocks;
a sparse directory (first key, last key, place of each block) finds a block by
binary search, and the block finds the record. Directory and wanted keys are
ranged by key together, so a task searches its range of the directory only.

Files go to a folder that all executors see, under names that no other attempt
of a task uses; only files named in a stored manifest count, so a lost or
repeated task leaves at worst a file that nothing refers to.

Defined results
- a null html is an empty payload; a null url has the empty key;
- of equal payloads of ``least_bytes`` or more, the one with the smallest page
  id is the response (rows that repeat that id too); a null id comes last, and
  where all are null, all are responses;
- control characters of a url are percent-encoded in the archive's header;
- other columns of the input are not stored; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored, without_nulls
from lexiloom.session import work_folder

ID = "urn:lexiloom:page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
HEADS = 100_000  # directory entries in a task's memory
CAPTURE = "key string, file string, offset long, length long"
RECORD = ("page string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
DIRECTORY = "first_key string, last_key string, file string, offset long, length long, captures long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: Column) -> Column:
    """``com,example,www)/path``: host reversed and lower-cased, then what follows."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    turned = F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ",")
    return F.when(F.instr(url, "://") > 0, F.concat(turned, F.lit(")"), rest)).otherwise(url)


def record(page: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One response, or revisit of another page, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{ID}{page}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return pressed(head.encode() + block + b"\r\n\r\n")


def pressed(data: bytes) -> bytes:
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def parse(member: bytes) -> dict:
    """A record's fields; the payload of a response must have its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    bare = lambda name: fields[name].removeprefix(f"<{ID}").removesuffix(">") if name in fields else None
    return {"page": bare("WARC-Record-ID") or None, "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": bare("WARC-Refers-To"), "payload_bytes": size, "payload_digest": named,
            "payload": payload if response else None}


class Output:
    """A new file in a folder of any file system that its URI names."""

    def __init__(self, folder: str, kind: str, suffix: str):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        self.name = f"{kind}-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
        self.stream = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = 0

    def add(self, data: bytes) -> int:
        """The offset at which it was written."""
        self.stream.write(data)
        self.size += len(data)
        return self.size - len(data)


def read_ranges(folder: str, rows: Iterator[tuple[str, int, int]]) -> Iterator[bytes]:
    """The ranges (file, offset, length); consecutive ones of a file share its handle."""
    store, path = fs.FileSystem.from_uri(folder)
    name, source = None, None
    for file, offset, length in rows:
        if file != name:
            if source:
                source.close()
            name, source = file, store.open_input_file(f"{path}/{file}")
        yield source.read_at(length, offset)


def _write_records(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            files, offsets, lengths = [], [], []
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "html", "refers_to"))):
                if out is None or out.size >= file_bytes:
                    if out:
                        out.stream.close()
                    out = Output(folder, "pages", ".warc.gz")
                    out.add(pressed(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                                    f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()))
                data = record(page or "", url, html.encode(), refers)
                files.append(out.name)
                offsets.append(out.add(data))
                lengths.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["key", "file", "offset", "length"])
        if out:
            out.stream.close()
    return run


def _write_blocks(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, lines, keys = None, [], []

        def block() -> pa.RecordBatch:
            data = pressed("\n".join(lines).encode())
            made = pa.RecordBatch.from_pydict({
                "first_key": [keys[0]], "last_key": [keys[-1]], "file": [out.name], "offset": [out.add(data)],
                "length": [len(data)], "captures": [len(lines)]})
            lines.clear()
            keys.clear()
            return made

        for batch in batches:
            for row in batch.to_pylist():
                out = out or Output(folder, "index", ".cdx.gz")
                keys.append(row["key"])
                lines.append(json.dumps([row["key"], row["file"], row["offset"], row["length"]]))
                if len(lines) >= block_lines:
                    yield block()
        if lines:
            yield block()
        if out:
            out.stream.close()
    return run


@dataclass(frozen=True)
class Archive:
    """A folder with archives and index files, and the sparse directory of the index blocks."""

    folder: str
    directory: DataFrame

    def parts(self, blocks: int = 64) -> int:
        """Into how many tasks to deal reads, whose rows are small beside what they read: some blocks of captures for each."""
        return max(self.directory.sparkSession.sparkContext.defaultParallelism, self.directory.count() // blocks)


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, block_lines: int = 1000,
          file_bytes: int = 1 << 26) -> Archive:
    """Archives of pages (page_id, url, html) and their index."""
    folder = folder or work_folder(pages.sparkSession)
    rows = pages.select("page_id", "url", without_nulls("html")).withColumn("sha", F.unhex(F.sha1("html")))
    # Stored, so that the join has plain exchanges on both sides: Spark can split that of a hot payload.
    shared = stored(rows.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"))
    later = F.coalesce(F.col("page_id") > F.col("first"), F.col("first").isNotNull())
    records = rows.join(shared, "sha", "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "html", url_key(F.col("url")).alias("key"),
        F.when(later, F.col("first").cast("string")).alias("refers_to"))
    # The stored table is the manifest: the files that its rows name are the archive.
    captures = stored(records.mapInArrow(_write_records(folder, file_bytes), CAPTURE))
    parts = max(1, captures.count() // (16 * block_lines))
    ordered = captures.repartitionByRange(parts, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return Archive(folder, stored(ordered.mapInArrow(_write_blocks(folder, block_lines), DIRECTORY)))


def _lines_of(folder: str, batch: pa.RecordBatch) -> Iterator[list]:
    places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
    for data in read_ranges(folder, places):
        yield [json.loads(line) for line in zlib.decompress(data, 31).decode().split("\n")]


def _as_captures(found: list) -> pa.RecordBatch:
    columns = zip(*found) if found else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
        ["key", "file", "offset", "length"])


def captures(archive: Archive) -> DataFrame:
    """key, file, offset and length of every capture in the index."""
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _lines_of(folder, batch):
                yield _as_captures(lines)

    return archive.directory.repartition(archive.parts(), "file", "offset").mapInArrow(run, CAPTURE)


def _search_directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range (part): its directory entries come first, by key, and then the wanted keys, each searched for among them."""
    part, firsts, blocks = None, [], []
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["part"] != part:
                part, firsts, blocks = row["part"], [], []
            if row["block"] is not None:
                firsts.append(row["key"])
                blocks.append(row["block"])
                continue
            # The last block that starts before the key; blocks that start with it are found by equality.
            at = bisect_left(firsts, row["key"]) - 1
            if at >= 0 and blocks[at]["last_key"] >= row["key"]:
                found.append((row["key"], blocks[at]["file"], blocks[at]["offset"], blocks[at]["length"]))
        yield _as_captures(found)


def _search_blocks(folder: str):
    """The captures of the wanted keys, which come block by block and in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, lines, known = None, [], []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                here = (row["file"], row["offset"], row["length"])
                if here != place:
                    place, data = here, next(read_ranges(folder, iter([here])))
                    lines = [json.loads(line) for line in zlib.decompress(data, 31).decode().split("\n")]
                    known = [line[0] for line in lines]
                found += lines[bisect_left(known, row["key"]):bisect_right(known, row["key"])]
            yield _as_captures(found)
    return run


def lookup(archive: Archive, urls: list[str] | DataFrame) -> DataFrame:
    """The captures of some urls: a list, or a table (url) of any length; repeated ones count once.

    A key's blocks are those that start with it (a frequent key has many), and
    the last one that starts before it, if it reaches the key. The latter is
    found by binary search in the part of the directory that has the key's
    range; a block is then read once by each task that searches it.
    """
    directory, spark = archive.directory, archive.directory.sparkSession
    if not isinstance(urls, DataFrame):
        urls = spark.createDataFrame([(u,) for u in urls], "url string")
    wanted = stored(urls.select(url_key(F.col("url")).alias("key")).distinct())
    # Of the blocks that start with the same key the last alone can reach beyond it. So no key occurs twice on either side.
    heads = directory.groupBy(F.col("first_key").alias("key")).agg(F.max(F.struct("last_key", "file", "offset", "length")).alias("block"))
    nothing = F.lit(None).cast(heads.schema["block"].dataType)
    both = heads.unionByName(wanted.withColumn("block", nothing))
    ranges = max(1, (directory.count() + wanted.count()) // HEADS)
    ranged = stored(both.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()))
    # A range may begin inside a block: it gets the last entry of the ranges before it. One row for each range.
    last = ranged.where("block IS NOT NULL").groupBy("part").agg(F.max(F.struct("key", "block")).alias("last"))
    parts = ranged.select("part").distinct().join(last, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("last", ignorenulls=True).over(before).alias("_before")).where("_before IS NOT NULL").select(
        F.col("_before.key").alias("key"), F.col("_before.block").alias("block"), "part")
    searched = ranged.select("key", "block", "part").unionByName(carried).repartition(ranges, "part").sortWithinPartitions(
        "part", F.col("block").isNull(), "key").mapInArrow(_search_directory, CAPTURE)
    starting = wanted.join(directory, wanted["key"] == directory["first_key"]).select("key", "file", "offset", "length")
    places = stored(searched.unionByName(starting))
    # By key too, so that very many keys of one block are several tasks' work.
    return places.repartitionByRange(archive.parts(), "file", "offset", "key").sortWithinPartitions("file", "offset", "key").mapInArrow(
        _search_blocks(archive.folder), CAPTURE)


def read(archive: Archive, chosen: DataFrame) -> DataFrame:
    """The records of some captures, by range; those of one file in the order of their offsets."""
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
            made = [parse(data) for data in read_ranges(folder, places)]
            yield pa.RecordBatch.from_pylist(made, pa.schema([
                *((c, pa.string()) for c in ("page", "url", "record_type", "refers_to")), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("payload", pa.binary())]))

    stretch = F.shiftright("offset", 22)  # about 4 MB of an archive
    return chosen.repartition(archive.parts(), "file", stretch).sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)
