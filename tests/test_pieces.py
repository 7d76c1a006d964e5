"""Files in many splits against the same files read whole."""

import csv
import gzip
import io
import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.schema import REVIEW_COLUMNS
from lexiloom.session import work_folder
from lexiloom.sources import arrays, pieces, quoted, readers, writers


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_walk_against_a_csv_reader():
    rng = random.Random(1)
    for _ in range(3000):
        line = "".join(rng.choice('a",  ') for _ in range(rng.randint(0, 12)))
        inside, ended = quoted.walk(line, False)
        whole = next(csv.reader(io.StringIO(line + ('"' if inside else ""))), [])
        assert ended == max(len(whole), 1) - 1, line


def review_file(rng, rows):
    cells = ["plain", "", 'said "so"', "a, b", "two\nlines", "three\n\n\"lines\",\n", "5\" pipe", "blank ", "ünï", "\ttab"]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(REVIEW_COLUMNS)
    for i in range(rows):
        row = [str(i)] + [rng.choice(cells) for _ in REVIEW_COLUMNS[1:]]
        writer.writerow(row[:5] if i % 11 == 5 else row + ["more", "cells"] if i % 13 == 7 else row)
    return out.getvalue()


@pytest.mark.parametrize("seed", [1, 2])
def test_review_in_splits_equals_the_one_task_read(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    texts = [review_file(rng, 150), review_file(rng, 3)]
    # An unquoted quote in the middle of a cell is a character, and says nothing about later lines.
    texts[0] += '900,a 5" pipe,x\n901,"closed",y\n'
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.csv").write_text(text, encoding="utf-8")
    path = str(tmp_path)
    assert pieces.scan(spark, path, "\n").select("file", "block").distinct().count() >= 8

    def found(**how):
        return sorted((tuple(r) for r in readers.read_review(spark, path, **how).collect()), key=repr)

    whole = found(by_records=False)
    assert len(whole) == 155 and any("\n" in c for r in whole for c in r if c)
    assert found(by_records=True) == whole == found()
    kept = found(drop_short=True)
    rows = [r for t in texts for r in list(csv.reader(io.StringIO(t)))[1:]]
    assert sorted(r[0] for r in kept) == sorted(r[0] for r in rows if len(r) >= len(REVIEW_COLUMNS))


def test_crlf_and_byte_order_mark(spark, tmp_path, small_splits):
    text = "﻿" + ",".join(REVIEW_COLUMNS) + "\r\n" + "".join(f'{i},"a\r\nb",c\r\n' for i in range(100))
    (tmp_path / "f.csv").write_bytes(text.encode())
    got = readers.read_review(spark, str(tmp_path), by_records=True).select(*REVIEW_COLUMNS[:3]).collect()
    assert sorted(map(tuple, got)) == sorted((str(i), "a\nb", "c") for i in range(100))


def test_line_numbers_whatever_the_splits(spark, tmp_path):
    rng = random.Random(3)
    lines = {}
    for f in range(3):
        text = []
        for i in range(200):
            good = json.dumps({"sentence": f"s {f} {i} " + "x" * rng.randint(0, 30), "intent": "i", "entities": [{"type": "t", "filler": "f"}] * (i % 3)})
            text.append("" if i % 17 == 3 else good[:-5] if i % 19 == 4 else good)
            if good == text[-1]:
                lines[f"s {f} {i}"] = i
        (tmp_path / f"f{f}.jsonl").write_text("\n".join(text) + "\n")
    for size in ("100000000", "3000", "611"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = readers.read_utterances(spark, str(tmp_path), numbered=True)
            for columns in (["sentence"], ["sentence", "entities", "sample_id"]):
                got = {" ".join(r["sentence"].split()[:3]): r["line"] for r in df.select("seq.line", *columns).collect()}
                assert got == lines
            assert sorted(r["seq"]["line"] for r in readers.read_lenient(spark, f"{tmp_path}/f1.jsonl", numbered=True).collect()) == sorted(
                n for k, n in lines.items() if k.startswith("s 1 "))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_another_split_in_the_second_pass_fails(spark, tmp_path):
    (tmp_path / "f.txt").write_text("line\n" * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = pieces.numbered(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        with pytest.raises(Exception, match="split in another way"):
            rows.agg(F.max("line")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_window_holds_a_whole_split(spark, tmp_path):
    """A split of very many pieces is cut into runs, and elements go on from one run to the next."""
    rows = [{"sentence": f's {i} }}"', "intent": "{" * (i % 3), "entities": [{"type": "t", "filler": "f"}] * (i % 4)} for i in range(5000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    cut = pieces.scan(spark, f"{tmp_path}/a.json", "}")
    assert cut.select("block").distinct().count() == 1 and cut.count() > 10_000
    assert cut.groupBy(*pieces.RUN).count().agg(F.max("count")).first()[0] <= 4096
    got = readers.read_training_set(spark, f"{tmp_path}/a.json", one_array=True).orderBy("seq").collect()
    assert [{"sentence": r["sentence"], "intent": r["intent"], "entities": [e.asDict() for e in r["entities"]]} for r in got] == rows


def odd_rows(n):
    rng = random.Random(n)
    texts = ["plain", 'a "quoted" } {', "br\\ack\\\\", "]}", "[{", "\n", '"', "", "ü }"]
    return [{"sentence": f"{i} {rng.choice(texts)}", "intent": rng.choice(texts),
             "entities": [{"type": rng.choice(texts), "filler": rng.choice(texts)} for _ in range(rng.randint(0, 3))]} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_in_splits(spark, tmp_path, small_splits, indent):
    rows = odd_rows(300)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps(rows[0]))
    (tmp_path / "d.json").write_text(" [ \n ] \n")
    assert pieces.scan(spark, f"{tmp_path}/a.json", "}").select("block").distinct().count() > 20
    got = readers.read_training_set(spark, str(tmp_path), one_array=True)
    a = got.filter(F.endswith("seq.file", F.lit("a.json"))).orderBy("seq").collect()
    assert [json.loads(json.dumps({"sentence": r["sentence"], "intent": r["intent"], "entities": [e.asDict() for e in r["entities"]]})) for r in a] == rows
    assert got.count() == 301


def test_an_array_written_by_many_tasks_is_one_document(spark, tmp_path, small_splits):
    rows = odd_rows(400)
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, text string").select(
        F.struct("i").alias("seq"), F.from_json("text", "sentence string, intent string, entities array<struct<type:string,filler:string>>, none int").alias("r")
    ).select("seq", "r.*").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_array(df, f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out").glob("part-*"))
    document = json.loads("".join(p.read_text(encoding="utf-8") for p in parts))
    assert len(parts) > 1 and document == [{**r, "none": None} for r in rows]
    assert (tmp_path / "out" / "_SUCCESS").exists()
    back = readers.read_training_set(spark, f"{tmp_path}/out", one_array=True)
    assert sorted(r["sentence"] for r in back.collect()) == sorted(r["sentence"] for r in rows)
    writers.write_array(df.limit(0), f"{tmp_path}/none")
    assert json.loads("".join(p.read_text() for p in (tmp_path / "none").glob("part-*"))) == []
    assert readers.read_training_set(spark, f"{tmp_path}/none", one_array=True).count() == 0


def test_a_million_rows_as_one_array(spark, tmp_path):
    rows = spark.range(1_000_000).select(F.struct("id").alias("seq"), F.concat(F.lit("s "), "id").alias("sentence"), F.lit('}"[').alias("intent"))
    writers.write_array(rows, f"{tmp_path}/out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        back = readers.read_training_set(spark, f"{tmp_path}/out", one_array=True)
        assert back.filter("intent = '}\"['").select(F.substring("sentence", 3, 9).cast("long").alias("n")).agg(
            F.count("*"), F.sum("n"), F.count_distinct("n")).first() == (1_000_000, 499_999_500_000, 1_000_000)
        assert back.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_are_numbered_through_the_part_files_of_a_folder(spark, tmp_path):
    texts = {k: [f"{k} {i}" for i in range(n)] for k, n in (("a", 700), ("b", 1), ("c", 90))}
    rows = spark.createDataFrame([(k, i, v) for k, lines in texts.items() for i, v in enumerate(lines)], "k string, i int, value string")
    rows.repartitionByRange(5, "k", "i").sortWithinPartitions("k", "i").select("k", "value").write.partitionBy("k").text(f"{tmp_path}/t")
    assert len(list((tmp_path / "t" / "k=a").glob("part-*.txt"))) > 1
    found = pieces.numbered(spark, f"{tmp_path}/t/k=*", folders=True).collect()
    assert {(r["file"][-1], r["line"], r["value"]) for r in found} == {(k, i, v) for k, lines in texts.items() for i, v in enumerate(lines)}
    assert len(found) == 791


def plain_walk(piece, inside):
    """Whether a piece ends inside a string and how it and its brace shift the depth, character by character."""
    shift, i = 0, 0
    while i < len(piece):
        if piece[i] == "\\" and i + 1 < len(piece) and piece[i + 1] != "\n":
            i += 2
            continue
        if piece[i] == '"':
            inside = not inside
        elif not inside:
            shift += {"{": 1, "[": 1, "]": -1}.get(piece[i], 0)
        i += 1
    return inside, shift - (not inside)


def test_walk_over_pieces_against_a_loop():
    rng = random.Random(5)
    for _ in range(500):
        cut = ["".join(rng.choices('"{[]\\,a\nü', k=rng.choice([0, 1, 4, 30]))) for _ in range(rng.randint(1, 6))]
        data = [f"{p}}}".encode() for p in cut]
        walked = arrays.walk(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        for start in (False, True):
            state = start
            for k, piece in enumerate(cut):
                state, shift = plain_walk(piece, state)
                assert (walked.inside[k] ^ start, walked.shifts[start][k]) == (state, shift), (cut, start)


@pytest.fixture
def stored_bytes(spark):
    """How many bytes of shuffle and work files have been added since the last call."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    local = [Path(d.getPath()) for d in manager.localDirs()]
    work, seen = Path(work_folder(spark)).parent, set()

    def added():
        found = {f: f.stat().st_size for d, name in ((work, "part-*"), *((d, "shuffle_*.data") for d in local)) if d.exists() for f in d.rglob(name)}
        new = {f: n for f, n in found.items() if f not in seen}
        seen.update(new)
        return sum(new.values())

    added()
    return added


def test_an_array_is_shuffled_once_to_write_it_and_not_to_read_it(spark, tmp_path, stored_bytes):
    rows = spark.range(0, 40_000, 1, 4).select(
        F.struct(F.hash("id").alias("order")).alias("seq"), *(F.sha2(F.concat(F.lit(name), "id"), 512).alias(name) for name in ("sentence", "intent")))
    writers.write_array(rows, f"{tmp_path}/out")
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("part-*"))
    assert stored_bytes() < size  # one shuffle; a stored copy or a second shuffle would be more
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        back = readers.read_training_set(spark, f"{tmp_path}/out", one_array=True)
        assert back.agg(F.count("*"), F.sum(F.xxhash64("sentence", "intent").cast("decimal(38,0)"))).first() == rows.agg(
            F.count("*"), F.sum(F.xxhash64("sentence", "intent").cast("decimal(38,0)"))).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert stored_bytes() < size / 20


def test_elements_longer_than_splits(spark, tmp_path, small_splits):
    rows = [{"sentence": f"{i} " + "}{" * rng, "intent": "", "entities": [{"type": "[", "filler": "}" * 50}] * (rng // 9)}
            for i, rng in enumerate([0, 3000, 1, 0, 900, 900, 0])]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "cut.json").write_text(json.dumps(rows)[:2500])
    got = readers.read_training_set(spark, str(tmp_path), one_array=True).withColumn("name", F.regexp_extract("seq.file", "([a-z]+).json", 1)).orderBy("seq")
    whole = [(r["name"], r["sentence"], [e.asDict() for e in r["entities"]]) for r in got.filter("name <> 'cut'").collect()]
    assert whole == [(name, r["sentence"], r["entities"]) for name in "ab" for r in rows]
    assert got.filter("name = 'cut'").first()["sentence"] == "0 "


def test_an_array_whose_first_and_last_partitions_are_empty(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).select(F.struct("id").alias("seq"), F.col("id").cast("string").alias("sentence"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_array(rows.orderBy("seq").filter("seq.id BETWEEN 490 AND 510"), f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    document = json.loads("".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))))
    assert [r["sentence"] for r in document] == [str(i) for i in range(490, 511)]


def test_a_gzipped_array_is_one_document_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "_COMPRESSED_ROWS", 40)
    rows = odd_rows(300)
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, text string").select(
        F.struct("i").alias("seq"), F.from_json("text", "sentence string, intent string, entities array<struct<type:string,filler:string>>").alias("r")
    ).select("seq", "r.*").repartition(3)
    path = writers.export_for_training(df, str(tmp_path), "json", compression="gzip")
    parts = [gzip.decompress(p.read_bytes()).decode() for p in sorted(Path(path).glob("part-*.gz"))]
    assert json.loads("".join(parts)) == rows and len(parts) >= 8 and max(len(p.splitlines()) for p in parts) <= 40
    back = readers.read_training_set(spark, path, one_array=True).orderBy("seq").collect()
    assert [{"sentence": r["sentence"], "intent": r["intent"], "entities": [e.asDict() for e in r["entities"]]} for r in back] == rows
