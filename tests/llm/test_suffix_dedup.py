"""Repeated strings against every window of every text."""

import hashlib
import random
from collections import Counter

import pytest
from data import prose

from lexiloom.llm import queries, suffix_dedup


def expected(texts, length):
    """(spans, kept bytes) of each different text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = {}
    for b in raw:
        covered = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                covered[i:i + length] = [True] * length
        spans, start = [], None
        for i, c in enumerate([*covered, False]):
            if c and start is None:
                start = i
            elif not c and start is not None:
                spans.append((start, i))
                start = None
        out[hashlib.sha256(b).digest()] = (spans, bytes(x for x, c in zip(b, covered) if not c))
    return {k: v for k, v in out.items() if v[0]}


def found(df, length):
    return {bytes(r.key): ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.repeated_spans(df, length).collect()}


@pytest.mark.parametrize("length", [400, 150])
def test_corpus(documents, rows, length):
    assert found(documents, length) == expected([r[1] for r in rows], length)


@pytest.mark.parametrize("seed", range(3))
def test_edited_copies(spark, seed):
    rng = random.Random(seed)
    base = prose(rng, 400)
    texts = []
    for _ in range(25):
        words = base.split()
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(words))
            words[i:i + rng.randint(0, 3)] = rng.choices(["é", "new", "x" * 500, "ab " * 200], k=rng.randint(0, 2))
        texts.append(prose(rng, rng.randint(0, 60)) + " ".join(words[rng.randrange(100):]))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    assert found(df, 400) == expected(texts, 400)


def test_query(spark, documents, rows, tmp_path):
    """All five columns, by brute force."""
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    want = expected([r[1] for r in rows], 400)
    lines = []
    for r in rows:
        raw = (r[1] or "").encode()
        spans, kept = want.get(hashlib.sha256(raw).digest(), ([], raw))
        lines.append((r[0], len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    got = queries.QUERIES["op1_suffix_dedup"](spark, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == sorted(lines, key=str)


def test_cut_documents(documents, rows):
    want = expected([r[1] for r in rows], 400)
    cut = suffix_dedup.cut_documents(documents, 400)
    assert cut.columns == documents.columns and cut.count() == len(rows)
    others = [c for c in documents.columns if c not in ("text", "n_chars")]
    assert sorted(map(str, cut.select(others).collect())) == sorted(map(str, documents.select(others).collect()))
    texts = Counter(r.text for r in cut.collect())
    assert texts == Counter(
        t if (w := want.get(hashlib.sha256((t or "").encode()).digest())) is None else w[1].decode(errors="ignore") for t in (r[1] for r in rows))


def test_empty(nothing):
    assert suffix_dedup.repeated_spans(nothing).count() == 0
    assert suffix_dedup.cut_documents(nothing).count() == 0


def test_places_of_many_partitions():
    """Partitions beyond the numbers are refused, and the last number is unlike the first."""
    last = (1 << suffix_dedup.PARTITION_BITS) - 1
    assert 0 == suffix_dedup.first_address(0, 0) < suffix_dedup.first_address(last, 0) < 1 << (63 - suffix_dedup.WIDTH_BITS)
    for partition in (1 << 18, 1 << 19, 800_000):
        with pytest.raises(OverflowError):
            suffix_dedup.first_address(partition, 0)
    with pytest.raises(OverflowError):
        suffix_dedup.first_address(0, 1 << (suffix_dedup.ADDRESS_BITS - suffix_dedup.PAGE_BITS))


def test_more_partitions_than_numbers(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PARTITION_BITS", 2)
    shared = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(f"{i} {shared} {i * 7}",) for i in range(40)]
    found = suffix_dedup.repeated_spans(spark.createDataFrame(rows, "text string").repartition(9)).collect()
    assert len(found) == 40
