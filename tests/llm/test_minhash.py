"""Signatures, buckets and components against plain Python."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from data import prose

from lexiloom.llm import minhash


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + size]) for i in range(max(len(words) - size + 1, 1)))


def plain(rows, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and find(i) != find(j):
            root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc is not None and doc == component))
    return sorted(out, key=str)


def result(df, **options):
    return sorted(map(tuple, minhash.near_duplicates(df, **options).collect()), key=str)


def test_documents(documents, rows):
    assert result(documents) == plain([r[:2] for r in rows])


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("chunk", [1 << 16, 900])
def test_clouds(spark, monkeypatch, chunk):
    """Texts around a few centres at all similarities, so that stars leave links between their members."""
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", chunk)
    rng = random.Random(4)
    rows = []
    for _ in range(4):
        base = prose(rng, 120).split()
        for _ in range(60):
            rows.append(changed(rng, base, rng.randint(0, 6)))
    for _ in range(30):  # chains: each differs a little from the one before
        text = prose(rng, 60).split()
        for _ in range(5):
            rows.append(" ".join(text))
            text[rng.randrange(len(text))] = "step"
    rows += [rows[0]] * 40
    rows = [(i + 10, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df) == plain(rows)


@pytest.mark.parametrize("chunk", [1 << 16, 250])
def test_links_between_members_that_the_centre_lacks(spark, monkeypatch, chunk):
    """Buckets of all nodes: the centre is linked with none of them, and they are linked in two groups."""
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", chunk)
    rng = np.random.default_rng(9)
    values = rng.integers(0, 1 << 63, 1500, np.uint64) * np.uint64(2)
    sets = {0: range(1000, 1100), **{i: range(i, i + 100) for i in (1, 3, 5, 7)}, **{i: range(i, i + 100) for i in (200, 203, 206)}}
    sets = {node: np.unique(values[list(s)]) for node, s in sets.items()}
    # Their real bands, and one that no pair shares first: a bucket by decree.
    rows = [(band, int(h), node, 100) for node, s in sets.items() for band, h in enumerate(bands(s))]
    rows += [(0, 7, node, 100) for node in sets]
    members = spark.createDataFrame(rows, "band int, h long, node long, n long")
    table = spark.createDataFrame([(node, s.view(np.int64).tolist()) for node, s in sets.items()], "node long, shingles array<long>")
    found = {r.node: r.root for r in minhash.link(members, table).collect()}
    assert found == {3: 1, 5: 1, 7: 1, 203: 200, 206: 200}


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    for common, extra in ((8, 1), (80, 10), (800, 100)):
        agree = []
        for _ in range(300):
            values = rng.integers(0, 1 << 63, common + 2 * extra, np.uint64) * np.uint64(2)
            a, b = np.unique(values[:common + extra]), np.unique(np.append(values[:common], values[common + extra:]))
            agree.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(agree) - common / (common + 2 * extra)) < 0.03


def bands(values):
    return minhash.hashes_of_bands(minhash.signature(values))


def test_recall_of_bands_at_the_threshold():
    rng = np.random.default_rng(2)
    missed = 0
    for size in (5, 10, 40, 300):
        for _ in range(300):
            values = rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2)
            a, b = np.unique(values), np.unique(values[:size * 4 // 5])
            missed += not (bands(a) == bands(b)).any()
    assert missed == 0


def test_empty(nothing):
    assert minhash.near_duplicates(nothing).count() == 0
