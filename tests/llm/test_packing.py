"""Pieces and their places."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lexiloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, capacity):
    """No overlap, no gap, nothing too long. The number of sequences."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_documents(documents, rows, nothing):
    library = Tokenizer.from_file(PATH)
    found = packing.pack_documents(documents, PATH, 64, 2, block=40).collect()
    check(found, 64)
    whole = sorted(library.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows)
    got, pieces = [], defaultdict(list)
    for r in sorted(found, key=lambda r: (str(r.doc_id), r.piece)):
        pieces[r.doc_id].append(r)
        assert r.length == len(r.ids) and (r.length == 64 or r.piece == 0) and r.start == 0 if r.piece == 0 else r.start > 0
    for r in found:
        if r.piece == 0:
            got.append(r)
    assert len(got) == len(rows) and sum(r.length for r in found) == sum(map(len, whole))
    once = {i: sorted(p, key=lambda r: r.piece) for i, p in pieces.items() if [r.piece for r in p].count(0) == 1}
    texts = {r[0]: r[1] for r in rows}
    for i, parts in once.items():
        assert sum((p.ids for p in parts), []) == library.encode(texts[i] or "", add_special_tokens=False).ids + [2]
    assert packing.pack_documents(nothing, PATH).count() == 0


def test_few_sequences(spark):
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 1024), rng.randint(1, 200), 1024]) for _ in range(6000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    packed = packing.pack(items, 1024, block=500).join(items, "row").collect()
    assert len(packed) == 6000 and check(packed, 1024) <= -(-sum(lengths) // 1024) * 1.005 + 1


def test_evolution_by_default_does_its_work(spark):
    """Lengths that best fit packs badly: enough generations save more sequences than a handful."""
    lengths = np.random.default_rng(2).integers(250, 500, 2048).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")

    def sequences(**how):
        packed = packing.pack(items, 1024, **how).join(items, "row").collect()
        assert len(packed) == len(lengths)
        return check(packed, 1024)

    assert sequences() < sequences(islands=2, epochs=2, generations=4, size=4)


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 1025, 400)
    parents = [packing.seed(lengths, 1024, rng, n) for n in (0.0, 0.5)]
    for _ in range(20):
        child = packing.crossover(*parents, lengths, 1024, rng)
        assert len(child) == 400 and child.min() == 0 and np.bincount(child, lengths).max() <= 1024
        assert set(child) == set(range(child.max() + 1))
        parents = [parents[1], child]
    best = packing.evolve(lengths, parents, 1024, 10, 4, rng)[0]
    assert packing.fitness(best, lengths, 1024) >= max(packing.fitness(p, lengths, 1024) for p in parents)


def test_cuts():
    assert packing.cuts(5, 10) == [(0, 5)] and packing.cuts(10, 10) == [(0, 10)] and packing.cuts(25, 10) == [(0, 5), (5, 10), (15, 10)]


def test_best_fit_and_numbering_equal_a_plain_search():
    rng = np.random.default_rng(5)
    for capacity, n in ((10, 0), (10, 1), (10, 60), (1024, 300)):
        lengths = rng.integers(1, capacity + 1, n)
        order, fills, want_fills = rng.permutation(n)[:n - n // 5], [capacity // 2, capacity, 0], [capacity // 2, capacity, 0]
        assigned, want = np.full(n, -1), np.full(n, -1)
        packing.best_fit(order, lengths, assigned, fills, capacity)
        for i in order:
            fits = [(capacity - f, b) for b, f in enumerate(want_fills) if 0 < f and f + lengths[i] <= capacity]
            b = min(fits)[1] if fits else len(want_fills)
            want_fills += [] if fits else [0]
            want_fills[b] += int(lengths[i])
            want[i] = b
        assert assigned.tolist() == want.tolist() and fills == want_fills
        bins = rng.integers(0, 90, n)
        assert packing.compact(bins).tolist() == np.searchsorted(np.unique(bins), bins).tolist()
