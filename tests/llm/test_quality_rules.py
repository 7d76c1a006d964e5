"""Statistics, trees and verdicts."""

import re
from collections import Counter

import numpy as np

from lexiloom.llm import quality_rules, trees


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if twice[w] > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x in lines[:i] and re.search(r"[^\x20\x09-\x0D]", x))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_base_counts_and_verdicts(documents, rows):
    judged = quality_rules.judge(documents, None)
    assert judged.columns == [c for c in documents.columns if c not in quality_rules.ADDED] + list(quality_rules.ADDED)
    got = Counter((r.doc_id, *(r[c] for c in quality_rules.BASE), r.base_failed, r.kept) for r in judged.collect())
    want = Counter()
    for r in rows:
        b = base(r[1])
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want[(r[0], *b, failed, not failed)] += 1
    assert got == want
    assert Counter(r.text for r in judged.select("text").collect()) == Counter(r[1] for r in rows)


def test_windows_of_very_many_words():
    ids = np.arange(3_000_000)
    ids[-5:] = [0, 1, 2, 3, 7]
    assert quality_rules.repeat_words(ids, 3_000_000) == 8


def test_trees_learn_and_stay_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * x[:, 1] + 0.2 * rng.standard_normal(3000)) > 0.7).astype(float)
    forest = trees.fit(x[:2000], y[:2000], np.array([1, 0, -1]))
    best = ((x[2000:, 0] + 0.3 * x[2000:, 1] > 0.7) == y[2000:]).mean()  # what the noise leaves to the true rule
    assert ((forest.probability(x[2000:]) > 0.5) == y[2000:]).mean() > best - 0.03
    for column, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rng.random((200, 3)), 50, axis=0)
        grid[:, column] = np.tile(np.linspace(-0.5, 1.5, 50), 200)
        steps = np.diff(forest.probability(grid).reshape(200, 50), axis=1) * sign
        assert (steps >= -1e-12).all()
    assert trees.fit(x, np.ones(3000), np.zeros(3)) is None and trees.fit(x[:0], y[:0], np.zeros(3)) is None


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    forest = quality_rules.train(documents, labels.where("doc_id % 3 > 0"))
    judged = quality_rules.judge(documents, forest).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed")
    rows = judged.select("kept", "quality").collect()
    assert len(rows) > 50 and np.mean([r.kept == bool(r.quality) for r in rows]) > 0.95


def test_nothing(spark, nothing, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.train(nothing, labels) is None and quality_rules.train(documents, labels) is None
    assert quality_rules.judge(nothing, None).count() == 0
    odd = spark.createDataFrame([(6, 1), (6, 0), (None, 1), (7, None), (6, 1)], "doc_id long, quality int")
    assert [tuple(r) for r in quality_rules.labelled_sample(documents, odd, 10).select("quality").distinct().collect()] == [(0,)]
