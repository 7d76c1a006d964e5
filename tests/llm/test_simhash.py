"""Fingerprints, covering masks and components against plain Python."""

import random
import re
from itertools import combinations

import pytest
import xxhash

from lexiloom.llm import simhash
from lexiloom.llm.components import connected_components


def fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [words[i:i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius and find(i) != find(j):
            root[find(j)] = find(i)
    return [find(i) for i in range(len(values))]


def test_documents(documents, rows):
    prints = [fingerprint(r[1]) for r in rows]
    roots = components(prints, 3)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots)), key=str)
    found = simhash.near_duplicates(documents)
    got = found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("f"), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == want
    kept = simhash.one_of_each(documents)
    assert kept.columns == documents.columns and kept.count() == len(set(roots))


def rows_out(plan, name):
    """How many rows the nodes of a name have made in an executed plan."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [
        plan.children().apply(i) for i in range(plan.children().size())]
    made = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == name else 0
    return made + sum(rows_out(p, name) for p in inner)


def test_copies_are_not_counted(spark):
    """A counter has 32 bits, so it may count the shingles of one text, not those of all copies."""
    text = "na na na na Na na na"
    texts = spark.createDataFrame([(text,)] * 500 + [("one other text here",)] * 2 + [(" ",)], "text string").repartition(4)
    found = simhash.fingerprints(texts.select(simhash.text_key(texts["text"]).alias("key"), "text"))
    assert sorted(r.fp % (1 << 64) for r in found.collect()) == sorted([fingerprint(text), fingerprint("one other text here")])
    assert rows_out(found._jdf.queryExecution().executedPlan(), "Generate") == 5 + 2


@pytest.mark.parametrize("radius", [1, 3])
def test_every_pair_within_the_radius_shares_a_mask(radius):
    for masks in (simhash.covering_masks(list(range(64)), radius), simhash.covering_masks(list(range(5, 40)), radius)):
        rng = random.Random(radius)
        free = [b for b in range(64) if any(m >> b & 1 for m in masks)]
        for _ in range(2000):
            difference = sum(1 << b for b in rng.sample(free, radius))
            assert any(not m & difference for m in masks)


def test_crowded_buckets_are_split(spark):
    """A cloud of fingerprints around a few centres, with a limit that sends them through all levels."""
    rng = random.Random(5)
    values = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, bucket_limit=8)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    got = [roots.get(v, v) for v in signed]
    want = components(values, 3)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {501: 500}


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0


def test_hub_with_every_join_shuffled(spark):
    """One node with most of the edges, beside small components, where nothing is broadcast."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(100_000).selectExpr("500000L AS a", "id + 1 AS b").union(
            spark.range(300).selectExpr("600000L + id * 2 AS a", "600001L + id * 2 AS b"))
        roots = connected_components(edges).groupBy("root").count().collect()
        assert sorted((r["root"], r["count"]) for r in roots) == [(1, 100_000)] + [(600_000 + 2 * i, 1) for i in range(300)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
