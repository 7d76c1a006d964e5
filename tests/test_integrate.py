import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexiloom import Settings
from lexiloom.operators import integrate, profile, rarity
from lexiloom.plans import jobs
from lexiloom.session import settle

S = Settings()
ENT = "array<struct<type:string,filler:string>>"


def table(spark, rows, offset=0):
    """Rows (sentence, intent, types) in list order, spread over many partitions."""
    data = [(i // 50, i % 50, s, intent, [(t, "f") for t in types]) for i, (s, intent, types) in enumerate(rows, offset)]
    df = spark.createDataFrame(data, f"block int, row int, sentence string, intent string, entities {ENT}")
    return df.repartition(6, "row").selectExpr("struct(block, row) AS seq", "sentence", "intent", "entities")


def made_up(n, seed):
    """Intents and sentences with one value holding more than a third of the rows."""
    rng = random.Random(seed)
    intents = ["hot"] * 6 + ["warm"] * 3 + ["mild", "cool", "cold"]
    return [(rng.choice(["Copy ", "copy", f"s{rng.randrange(n)}", " ", f"t{rng.randrange(n)}"]),
             rng.choice(intents), rng.sample(["a", "b", "c", "d"], rng.randrange(3)) + (["rare"] if rng.random() < 0.01 else []))
            for _ in range(n)]


def names(df):
    return Counter((r["sentence"], r["intent"]) for r in df.collect())


def brute_balanced(original, augmented, targets=None):
    counts = Counter(i for _, i, _ in original)
    by = defaultdict(list)
    for row in augmented:
        by[row[1]].append(row)
    if targets is None:
        top = max(counts.values())
        targets = {i: top - n if n < top * 0.5 else 0 for i, n in counts.items()}
    return [row for i, t in targets.items() for row in by[i][:t]]


def test_first_n_per_group_is_exact_on_hot_groups(spark):
    rows = made_up(900, 1)
    df = table(spark, rows)
    for target in (1, 49, 50, 51, 123, 10 ** 6):
        wanted = settle(spark.createDataFrame([("hot", target), ("cool", target), ("nobody", target)], "intent string, target bigint"))
        got = names(integrate.first_n_per_group(df, "intent", wanted))
        want = brute_balanced(rows, rows, {"hot": target, "cool": target})
        assert got == Counter((s, i) for s, i, _ in want)


def test_balanced_and_selective_against_plain_python(spark):
    original, augmented = made_up(700, 2), made_up(1500, 3) + [("new", "unseen", ["rare"]), ("odd", "unseen", ["never"])]
    counts = settle(profile.label_counts(table(spark, original)))
    extra = settle(table(spark, augmented))
    got = names(integrate.balance(counts, extra, replace(S, strategy="balanced")))
    assert got == Counter((s, i) for s, i, _ in brute_balanced(original, augmented))

    limit = len(original) * 0.05
    rare_i = {i for i, n in Counter(i for _, i, _ in original).items() if n < limit}
    rare_t = {t for t, n in Counter(t for _, _, ts in original for t in ts).items() if n < limit}
    want = [r for r in augmented if r[1] in rare_i or set(r[2]) & rare_t]
    selective = integrate.balance(counts, extra, replace(S, strategy="selective"))
    assert names(selective) == Counter((s, i) for s, i, _ in want)
    assert ("odd", "unseen") not in names(selective) and ("new", "unseen") in names(selective)


def test_labels_are_tested_row_by_row(spark):
    """Rows that share ``seq``, lists of any length, any partitioning."""
    rows = [(s, i, t) for s, i, t in made_up(400, 4)]
    df = table(spark, rows).withColumn("seq", F.expr("named_struct('block', 0, 'row', 0)"))
    for n in (1, 1500):
        labels = spark.createDataFrame([("rare",)] + [(f"l{k}",) for k in range(n)], "label string")
        intents = spark.createDataFrame([("cold",)] + [(f"l{k}",) for k in range(n)], "label string")
        want = Counter((s, i) for s, i, ts in rows if i == "cold" or "rare" in ts)
        for parts in (1, 7):
            assert names(rarity.with_any_label(df.repartition(parts), intents, labels, "unknown")) == want
        assert names(rarity.with_any_label(df, None, labels, "unknown")) == Counter((s, i) for s, i, ts in rows if "rare" in ts)
    assert rarity.with_any_label(df, None, None, "unknown").count() == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_balanced_merge_keeps_the_copy_of_the_first_intent(spark, seed):
    """Sentences under several intents: the order of the intents in the original set decides."""
    rng = random.Random(seed)
    original = [(f"o{k}", rng.choice(["hot"] * 8 + ["b", "a", "c"]), []) for k in range(300)]
    augmented = [(f"dup{rng.randrange(25)}", rng.choice("abc"), []) for _ in range(200)]
    for wanted in (None, {"c": 20, "a": 30, "b": 10}):
        result = jobs.merge_augmented(table(spark, original), settle(table(spark, augmented)), S, wanted)
        targets = None
        if wanted is None:
            first = list(dict.fromkeys(i for _, i, _ in original))
            counts = Counter(i for _, i, _ in original)
            top = max(counts.values())
            targets = {i: top - counts[i] if counts[i] < top * 0.5 else 0 for i in first}
        kept = {}
        for s, i, _ in original + brute_balanced(original, augmented, targets or wanted):
            kept.setdefault(s, (s, i))
        assert names(result.final) == Counter(kept.values())


def test_merge_deduplicate_and_summary(spark):
    original, augmented = made_up(500, 5), made_up(800, 6)
    for strategy in integrate.STRATEGIES:
        result = jobs.merge_augmented(table(spark, original), settle(table(spark, augmented)), replace(S, strategy=strategy))
        if strategy == "all":
            seen, want = set(), []
            for tag, rows in (("original", original), ("augmentation", augmented)):
                for s, i, _ in rows:
                    if s.strip() and s.strip().lower() not in seen:
                        seen.add(s.strip().lower())
                        want.append((s, i, tag))
            got = [(r["sentence"], r["intent"], r["metadata"]["source"]) for r in result.final.orderBy("seq").collect()]
            assert got == want
        row = result.summary.first()
        assert row["original_samples"] == 500 and row["augmented_samples"] == 800
        assert row["final_samples"] == result.final.count()
        assert row["duplicates_removed"] == 500 + row["selected_augmented"] - row["final_samples"]
        again = integrate.deduplicate(result.final)
        assert names(again) == names(result.final)


def test_hot_copies_are_dropped_before_the_shuffle(spark):
    plan = integrate.deduplicate(table(spark, made_up(50, 7)))._jdf.queryExecution().executedPlan().toString()
    after_last_exchange = plan.split("Exchange hashpartitioning(_key")[1]
    assert "WindowGroupLimit" in after_last_exchange and "Partial" in after_last_exchange


def test_tags(spark):
    first = table(spark, [("a", "i", [])])
    second = table(spark, [("b", "i", [])]).withColumn("metadata", F.expr("named_struct('source', 'hand', 'augmented', true)"))
    rows = {r["sentence"]: r for r in integrate.merge(first, second, S).collect()}
    assert rows["a"]["metadata"]["source"] == "original" and rows["b"]["metadata"]["source"] == "hand"
    assert "metadata" not in integrate.merge(first, first, replace(S, add_metadata=False)).columns
    assert integrate.merge(first, second, replace(S, preserve_original=False)).count() == 1


def test_empty_original_and_unknown_strategy(spark):
    nothing, some = table(spark, []), settle(table(spark, [("a", "i", ["t"])]))
    assert jobs.merge_augmented(nothing, some, S).final.count() == 0
    assert jobs.merge_augmented(nothing, some, replace(S, strategy="all")).final.count() == 1
    with pytest.raises(ValueError, match="Unknown strategy: odd"):
        jobs.merge_augmented(nothing, some, replace(S, strategy="odd"))
