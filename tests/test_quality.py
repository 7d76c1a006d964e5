from dataclasses import replace

from pyspark.sql import functions as F

from lexiloom import Settings
from lexiloom.operators import quality
from lexiloom.plans import jobs

S = Settings()
ENT = "array<struct<type:string,filler:string>>"


def pairs(spark, rows):
    schema = (f"original_sentence string, augmented_sentence string, original_entities {ENT}, augmented_entities {ENT}, "
              "original_intent string, augmented_intent string")
    return spark.createDataFrame(rows, schema)


def test_each_check_and_message(spark):
    d = [("device", "đèn")]
    rows = [
        ("bật đèn", "mở đèn", d, d, "i", "i"),
        ("bật đèn", "", d, d, "i", "i"),
        ("bật đèn to quá rồi", "bật đèn", d, d, "i", "i"),
        ("đèn", "đèn đỏ và xanh", d, d, "i", "i"),
        ("bat den", "mo den", [], [], "i", "i"),
        ("bật đèn", "bật đèn", d, [], "i", "i"),
        ("bật đèn", "bật đèn", d, [("room", "đèn")], "i", "i"),
        ("bật đèn", "bật đèn", d, [("device", "")], "i", "i"),
        ("bật đèn", "bật quạt", d, d, "i", "i"),
        ("bật đèn", "bật bật đèn", d, d, "i", "i"),
        ("của của", "của của", [], [], "i", "i"),
        ("bật đèn", "bật  đèn", d, d, "i", "i"),
        ("bật đèn", "bật đèn .", d, d, "i", "i"),
        ("bật đèn", "bật đèn", d, d, "i", "j"),
    ]
    got = [r["issues"] for r in quality.validate_pairs(pairs(spark, rows), S).collect()]
    assert got == [
        [],
        ["length_ratio: Empty text", "vietnamese_chars: No Vietnamese characters found",
         "entity_boundaries: Entity 'đèn' not found in sentence"],
        ["length_ratio: Too short (ratio: 0.39)"],
        ["length_ratio: Too long (ratio: 4.67)"],
        ["vietnamese_chars: No Vietnamese characters found"],
        ["entity_preservation: Entity count mismatch: 1 vs 0"],
        ["entity_preservation: Entity types don't match"],
        ["entity_preservation: Entity 0 missing filler"],
        ["entity_boundaries: Entity 'đèn' not found in sentence"],
        ["basic_grammar: Repeated word: 'bật'"],
        [],
        ["basic_grammar: Multiple spaces detected"],
        ["basic_grammar: Orphaned punctuation"],
        ["intent_consistency: Intent changed: 'i' -> 'j'"],
    ]


def test_custom_pair_check(spark):
    d = [("device", "đèn")]
    df = pairs(spark, [("bật đèn", "mở đèn", d, d, "i", "i")])
    own = {"no_open": lambda: F.when(F.contains("augmented_sentence", F.lit("mở")), "Opens something")}
    row = quality.validate_pairs(df, S, own).first()
    assert row["issues"] == ["no_open: Opens something"] and not row["valid"] and not row["checks"]["no_open"]


def test_dataset_quality_and_report(spark):
    d = [("device", "đèn")]
    rows = [("bật đèn", "mở đèn", d, d, "i", "i"), ("bật đèn", "mo den", d, d, "i", "i"), ("bật đèn", "đi", d, d, "i", "j")]
    checked = quality.validate_pairs(pairs(spark, rows), S)
    summary = quality.quality_summary(checked, "augmented_sentence", pairs=True).first()
    assert (summary["total_samples"], summary["passed_all_checks"], summary["samples_with_vietnamese"]) == (3, 1, 2)
    failed = {r["check"]: r["n"] for r in quality.failed_check_counts(checked).collect()}
    assert failed == {"vietnamese_chars": 1, "entity_boundaries": 2, "length_ratio": 1, "intent_consistency": 1}
    counts = spark.createDataFrame([("intent", "i", 2), ("intent", "j", 1), ("entity_type", "device", 3)],
                                   "dimension string, label string, n bigint")
    text = jobs.render_quality_report(jobs.quality_report(checked, counts, "augmented_sentence", pairs=True))
    assert "passed_all_checks: 1 (33.3%)" in text and "entity_boundaries: 2" in text and "device: 3" in text


def test_empty_dataset_rates(spark):
    checked = quality.validate_pairs(pairs(spark, []), S)
    row = quality.quality_summary(checked, "augmented_sentence", pairs=True).first()
    assert row["total_samples"] == 0 and row["quality_rate"] == 0 and row["avg_length_ratio"] == 0


def test_coherence(spark):
    texts = ["a a a b", "a a b b", "a b a b a", "a a a", "A a b", " ".join("abcdefghijklmnopqrst"), " ".join("abcdefghijklmnopqrstu"), "a A a B c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(quality.coherent(F.split(F.lower("t"), " ")).alias("ok")).collect()

    def brute(t):
        w = t.lower().split()
        return len(w) <= 20 and not (len(w) > 3 and max(w.count(x) for x in w) > len(w) // 2)
    assert [r["ok"] for r in got] == [brute(t) for t in texts]


def test_gate_switches(spark):
    checks = replace(S, require_vietnamese_characters=False, check_entity_preservation=False)
    args = [F.lit("xx zz"), F.lit("xx zz qq"), F.array().cast(ENT), F.array(F.struct(F.lit("t").alias("type"), F.lit("f").alias("filler"))),
            F.lit(2), F.lit(3), F.array(F.lit("xx"), F.lit("zz"), F.lit("qq"))]
    one = spark.range(1).select(quality.first_failed_rule(*args, S).alias("a"), quality.first_failed_rule(*args, checks).alias("b")).first()
    assert (one["a"], one["b"]) == ("entity_count", None)
