from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexiloom import Settings, default_vocabulary
from lexiloom.operators import augment
from lexiloom.operators.augment import METHODS

S = Settings()


def rewritten(df, method, settings=S):
    return {r["sample_id"]: (r["augmented_sentence"], [(e["type"], e["filler"]) for e in r["augmented_entities"]])
            for r in augment.rewrite(df, method, settings).collect()}


def test_restructure_moves_time_then_place(utterances):
    got = rewritten(utterances, "sentence_restructuring")
    assert got["2"][0] == "lúc 9, mở cửa "
    assert got["3"][0] == "trong phòng, giảm loa "
    assert got["4"][0] == "dừng"
    kept = rewritten(utterances, "sentence_restructuring", replace(S, keep_tail=True))
    assert kept["2"][0] == "lúc 9, mở cửa giờ tối"


def test_restructure_line_by_line(spark):
    rows = [("a\nb lúc 5,c", "lúc 5, b,"), ("lúc 5", "lúc 5, "), ("x lúc  5", "x lúc  5"), ("x lúc ,", "x lúc ,"),
            ("a tại b\n", "tại b, a\n"), ("ở đó\nlúc 3 nhé", "lúc 3, \t".rstrip("\t") + " ")]
    df = spark.createDataFrame([(str(i), s, "i", []) for i, (s, _) in enumerate(rows)],
                               "sample_id string, sentence string, intent string, entities array<struct<type:string,filler:string>>")
    got = rewritten(df, "sentence_restructuring")
    assert [got[str(i)][0] for i in range(len(rows))] == [w for _, w in rows]


def test_action_word_is_replaced_once(utterances):
    got = rewritten(utterances, "synonym_replacement")
    assert got["1"][0].removesuffix(" đèn phòng khách") in default_vocabulary().actions["bật"]
    assert got["8"][0].removesuffix(" quạt") in default_vocabulary().actions["bật"]
    assert got["4"][0] == "dừng" and got["6"][0] == ""


def test_entity_synonyms_need_to_be_present_by_default(spark):
    rows = [("1", "xem TV ở đài", "i", [("device", "ti vi"), ("device", "radio")]),
            ("2", "bật tivi và ti vi", "i", [("device", "ti vi")]),
            ("3", "vào buồng ngủ", "i", [("Living_Space", " buồng ngủ ")])]
    df = spark.createDataFrame(rows, "sample_id string, sentence string, intent string, entities array<struct<type:string,filler:string>>")
    got = rewritten(df, "synonym_replacement")
    # "ti vi" maps back to "tivi"; in row 1 that word is absent
    assert got["1"][1][0] == ("device", "ti vi")
    assert got["2"][1] == [("device", "tivi")] and got["2"][0].endswith("tivi và tivi")
    assert got["3"] == ("vào buồng ngủ", [("Living_Space", " buồng ngủ ")])
    free = rewritten(df, "synonym_replacement", replace(S, require_present=False))
    assert free["3"] == ("vào phòng ngủ", [("Living_Space", "phòng ngủ")])


def test_time_is_varied_twice(utterances):
    options = default_vocabulary().times["tối"]
    sentence, entities = rewritten(utterances, "time_variation")["2"]
    first = entities[1][1]
    assert first in options
    # the entity first, then the same word again in the sentence
    assert sentence in {("mở cửa lúc " + first).replace("tối", o, 1) for o in options}


def test_politeness_frequencies_and_determinism(spark):
    n = 20000
    df = spark.range(n).selectExpr("CAST(id AS STRING) AS sample_id", "'bật đèn' AS sentence", "'i' AS intent",
                                   "CAST(array() AS array<struct<type:string,filler:string>>) AS entities")
    one = rewritten(df.repartition(3), "politeness_addition")
    assert one == rewritten(df.repartition(7, "sample_id"), "politeness_addition")
    texts = [t for t, _ in one.values()]
    prefixed = sum(not t.startswith("bật") for t in texts) / n
    suffixed = sum(not t.endswith("đèn") for t in texts) / n
    assert abs(prefixed - 0.4) < 0.02 and abs(suffixed - 0.6) < 0.02
    assert one != rewritten(df, "politeness_addition", replace(S, seed=1))
    assert len(set(texts)) == 7 * 8


def gate(sentence, variant, before, after, s=S):
    """The gate in plain Python."""
    if not variant.strip() or variant == sentence:
        return False
    n, m = len(sentence.split()), len(variant.split())
    if not s.min_length_ratio <= m / n <= s.max_length_ratio:
        return False
    if sorted(t for t, _ in before) != sorted(t for t, _ in after):
        return False
    low = variant.lower().split()
    return not (len(low) > 20 or len(low) > 3 and max(low.count(w) for w in low) > len(low) // 2)


def test_candidates_against_plain_python(utterances):
    every = replace(S, max_variations=4)
    found = augment.candidates(utterances, every).collect()
    assert len(found) == 8 * 4
    for r in found:
        if not r["original_sentence"].strip():
            assert r["error"] == "division by zero" and not r["quality_passed"]
            continue
        before = [(e["type"], e["filler"]) for e in r["original_entities"]]
        after = [(e["type"], e["filler"]) for e in r["augmented_entities"]]
        assert r["quality_passed"] == gate(r["original_sentence"], r["augmented_sentence"], before, after), r
        assert r["metadata"]["augmented_length"] == len(r["augmented_sentence"].split())
        assert r["metadata"]["length_ratio"] == len(r["augmented_sentence"].split()) / len(r["original_sentence"].split())
    issues = augment.rejected(augment.candidates(utterances, every))
    blank = [r for r in issues.collect() if r["error"]]
    assert len(blank) == 4 and all(r["augmented_sentence"] is None and r["reason"] is None for r in blank)


def test_variation_limit_and_unknown_method(utterances):
    assert augment.candidates(utterances, S).select("method").distinct().count() == 3
    assert augment.candidates(utterances, S, num_variations=9).select("method").distinct().count() == 4
    with pytest.raises(ValueError, match="Unknown augmentation method: nope"):
        augment.candidates(utterances, replace(S, methods=("nope",)))


def test_custom_method_and_check(utterances):
    own = {"twice": lambda sentence, entities, sample, settings: F.struct(
        F.concat(sentence, F.lit(" "), sentence).alias("sentence"), entities.alias("entities"))}
    settings = replace(S, methods=("twice",))
    checks = {"no_comma": lambda original, augmented, entities: ~F.contains(augmented, F.lit(","))}
    got = {r["sample_id"]: r["failed_rule"] for r in augment.candidates(
        utterances, settings, extra_methods=own, extra_checks=checks).collect()}
    assert got["1"] is None and got["5"] == "no_comma"


def test_plan_is_one_narrow_stage(utterances):
    plan = augment.accepted(augment.candidates(utterances, S))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("Generate posexplode") == 1


def test_rewriting_runs_on_a_stream(spark, tmp_path, utterances):
    source = str(tmp_path / "in")
    utterances.drop("seq").write.parquet(source)
    stream = spark.readStream.schema(utterances.drop("seq").schema).parquet(source)
    running = augment.accepted(augment.candidates(stream, S)).writeStream.format("memory").queryName("streamed") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    running.awaitTermination(120)
    assert spark.table("streamed").count() == augment.accepted(augment.candidates(utterances, S)).count()


def test_method_names():
    assert list(METHODS) == list(Settings().methods)


ODD = [
    (None, None), ("", []), (" the is\tde la", [("device", "the"), None, ("DEVICE", None)]),
    ("the THE this\nat ten, đèn", [("device_x", " Đèn "), (None, "đèn"), ("time_at", "sau ")]),
    ("bật bóng đèn trong phòng ngủ buồng ngủ", [("device", "đèn"), ("space", " buồng ngủ"), ("device", "bóng đèn")]),
    ("ÎİΣ ΟΔΟΣ BẬT sau", [("duration", "SAU"), ("living_space", "sân")]), ("tắt\x85mở\u3000sau trong\xa0x", [("delay", "xsaux")]),
]


def odd_utterances(spark):
    entities = "array<struct<type:string,filler:string>>"
    return spark.createDataFrame([(str(i), s, "x", e) for i, (s, e) in enumerate(ODD)],
                                 f"sample_id string, sentence string, intent string, entities {entities}").coalesce(1)


@pytest.mark.parametrize("settings", [S, replace(S, require_present=False), replace(
    S, vocabulary=replace(default_vocabulary(), actions={"bật": [], "the": ["$1 \\x"]}, times={"sau": [], "at": ["$1"]}))])
def test_compiled_tests_and_lambdas_agree(spark, utterances, monkeypatch, settings):
    """Look-ups compiled for few terms, and in lambdas on every row as for many terms."""
    settings = replace(settings, max_variations=4)
    for df in (utterances.drop("seq"), odd_utterances(spark)):
        compiled = augment.candidates(df, settings).collect()
        with monkeypatch.context() as m:
            m.setattr(augment, "MAX_COMPILED", 0)
            assert augment.candidates(df, settings).collect() == compiled


def test_entity_lambdas_are_left_to_rows_that_may_change(utterances):
    made = augment._made(utterances.withColumn("_key", F.col("sample_id")), {"s": augment.SYNONYMS, "t": augment.TIMES}, S)
    rows = {r["sample_id"]: r for r in made.collect()}
    assert [i for i in sorted(rows) if rows[i]["t_swap"] is not None] == ["2", "8"]
    assert rows["4"]["s_swap"] is None and rows["3"]["s_swap"] is None and rows["8"]["s_swap"] is not None


def test_words_split_at_every_blank_and_nowhere_else(spark):
    from lexiloom.functions.text import BLANKS, NO_BLANK, words
    chars = [chr(c) for c in (*range(0x3100), 0x180e, 0xfeff, 0x10400, 0x10ffff) if c]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = df.select("c", words(F.concat(F.lit("a "), "c", F.lit("b"))).alias("w"), F.col("c").rlike(f"[{NO_BLANK}]").alias("solid")).collect()
    assert all(r["w"] == (["a", "b"] if r["c"] in BLANKS else ["a", f"{r['c']}b"]) and r["solid"] == (r["c"] not in BLANKS) for r in got)
