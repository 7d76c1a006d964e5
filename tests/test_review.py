import itertools
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexiloom import Settings
from lexiloom.functions.entities import parse_entities, repair_json
from lexiloom.operators import review
from lexiloom.plans import jobs
from lexiloom.schema import REVIEW_COLUMNS

S = Settings()
SCORES = [None, "", "3", " 4 ", "2.9", "abc", "NaN", "inf", "-1", "4d", "1e1"]
WORDS = [None, "", "yes", " YES ", "no", "No ", "maybe"]


def reviews(spark, rows):
    base = dict.fromkeys(REVIEW_COLUMNS)
    data = [tuple({**base, "Sample_ID": str(i), **r}[c] for c in REVIEW_COLUMNS) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in REVIEW_COLUMNS))


def number(text):
    try:
        value = float(text)
        return None if math.isnan(value) else value
    except (TypeError, ValueError):
        return None


def test_approval_truth_table(spark):
    cases = list(itertools.product(SCORES, SCORES, WORDS))
    df = reviews(spark, [{"Quality_Score_1_5": a, "Naturalness_Score_1_5": b, "Approved_Yes_No": w} for a, b, w in cases])
    got = {r["Sample_ID"]: r for r in review.with_decision(df, S).collect()}
    for i, (a, b, w) in enumerate(cases, 1):
        said = (w or "").strip().lower()
        ok = all(n is not None and n >= 3 for n in (number(a), number(b)))
        want = said == "yes" or (ok and said != "no")
        assert got[str(i)]["approved"] == want and got[str(i)]["rejected"] == (not want), (a, b, w)
    row = review.review_analysis(df, S).first()
    assert row["approved_count"] + row["rejected_count"] == row["total_samples"] == len(cases)


def test_minimum_scores(spark):
    df = reviews(spark, [{"Quality_Score_1_5": a, "Naturalness_Score_1_5": "5"} for a in SCORES])
    kept = [r["Quality_Score_1_5"] for r in review.filter_by_scores(df).collect()]
    assert kept == ["3", " 4 ", "inf", "1e1"]
    assert review.filter_by_scores(df, 0, 0).count() == 7


def test_final_samples_and_entity_text(spark):
    good = '[{"type": "t", "filler": "đèn"}]'
    texts = {good: [("t", "đèn")], None: [], " ": [], "null": [], '{"type": "t"}': [], "5": [], '[{"type"': "dropped", "[{type: t}]": "dropped", "[]": []}
    df = reviews(spark, [{"Original_Entities": good, "Augmented_Entities": t, "Augmented_Sentence": "s", "Quality_Score_1_5": "4.7",
                          "Naturalness_Score_1_5": "3", "Approved_Yes_No": "yes" if i % 2 else ""} for i, t in enumerate(texts)])
    got = {r["sample_id"]: r for r in review.final_samples(df, S).collect()}
    for i, want in enumerate(texts.values(), 1):
        if want == "dropped":
            assert i not in got
        else:
            assert [(e["type"], e["filler"]) for e in got[i]["augmented_entities"]] == want
            assert got[i]["quality_score"] == 4 and got[i]["approved"] == (i % 2 == 0)
    strategies = {s: review.final_samples(df, S, s).count() for s in review.REVIEW_STRATEGIES}
    assert strategies == {"balanced": 7, "all_approved": 3, "score_only": 7}
    with pytest.raises(ValueError, match="Unknown strategy: odd"):
        review.final_samples(df, S, "odd")


def test_parse_is_three_way(spark):
    one = spark.range(1).select(parse_entities(F.lit('{"type": "a"')).alias("p")).first()["p"]
    assert not one["ok"] and one["entities"] == []


def test_repair(spark):
    cases = {
        None: "[]", "  ": "[]",
        '[{"type": "a", "filler": "b: c, d: e"}]': '[{"type": "a", "filler": "b: c, d: e"}]',
        "[{type: device, filler: đèn bàn}]": '[{"type": "device", "filler": "đèn bàn"}]',
        '"[{type: a}]"': '[{"type": "a"}]',
        "[{n: 5, f: -1.5, b: true, z: null, t: 8:30}]": '[{"n": 5, "f": -1.5, "b": true, "z": null, "t": "8:30"}]',
        "[ {a: x} {b: 2} ]": '[{"a": "x"},{"b": 2} ]',
        "[{a: x}, {b: ": "[]", "hello": "[]", "[type: device]": "[]",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = [r["r"] for r in df.select(repair_json(F.col("t")).alias("r")).collect()]
    assert got == list(cases.values())
    fixed = review.repair_entities(reviews(spark, [{"Original_Entities": "[]", "Augmented_Entities": "[{a: b}]"}])).first()
    assert fixed["repaired"] == 1 and fixed["Augmented_Entities"] == '[{"a": "b"}]'


def test_decisions_last_write_wins(spark):
    df = reviews(spark, [{"Quality_Score_1_5": "1", "Approved_Yes_No": "no"}, {"Quality_Score_1_5": "2"}])
    writes = [("1", "Quality_Score_1_5", "3", 1), ("1", "Quality_Score_1_5", "5", 3), ("1", "Quality_Score_1_5", "4", 2),
              ("1", "Approved_Yes_No", "yes", 1), ("9", "Approved_Yes_No", "yes", 1), ("2", "Comments", "x", 1)]
    decisions = spark.createDataFrame(writes, "Sample_ID string, field string, value string, at int")
    got = {r["Sample_ID"]: r for r in review.apply_decisions(df, decisions).collect()}
    assert got["1"]["Quality_Score_1_5"] == "5" and got["1"]["Approved_Yes_No"] == "yes"
    assert got["2"]["Quality_Score_1_5"] == "2" and got["2"]["Comments"] is None
    assert len(got) == 2


def test_filter_progress_auto_approve(spark):
    df = reviews(spark, [
        {"Augmentation_Method": "m", "Approved_Yes_No": "YES", "Original_Sentence": "Bật Đèn", "Augmented_Sentence": "x"},
        {"Augmentation_Method": "m", "Approved_Yes_No": "no", "Original_Sentence": "y", "Augmented_Sentence": "mở đèn"},
        {"Augmentation_Method": "k", "Approved_Yes_No": "", "Quality_Score_1_5": "4", "Naturalness_Score_1_5": "4.5"},
    ])
    ids = lambda d: [r["Sample_ID"] for r in d.collect()]
    assert ids(review.filter_review(df, term="ĐÈN")) == ["1", "2"]
    assert ids(review.filter_review(df, wanted="pending")) == ["3"]
    assert ids(review.filter_review(df, method="m", wanted="approved")) == ["1"]
    total = [r for r in review.review_progress(df).collect() if r["is_total"]][0]
    assert (total["total"], total["approved"], total["rejected"], total["pending"]) == (3, 1, 1, 1)
    said = [r["Approved_Yes_No"] for r in review.auto_approve(df, S).collect()]
    assert said == ["YES", "no", "yes"]
    assert [r["Approved_Yes_No"] for r in review.auto_approve(df, replace(S, auto_approve_at=4.5)).collect()][2] == ""


def test_nothing_approved(spark):
    assert jobs.integrate_review(reviews(spark, [{"Approved_Yes_No": None}]), S) is None


def test_report(spark):
    df = reviews(spark, [{"Approved_Yes_No": "yes"}, {"Approved_Yes_No": "yes", "Augmented_Entities": "[{"},
                         {"Approved_Yes_No": "no", "Quality_Score_1_5": "5", "Naturalness_Score_1_5": "5"}])
    row = jobs.integrate_review(df, S).report.first()
    assert list(row)[:6] == [3, 1, 1, 2, 1, 1]
