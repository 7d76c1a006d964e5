from collections import Counter
from dataclasses import replace

from lexiloom import Settings
from lexiloom.config import vocabulary_from, vocabulary_table
from lexiloom.operators import profile, vocabulary
from lexiloom.operators.rarity import rare_samples
from lexiloom.session import settle
from lexiloom.sources import readers

S = replace(Settings(), min_intent_frequency=2, min_entity_frequency=2)


def test_rarity_profile_and_summary(utterances):
    rows = {(r["dimension"], r["label"]): (r["n"], r["rare"]) for r in profile.rarity_profile(utterances, S).collect()}
    assert rows[("intent", "bật")] == (3, False) and rows[("intent", "mở")] == (1, True)
    assert rows[("entity_type", "device")] == (6, False) and rows[("entity_type", "time_at")] == (1, True)
    row = profile.rarity_summary(profile.rarity_profile(utterances, S)).first()
    assert tuple(row) == (8, 6, 4, 5, 2)


def test_rare_samples(utterances):
    rarity = settle(profile.rarity_profile(utterances, S))
    ids = lambda s: sorted(r["sample_id"] for r in rare_samples(utterances, rarity, s).collect())
    assert ids(S) == ["2", "3", "4", "6", "7"]
    assert ids(replace(S, augment_rare_intents=False)) == ["2", "7"]
    assert ids(replace(S, augment_rare_entities=False)) == ["2", "3", "4", "6", "7"]
    assert ids(replace(S, augment_rare_entities=False, augment_rare_intents=False)) == []


def test_label_counts_name_missing_labels(spark):
    df = spark.createDataFrame([(None, [(None, "f"), ("", "g")])], "intent string, entities array<struct<type:string,filler:string>>")
    rows = Counter({(r["dimension"], r["label"], r["intent"]): r["n"] for r in profile.label_counts(df).collect()})
    assert rows == {("intent", "unknown", None): 1, ("entity_type", "unknown", None): 1, ("entity_type", "", None): 1,
                    ("entity_type_intent", "unknown", "unknown"): 1, ("entity_type_intent", "", "unknown"): 1}


def test_entity_statistics(utterances):
    values = settle(profile.entity_values(utterances))
    got = {r["metric"]: r["value"] for r in profile.entity_statistics(utterances, values).collect()}
    assert got == {"total_entities": 10, "samples_with_entities": 6, "samples_without_entities": 2,
                   "average_entities_per_sample": 1.25, "unique_entity_types": 4, "unique_entity_fillers": 8}
    assert [tuple(r) for r in profile.top_values(values, "filler", 2).collect()] == [("đèn", 2), ("5 phút", 1)]


def test_label_map(utterances):
    got = {r["label"]: r["id"] for r in profile.label_map(utterances).collect()}
    want = {"O": 0}
    for i, t in enumerate(sorted(["device", "living_space", "time_at", "delay_duration"]), 1):
        want |= {f"B-{t}": 2 * i - 1, f"I-{t}": 2 * i}
    assert got == want


def test_format_check(spark, tmp_path):
    path = tmp_path / "odd.jsonl"
    path.write_text("\n".join([
        '{"sentence": "a", "intent": "i", "entities": [{"type": "t", "filler": "f"}]}',
        '{"sentence": " ", "intent": "i", "entities": []}',
        '{"intent": "i", "entities": ["x", {"filler": "f"}, {"type": "t", "filler": " "}]}',
        '{"sentence": "b", "intent": "", "extra": 1}',
        'not json',
    ]), encoding="utf-8")
    raw = readers.read_raw(spark, str(path))
    got = {r["metric"]: r["value"] for r in profile.format_report(raw).collect()}
    assert got == {"total_samples": 4, "valid_samples": 1, "sentence_coverage": 2, "intent_coverage": 3,
                   "entities_coverage": 3, "total_entities": 1, "samples_with_entities": 2, "unique_entity_types": 1}
    issues = Counter(r["issue"].split(r["sample_id"])[1] for r in profile.format_issues(raw).collect())
    assert issues == {": Missing or empty 'sentence'": 2, ", Entity 0: Not a dictionary": 1, ", Entity 1: Missing 'type'": 1,
                      ", Entity 2: Missing 'filler'": 1, ": Missing or empty 'intent'": 1, ": Missing 'entities' field": 1}


def test_growth(spark):
    row = profile.augmentation_ratio(spark.range(4), spark.range(6)).first()
    assert tuple(row) == (4, 6, 50.0)
    assert profile.augmentation_ratio(spark.range(0), spark.range(6)).first()["augmentation_ratio"] == 0


def test_term_lookup_by_join(spark):
    terms = vocabulary_table(spark, Settings().vocabulary).filter("kind = 'devices'")
    texts = ["Bóng Đèn bàn", "tivi và radio", "ghế", "đèn led", ""]
    df = spark.createDataFrame([(t,) for t in texts * 3], "text string")
    got = {r["text"]: r["original"] for r in vocabulary.lookup_terms(df, terms).collect()}
    order = list(Settings().vocabulary.devices)
    assert got == {t: next(o for o in order if o in t.lower()) for t in texts if any(o in t.lower() for o in order)}


def test_vocabulary_table_round_trip(spark):
    words = Settings().vocabulary.extended("devices", {"loa": ["dàn loa"]}).extended("suffixes", ["nào"])
    assert vocabulary_from(vocabulary_table(spark, words)) == words
    assert list(words.devices)[-1] == "loa" and words.suffixes[-1] == "nào"
