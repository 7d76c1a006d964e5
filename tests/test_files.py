import json
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiloom import Settings, load_settings, session
from lexiloom.operators import review
from lexiloom.plans import jobs
from lexiloom.schema import REVIEW_COLUMNS, REVIEW_REQUIRED, TRAINING_COLUMNS
from lexiloom.sources import readers, writers

S = Settings()


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join([
        '{"sentence": "bật đèn", "intent": "bật", "entities": [{"type": "device", "filler": "đèn"}], "speaker": "an"}',
        "", '{"sentence": "cụt', '{"intent": "i"}', '{"sentence": "s"}', '{"sentence": "dừng", "intent": "dừng"}',
    ]), encoding="utf-8")
    return str(path)


def test_validated_and_lenient_scan(spark, lines):
    good = readers.read_utterances(spark, lines).orderBy("seq").collect()
    assert [(r["sentence"], len(r["entities"])) for r in good] == [("bật đèn", 1), ("dừng", 0)]
    assert readers.read_lenient(spark, lines).count() == 4
    reasons = [r["reason"] for r in readers.rejected_lines(spark, lines).orderBy("seq").collect()]
    assert reasons == ["Invalid JSON", "Missing 'sentence' field", "Missing 'intent' field"]
    from pyspark.sql.types import StringType, StructField
    more = readers.read_utterances(spark, lines, [StructField("speaker", StringType())]).orderBy("seq").first()
    assert more["speaker"] == "an"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_utterances(spark, lines + ".absent")


def test_line_order_survives_splits(spark, tmp_path):
    path = str(tmp_path / "many")
    rows = spark.range(0, 5000, 1, 1).select(F.to_json(F.struct(
        F.col("id").cast("string").alias("sentence"), F.lit("i").alias("intent"))).alias("value"))
    rows.write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_utterances(spark, path)
        assert df.rdd.getNumPartitions() > 3
        assert [r["sentence"] for r in df.orderBy("seq").collect()] == [str(i) for i in range(5000)]
        assert [r["sentence"] for r in readers.head(df, 3).collect()] == ["0", "1", "2"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_review_csv_round_trip(spark, tmp_path):
    tricky = ['say "hi", then\nstop', " edges ", "a,b", "", None, "plain"]
    data = [tuple([str(i), t] + [t] * 10) for i, t in enumerate(tricky)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in REVIEW_COLUMNS))
    path = writers.write_review(df, str(tmp_path / "r.csv"))
    back = {r["Sample_ID"]: r["Comments"] for r in readers.read_review(spark, path).collect()}
    assert back == {str(i): (t or None) for i, t in enumerate(tricky)}


def test_review_columns_are_checked(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("Sample_ID,Original_Sentence\n1,x\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Missing required columns.*Approved_Yes_No"):
        readers.read_review(spark, str(path))
    full = tmp_path / "eleven.csv"
    full.write_text(",".join(REVIEW_REQUIRED) + "\n" + ",".join("abcdefghijk") + "\n1,2\n", encoding="utf-8")
    rows = readers.read_review(spark, str(full)).collect()
    assert rows[0]["Approved_Yes_No"] == "k" and rows[0]["Comments"] is None and len(rows) == 2
    assert readers.read_review(spark, str(full), drop_short=True).select("Sample_ID", "Approved_Yes_No").collect()[0][1] == "k"


def test_review_files_with_different_headers(spark, tmp_path):
    full = ["1", *"abcdefgh", "said", "yes"]
    cells = dict(zip(REVIEW_COLUMNS, ["1", *"abcdefghi", "said", "yes"]))
    for name, header in (("a.csv", REVIEW_COLUMNS), ("b.csv", REVIEW_REQUIRED), ("c.csv", [*reversed(REVIEW_COLUMNS), "Extra"])):
        (tmp_path / name).write_text(",".join(header) + "\n" + ",".join(cells.get(c, "more") for c in header) + "\n", encoding="utf-8")
    rows = readers.read_review(spark, f"{tmp_path}/*.csv").collect()
    assert [r["Approved_Yes_No"] for r in rows] == ["yes"] * 3 and Counter(r["Comments"] for r in rows) == {"said": 2, None: 1}
    assert {r["Extra"] for r in rows} == {"more", None} and len(full) == 11


def test_rows_with_too_few_or_too_many_cells(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(",".join(REVIEW_REQUIRED) + "\n" + "1" + ",x" * 10 + "\n2,x\n3" + ",x" * 12 + "\n", encoding="utf-8")
    assert [r["Sample_ID"] for r in readers.read_review(spark, str(path)).collect()] == ["1", "2", "3"]
    assert [r["Sample_ID"] for r in readers.read_review(spark, str(path), drop_short=True).collect()] == ["1", "3"]


def test_odd_entities_keep_their_row(spark, tmp_path):
    path = tmp_path / "odd.jsonl"
    path.write_text('{"sentence": "a", "intent": "i", "entities": ["loose", {"type": "t", "filler": "f"}, 5]}\n'
                    '{"sentence": "b", "intent": "i", "entities": "none"}\n{"sentence": "c", "intent": "i", "entities": null}\n'
                    '{"sentence": "d", "intent": "i"}\nnot json\n')
    kept = {r["sentence"]: [tuple(e) for e in r["entities"]] for r in readers.read_utterances(spark, str(path)).collect()}
    assert kept == {"a": [("t", "f")], "b": [], "c": [], "d": []}
    assert sorted(r["entity"] for r in readers.odd_entities(spark, str(path)).collect()) == ['"loose"', '"none"', "5"]
    assert [r["reason"] for r in readers.rejected_lines(spark, str(path)).collect()] == ["Invalid JSON"]
    lenient = {r["sentence"]: r["entities"] for r in readers.read_lenient(spark, str(path)).collect()}
    assert lenient["c"] is None and lenient["d"] is None and len(lenient["a"]) == 1


def test_newest_batch(spark, tmp_path):
    import os
    for name, age in (("review_samples_2.csv", 50), ("review_samples_1.csv", 10)):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (1_700_000_000 - age, 1_700_000_000 - age))
    pattern = f"{tmp_path}/review_samples_*.csv"
    assert readers.newest_batch(spark, pattern).endswith("review_samples_1.csv")
    assert readers.newest_batch(spark, pattern, by="name").endswith("review_samples_2.csv")
    assert readers.newest_batch(spark, f"{tmp_path}/absent_*.csv") is None


def test_generate_review_integrate_files(spark, tmp_path, utterances):
    out = str(tmp_path)
    result = jobs.generate(utterances, S, max_review_samples=4)
    jobs.write_generation(result, out, "t1")
    envelope = spark.read.json(f"{out}/augmented/augmented_data_t1/metadata").first()
    assert envelope["total_augmentations"] == result.augmentations.count()
    newest = readers.newest_batch(spark, f"{out}/review/review_samples_*.csv")
    batch = readers.read_review(spark, newest)
    assert [r["Sample_ID"] for r in batch.orderBy("Sample_ID").collect()] == ["1", "2", "3", "4"]
    done = jobs.integrate_review(review.stamp_decisions(batch), S, reviewed_at="2025-01-01T00:00:00")
    jobs.write_integration(done, out, "t1")
    training = readers.read_training_set(spark, f"{out}/final")
    assert set(TRAINING_COLUMNS) <= set(training.columns) and training.count() == 4
    first = training.orderBy("_sample_id").first()
    assert first["_augmented"] and first["_quality_score"] == 4 and first["_review_timestamp"] == "2025-01-01T00:00:00"
    report = spark.read.json(f"{out}/report/integration_report_t1").first()
    assert report["approved_samples_count"] == 4


def test_whole_chain(spark, utterances):
    stopped = jobs.generate_and_integrate(utterances, S)
    assert stopped.integration is None and stopped.generation.review.count() > 0
    chain = jobs.generate_and_integrate(utterances, S, review.stamp_decisions)
    row = chain.growth.first()
    assert row["input_samples"] == 8 and row["final_samples"] == chain.generation.augmentations.count()
    gated = jobs.generate(utterances, S, pair_gate=True)
    assert gated.augmentations.count() < chain.generation.augmentations.count()
    assert gated.issues.filter("failed_rule = 'pair_checks'").count() > 0


def test_formats(spark, tmp_path, utterances):
    tagged = utterances.withColumn("metadata", F.expr("named_struct('source', 'original', 'augmented', false)"))
    kept = writers.write_dataset(tagged, f"{tmp_path}/a", S)
    assert set(spark.read.json(kept).columns) == {"sentence", "intent", "entities", "metadata"}
    bare = writers.write_dataset(tagged, f"{tmp_path}/b", replace(S, add_metadata=False, output_format="json"))
    rows = json.loads("".join(p.read_text(encoding="utf-8") for p in sorted(Path(bare).glob("part-*"))))
    assert {c for r in rows for c in r} == {"sentence", "intent", "entities"} and len(rows) == utterances.count()
    flat = writers.write_dataset(tagged, f"{tmp_path}/c", replace(S, output_format="csv"))
    rows = spark.read.option("header", True).option("escape", '"').csv(flat).collect()
    assert {r["source"] for r in rows} == {"original"}
    assert json.loads([r for r in rows if r["intent"] == "mở"][0]["entities"])[1] == {"type": "time_at", "filler": "9 giờ tối"}
    for fmt in ("jsonl", "json"):
        path = writers.export_for_training(utterances.repartition(3), f"{tmp_path}/{fmt}", fmt)
        assert path.endswith(f"training_data.{fmt}")
        assert readers.read_training_set(spark, path, one_array=fmt == "json").count() == utterances.count()
    assert writers.export_for_training(utterances, f"{tmp_path}/t", "csv").endswith("training_data.csv")
    for call in (lambda: writers.export_for_training(utterances, f"{tmp_path}/t", "xml"),
                 lambda: writers.write_dataset(tagged, f"{tmp_path}/x", replace(S, output_format="xml")),
                 lambda: writers.write_final(tagged, f"{tmp_path}/x", "b", "xml")):
        with pytest.raises(ValueError, match="Unsupported"):
            call()


def test_one_array_training_set(spark, tmp_path):
    path = tmp_path / "set.json"
    path.write_text(json.dumps([{"sentence": "a", "intent": "i", "entities": []}, {"sentence": "b", "intent": "i"}], indent=2))
    assert readers.read_training_set(spark, str(path), one_array=True).count() == 2


def test_settings_file(spark, tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("augmentation:\n  min_intent_frequency: 7\n  sample_augmentation_methods: [time_variation]\n"
                    "vocabularies:\n  devices:\n    loa: [dàn loa]\n  politeness:\n    prefixes: [Ơi]\n", encoding="utf-8")
    s = load_settings(spark, str(path))
    assert s.min_intent_frequency == 7 and s.methods == ("time_variation",) and s.min_entity_frequency == 50
    assert s.vocabulary.devices == {"loa": ["dàn loa"]} and s.vocabulary.prefixes == ["Ơi"] and s.vocabulary.actions == {}


def test_audit(spark, tmp_path, lines):
    result = jobs.audit(readers.read_raw(spark, lines), readers.read_utterances(spark, lines))
    assert result.label_map.count() == 3
    assert result.format_issues.count() == 5
    assert "Intent Distribution" in jobs.render_quality_report(result.quality_report)


def test_intermediate_files_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_root", lambda _: f"{tmp_path}/work")
    assert session.settle(spark.range(5)).count() == 5 and list(tmp_path.iterdir())
    session.clear_work(spark)
    assert not list(tmp_path.iterdir())
