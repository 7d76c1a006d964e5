"""A chain that stops for a review: resumed, resumed again, with a changed review, and after a break."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.operators import profile, quality, review
from lexiloom.plans import jobs, runs
from lexiloom.sources import readers, writers

RARE = replace(Settings(), min_intent_frequency=1000)


def reviewed(spark, folder, stamp, name, decision):
    rows = readers.read_review(spark, f"{folder}/review/review_samples_{stamp}.csv")
    writers.write_review(review.stamp_decisions(rows, score="", decision=decision), f"{folder}/review/{name}.csv", mode="overwrite")
    return rows.count()


def final(spark, folder, stamp):
    try:
        return spark.read.json(f"{folder}/final/batch={stamp}").count()
    except Exception:
        return 0


def files(path):
    return sorted((str(p), p.stat().st_mtime_ns) for p in path.rglob("*") if p.is_file())


def test_stop_review_resume(spark, utterances, tmp_path):
    folder = str(tmp_path)
    started = runs.start(utterances, RARE, folder, "a")
    assert started["input_samples"] == 8 and started["generated"] > 0
    before = files(tmp_path)
    assert runs.start(utterances, RARE, folder, "a") == started  # not made again
    assert runs.resume(spark, RARE, folder) is None and files(tmp_path) == before
    n = reviewed(spark, folder, "a", "reviewed_samples_1", "yes")
    done = runs.resume(spark, RARE, folder)
    assert done["final_samples"] == n == final(spark, folder, "a")
    assert done["augmentation_ratio"] == (n / 8 - 1) * 100
    before = files(tmp_path)
    assert runs.resume(spark, RARE, folder) == done and files(tmp_path) == before


def test_changed_review_replaces_the_result(spark, utterances, tmp_path):
    folder = str(tmp_path)
    runs.start(utterances, RARE, folder, "a")
    reviewed(spark, folder, "a", "reviewed_samples_1", "yes")
    first = runs.resume(spark, RARE, folder)
    reviewed(spark, folder, "a", "reviewed_samples_1", "no")
    second = runs.resume(spark, RARE, folder)
    assert first["final_samples"] > 0 and second["final_samples"] == 0 == final(spark, folder, "a")
    n = reviewed(spark, folder, "a", "reviewed_samples_2", "yes")
    assert runs.resume(spark, RARE, folder, by="name")["final_samples"] == n == final(spark, folder, "a")
    assert runs.resume(spark, RARE, folder, by="name", strategy="score_only")["final_samples"] == 0 == final(spark, folder, "a")


def test_broken_off_stages_are_done_anew(spark, utterances, tmp_path, monkeypatch):
    folder = str(tmp_path)
    log = runs._log

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs, "_log", lost)  # all files written, but not logged
    with pytest.raises(RuntimeError):
        runs.start(utterances, RARE, folder, "a")
    with pytest.raises(ValueError):
        runs.resume(spark, RARE, folder)
    monkeypatch.setattr(runs, "_log", log)
    runs.start(utterances, RARE, folder, "a")
    n = reviewed(spark, folder, "a", "reviewed_samples_1", "yes")
    monkeypatch.setattr(runs, "_log", lost)
    with pytest.raises(RuntimeError):
        runs.resume(spark, RARE, folder)
    monkeypatch.setattr(runs, "_log", log)
    assert runs.resume(spark, RARE, folder)["final_samples"] == n == final(spark, folder, "a")


def test_last_run_and_other_settings(spark, utterances, tmp_path):
    folder = str(tmp_path)
    runs.start(utterances, RARE, folder, "a")
    runs.start(utterances, RARE, folder, "b", test_mode=True, max_review_samples=2)
    reviewed(spark, folder, "b", "reviewed_samples_1", "yes")
    assert runs.resume(spark, RARE, folder)["stamp"] == "b"
    assert (final(spark, folder, "a"), final(spark, folder, "b")) == (0, 2)
    other = replace(RARE, min_quality=5.0)
    for call in (lambda: runs.resume(spark, other, folder), lambda: runs.start(utterances, other, folder, "a")):
        with pytest.raises(ValueError):
            call()


def test_no_input(spark, utterances, tmp_path):
    started = runs.start(utterances.limit(0), RARE, str(tmp_path), "a")
    assert (started["input_samples"], started["generated"]) == (0, 0)


def test_audit_equals_its_parts(spark, utterances):
    """What is read off the counts equals what the operators find on the cleaned rows."""
    extra = spark.createDataFrame(
        [(None, None, None), ("a  b", None, [(None, "x"), ("", "y"), ("t", None), (" t ", " z ")])],
        "sentence string, intent string, entities array<struct<type:string,filler:string>>")
    typed = utterances.unionByName(extra, allowMissingColumns=True)
    raw = typed.selectExpr("sample_id", "sentence", "intent", "parse_json(to_json(entities)) AS entities")
    for rows, source in ((typed, raw), (typed.limit(0), raw.limit(0))):
        found = jobs.audit(source, rows)
        cleaned = found.cleaned
        values = profile.entity_values(cleaned)
        same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert same(found.entity_statistics, profile.entity_statistics(cleaned, values))
        assert same(found.top_types, profile.top_values(values, "type")) and same(found.top_fillers, profile.top_values(values, "filler"))
        assert same(found.label_map, profile.label_map(cleaned))
        assert same(found.quality_report, jobs.quality_report(quality.validate_samples(cleaned), profile.label_counts(cleaned, pairs=False)))
    # The counts are one scan and one shuffle.
    plan = profile.audit_counts(typed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Generate") == 1


def test_an_audit_cleans_different_entities_once(spark, utterances):
    """The pass over the rows cleans nothing: equal entities are counted first."""
    many = utterances.crossJoin(spark.range(50).withColumnRenamed("id", "copy"))
    counts = profile.audit_counts(many, clean=True)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Generate") == 1 and "regexp_replace" not in plan
    assert counts.count() == profile.audit_counts(utterances, clean=True).count()
    tallies = {(r["section"], r["key"]): r["n"] for r in profile.audit_tallies(counts, clean=True).collect()}
    one = {(r["section"], r["key"]): r["n"] for r in profile.audit_tallies(profile.audit_counts(utterances, clean=True), clean=True).collect()}
    assert tallies == {key: 50 * n for key, n in one.items()} and one[("totals", "samples")] == utterances.count()


def test_a_generation_takes_little_disk(spark, utterances, tmp_path):
    """Variants repeat their originals: what a run writes of them takes a fraction of its text, and reads as before."""
    many = utterances.crossJoin(spark.range(200).select(F.col("id").cast("string").alias("copy"))).select(
        F.struct("seq.n", F.col("copy").cast("int").alias("copy")).alias("seq"), F.concat_ws("-", "sample_id", "copy").alias("sample_id"),
        "sentence", "intent", "entities").coalesce(2)
    result = jobs.generate(many, replace(RARE, min_intent_frequency=10 ** 6))
    jobs.write_generation(result, str(tmp_path), "a")
    plain = 0
    for folder, rows in (("augmented_data_a/augmentations", result.augmentations), ("generation_stats_a/quality_issues", result.issues)):
        lines = spark.read.text(f"{tmp_path}/augmented/{folder}")
        assert lines.count() == rows.count() > 500
        plain += lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    written = sum(p.stat().st_size for d in ("augmented_data_a/augmentations", "generation_stats_a/quality_issues")
                  for p in (tmp_path / "augmented" / d).glob("part-*"))
    assert written * 4 < plain
