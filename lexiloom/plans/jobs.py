"""The user-level jobs: generate, integrate a review, merge, the whole chain, audit.

Jobs take and return DataFrames; ``write_*`` puts a result into a folder. What
several outputs share is settled once (written and read back), so none of them
computes it again and a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.entities import normalise
from lexiloom.functions.text import clean_text
from lexiloom.operators import integrate, profile, quality, review
from lexiloom.operators.augment import accepted, candidates, rejected
from lexiloom.operators.rarity import rare_samples
from lexiloom.session import settle
from lexiloom.sources import readers, writers


@dataclass
class Generation:
    profile: DataFrame
    augmentations: DataFrame
    issues: DataFrame
    review: DataFrame
    statistics: DataFrame


def generate(df: DataFrame, settings: Settings, test_mode: bool = False, max_review_samples: int = 100,
             extra_methods: Mapping | None = None, extra_checks: Mapping | None = None,
             pair_gate: bool = False) -> Generation:
    """Profile the utterances, rewrite the rare ones, gate the variants, start a review batch.

    ``pair_gate`` also drops variants that fail a pair check.
    """
    utterances = readers.head(df) if test_mode else df
    rarity = settle(profile.rarity_profile(utterances, settings))
    rare = rare_samples(utterances, rarity, settings)
    variants = candidates(rare, settings, extra_methods=extra_methods, extra_checks=extra_checks)
    if pair_gate:
        checked = quality.validate_pairs(variants, settings)
        variants = checked.withColumn(
            "failed_rule", F.coalesce("failed_rule", F.when(~F.col("valid"), "pair_checks"))
        ).withColumn("quality_passed", F.col("quality_passed") & F.col("valid")).select(*variants.columns)
    variants = settle(variants)
    passed = accepted(variants)
    return Generation(
        profile=rarity,
        augmentations=passed,
        issues=rejected(variants),
        review=review.review_batch(passed, max_review_samples),
        statistics=profile.generation_statistics(variants, rarity),
    )


def write_generation(result: Generation, folder: str, stamp: str, mode: str = "error") -> None:
    writers.write_augmentations(
        result.augmentations.withColumn("timestamp", F.lit(stamp)), f"{folder}/augmented/augmented_data_{stamp}", stamp, mode)
    writers.write_review(result.review, f"{folder}/review/review_samples_{stamp}.csv", mode)
    base = f"{folder}/augmented/generation_stats_{stamp}"
    writers.write_jsonl(result.profile, f"{base}/dataset_analysis", mode)
    writers.write_report(result.statistics, f"{base}/generation_statistics", mode)
    writers.write_jsonl(result.issues.withColumn("timestamp", F.lit(stamp)), f"{base}/quality_issues", mode, compression="gzip")


@dataclass
class Integration:
    final: DataFrame
    training: DataFrame
    report: DataFrame


def integrate_review(reviewed: DataFrame, settings: Settings, strategy: str = "balanced",
                     reviewed_at: str | None = None) -> Integration | None:
    """The approved samples of a review and a report; None when nothing was approved."""
    final = settle(review.final_samples(reviewed, settings, strategy))
    if final.isEmpty():
        return None
    return Integration(
        final=final,
        training=review.training_shape(final, reviewed_at),
        report=review.integration_report(reviewed, final, settings, strategy),
    )


def write_integration(result: Integration, folder: str, stamp: str, fmt: str = "jsonl", mode: str = "error") -> None:
    """The final set under its batch, which a rerun replaces, and the report."""
    writers.write_final(result.training, f"{folder}/final", stamp, fmt)
    writers.write_report(
        result.report.withColumn("report_generated_at", F.current_timestamp().cast("string")),
        f"{folder}/report/integration_report_{stamp}", mode)


@dataclass
class Merge:
    final: DataFrame
    summary: DataFrame
    original_counts: DataFrame
    augmented_counts: DataFrame
    final_counts: DataFrame


def merge_augmented(original: DataFrame, augmented: DataFrame, settings: Settings,
                    target_distribution: Mapping[str, int] | None = None) -> Merge:
    """Balance the augmented rows, add them to the original ones, drop copies, report."""
    if settings.strategy not in integrate.STRATEGIES:
        raise ValueError(f"Unknown strategy: {settings.strategy}")
    original_counts = settle(profile.label_counts(original))
    augmented_counts = settle(profile.label_counts(augmented))
    turns = integrate.first_seen(original) if settings.strategy == "balanced" and not target_distribution else None
    chosen = integrate.balance(original_counts, augmented, settings, target_distribution, turns)
    final = settle(integrate.deduplicate(integrate.merge(original, chosen, settings)))
    return Merge(
        final=final,
        summary=integrate.integration_summary(original_counts, augmented_counts, chosen, final, settings),
        original_counts=original_counts,
        augmented_counts=augmented_counts,
        final_counts=profile.label_counts(final),
    )


def write_merge(result: Merge, folder: str, settings: Settings) -> None:
    """The merged set in the format of the settings, and its report."""
    writers.write_dataset(result.final, f"{folder}/merged", settings)
    writers.write_report(result.summary, f"{folder}/merge_report")


@dataclass
class Chain:
    generation: Generation
    reviewed: DataFrame | None
    integration: Integration | None
    growth: DataFrame | None


def generate_and_integrate(df: DataFrame, settings: Settings,
                           decide: Callable[[DataFrame], DataFrame] | None = None,
                           test_mode: bool = False, max_review_samples: int = 100) -> Chain:
    """Generation, review, integration and growth in one go.

    ``decide`` fills in the review, ``review.stamp_decisions`` for a
    demonstration; without it the chain stops at the review batch.
    """
    generation = generate(df, settings, test_mode, max_review_samples)
    if decide is None:
        return Chain(generation, None, None, None)
    reviewed = decide(generation.review)
    integration = integrate_review(reviewed, settings)
    growth = None if integration is None else profile.augmentation_ratio(df, integration.final)
    return Chain(generation, reviewed, integration, growth)


@dataclass
class Audit:
    format_issues: DataFrame
    format_report: DataFrame
    cleaned: DataFrame
    entity_statistics: DataFrame
    top_types: DataFrame
    top_fillers: DataFrame
    label_map: DataFrame
    quality_report: DataFrame


def audit(raw: DataFrame, typed: DataFrame) -> Audit:
    """Format check of a raw scan; cleaning, statistics, labels and quality of a typed one.

    The typed table is counted in one pass and the different entities among
    those counts are cleaned; all outputs but the cleaned rows themselves are
    read off that.
    """
    cleaned = typed.withColumns({"sentence": clean_text(F.col("sentence")), "entities": normalise(F.col("entities"))})
    counts = settle(profile.audit_tallies(profile.audit_counts(typed, clean=True), clean=True))
    values = profile.counted_values(counts)
    return Audit(
        format_issues=profile.format_issues(raw),
        format_report=profile.format_report(raw),
        cleaned=cleaned,
        entity_statistics=profile.counted_statistics(counts),
        top_types=profile.top_values(values, "type"),
        top_fillers=profile.top_values(values, "filler"),
        label_map=profile.counted_label_map(counts),
        quality_report=_report(profile.counted_quality(counts), None, profile.counted_labels(counts)),
    )


def quality_report(validated: DataFrame, counts: DataFrame, sentence: str = "sentence",
                   pairs: bool = False) -> DataFrame:
    """``(section, position, key, n, rate)``: totals, failed checks, ten commonest intents and types."""
    return _report(quality.quality_summary(validated, sentence, pairs), quality.failed_check_counts(validated), counts)


def _report(totals: DataFrame, failed: DataFrame | None, counts: DataFrame) -> DataFrame:
    rate = F.lit(None).cast("double")
    summary = totals.select(F.inline(F.array(
        F.struct(F.lit("totals").alias("section"), F.lit(1).alias("position"), F.lit("total_samples").alias("key"),
                 F.col("total_samples").alias("n"), rate.alias("rate")),
        F.struct(F.lit("totals").alias("section"), F.lit(2).alias("position"), F.lit("passed_all_checks").alias("key"),
                 F.col("passed_all_checks").alias("n"), F.col("quality_rate").alias("rate")),
        F.struct(F.lit("totals").alias("section"), F.lit(3).alias("position"), F.lit("samples_with_vietnamese").alias("key"),
                 F.col("samples_with_vietnamese").alias("n"), F.col("vietnamese_rate").alias("rate")),
    )))

    def ranked(table: DataFrame, section: str, key: str, k: int | None) -> DataFrame:
        position = F.row_number().over(Window.orderBy(F.desc("n"), F.asc(key)))
        return profile.top(table.select(key, "n"), k, key).select(
            F.lit(section).alias("section"), position.alias("position"), F.col(key).alias("key"), "n",
            rate.alias("rate"))

    def dimension(name: str) -> DataFrame:
        return counts.filter(F.col("dimension") == name).select("label", "n")

    checked = summary if failed is None else summary.unionByName(ranked(failed, "failed_checks", "check", None))
    return (
        checked
        .unionByName(ranked(dimension(profile.INTENT), "intents", "label", 10))
        .unionByName(ranked(dimension(profile.TYPE), "entity_types", "label", 10))
    )


def write_quality_report(report: DataFrame, folder: str) -> None:
    """The report table as JSON lines, and rendered as text."""
    kept = settle(report)
    writers.write_jsonl(kept, f"{folder}/quality_report_stats")
    text = kept.sparkSession.range(1).select(F.lit(render_quality_report(kept)).alias("value"))
    text.write.text(f"{folder}/quality_report")


# Headings of the rendered report.
_HEADINGS = {
    "totals": "Totals",
    "failed_checks": "Failed Checks Distribution",
    "intents": "Intent Distribution",
    "entity_types": "Entity Type Distribution",
}


def render_quality_report(report: DataFrame) -> str:
    """The report table as text; it has a few dozen rows."""
    lines = []
    section = None
    for row in report.orderBy(F.expr("array_position(array('totals','failed_checks','intents','entity_types'), section)"),
                              "position").collect():
        if row["section"] != section and row["section"] in _HEADINGS:
            lines.append(f"\n## {_HEADINGS[row['section']]}:")
        section = row["section"]
        share = "" if row["rate"] is None else f" ({row['rate']:.1%})"
        lines.append(f"   {row['key']}: {row['n']:,}{share}")
    return "\n".join(lines)
