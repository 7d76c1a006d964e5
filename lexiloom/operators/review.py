"""Human review: decisions, scores and the final set they lead to.

A review table is all text (``schema.REVIEW_COLUMNS``). Approval is NULL-safe
and NaN-safe: Spark orders NaN above every number, so NaN is mapped to NULL
before any comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.entities import entities_json, parse_entities, repair_json
from lexiloom.functions.text import strip
from lexiloom.schema import REVIEW_COLUMNS

# Review strategies, and the stamp of a demonstration review.
REVIEW_STRATEGIES = ("balanced", "all_approved", "score_only")
DEMO_SCORE, DEMO_COMMENT = "4", "Auto-approved for demo"

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITY = r"^(?i)[+-]?inf(inity)?$"

_SCORES = {"quality": "Quality_Score_1_5", "naturalness": "Naturalness_Score_1_5"}


def number(text: Column) -> Column:
    """A double, or NULL for text that is not a number (NaN included)."""
    plain = strip(text)
    return F.when(plain.rlike(_NUMBER), plain.try_cast("double")).when(
        plain.rlike(_INFINITY), F.when(plain.startswith("-"), float("-inf")).otherwise(float("inf")))


def whole(text: Column) -> Column:
    """The number truncated to an int."""
    return number(text).try_cast("int")


def identifier(text: Column) -> Column:
    """A bigint from digits as they are; a number with a fraction is truncated."""
    plain = strip(text)
    return F.coalesce(F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("bigint")), number(text).try_cast("bigint"))


def _says(column: str, word: str) -> Column:
    return F.coalesce(strip(F.lower(column)) == word, F.lit(False))


def with_decision(review: DataFrame, settings: Settings) -> DataFrame:
    """``explicit_yes``, ``explicit_no``, ``score_ok``, ``approved`` and ``rejected``.

    A score approves unless a person said no; every row is approved or rejected.
    """
    score_ok = F.coalesce(
        (number(F.col(_SCORES["quality"])) >= settings.min_quality)
        & (number(F.col(_SCORES["naturalness"])) >= settings.min_naturalness), F.lit(False))
    yes, no, ok = F.col("explicit_yes"), F.col("explicit_no"), F.col("score_ok")
    return (
        review.withColumns({
            "explicit_yes": _says("Approved_Yes_No", "yes"),
            "explicit_no": _says("Approved_Yes_No", "no"),
            "score_ok": score_ok,
        })
        .withColumn("approved", yes | (ok & ~no))
        .withColumn("rejected", no | (~ok & ~yes))
    )


def review_analysis(review: DataFrame, settings: Settings) -> DataFrame:
    """One row of counts over all decisions."""
    return with_decision(review, settings).agg(
        F.count("*").alias("total_samples"),
        F.count_if("approved").alias("approved_count"),
        F.count_if("rejected").alias("rejected_count"),
        F.count_if("explicit_yes").alias("explicit_approvals_count"),
        F.count_if("explicit_no").alias("explicit_rejections_count"),
        F.count_if("score_ok").alias("score_based_approvals_count"),
    )


def status() -> Column:
    """What the review page shows: the lower-case decision itself, untrimmed."""
    said = F.lower("Approved_Yes_No")
    return F.when(said == "yes", "approved").when(said == "no", "rejected").otherwise("pending")


def review_progress(review: DataFrame) -> DataFrame:
    """Counts by status per method, and their total (``is_total``), which is there without rows too.

    Rows without a method are a group of their own.
    """
    statuses = ("approved", "rejected", "pending")
    each = review.withColumn("_status", status()).groupBy("Augmentation_Method").agg(
        F.count("*").alias("total"), *(F.count_if(F.col("_status") == s).alias(s) for s in statuses))
    zero = F.lit(0).cast("bigint")
    total = each.agg(*(F.coalesce(F.sum(c), zero).alias(c) for c in ("total", *statuses)))
    rows = each.withColumn("is_total", F.lit(False)).unionByName(
        total.withColumn("is_total", F.lit(True)), allowMissingColumns=True)
    return rows.withColumn("approval_rate", F.when(F.col("total") == 0, 0.0).otherwise(F.col("approved") / F.col("total")))


def filter_by_scores(review: DataFrame, min_quality: float = 3.0, min_naturalness: float = 3.0) -> DataFrame:
    """Rows with both scores high enough; an absent score is 0, an unreadable one drops the row."""
    def score(name: str) -> Column:
        text = F.col(_SCORES[name])
        return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(number(text))

    return review.filter((score("quality") >= min_quality) & (score("naturalness") >= min_naturalness))


def filter_review(review: DataFrame, method: str | None = None, wanted: str | None = None,
                  term: str | None = None) -> DataFrame:
    """Rows of one method, of one status, or with a term in either sentence."""
    rows = review
    if method is not None:
        rows = rows.filter(F.col("Augmentation_Method") == method)
    if wanted is not None:
        rows = rows.filter(status() == wanted)
    if term is not None:
        low = F.lower(F.lit(term))
        rows = rows.filter(F.contains(F.lower("Original_Sentence"), low) | F.contains(F.lower("Augmented_Sentence"), low))
    return rows


def auto_approve(review: DataFrame, settings: Settings) -> DataFrame:
    """``yes`` for undecided rows with both scores at the threshold or above."""
    high = F.coalesce((number(F.col(_SCORES["quality"])) >= settings.auto_approve_at)
                      & (number(F.col(_SCORES["naturalness"])) >= settings.auto_approve_at), F.lit(False))
    return review.withColumn(
        "Approved_Yes_No",
        F.when(high & (status() == "pending"), "yes").otherwise(F.col("Approved_Yes_No")))


def stamp_decisions(review: DataFrame, score: str = DEMO_SCORE, decision: str = "yes",
                    comment: str = DEMO_COMMENT) -> DataFrame:
    """The same scores, decision and comment on every row."""
    return review.withColumns({
        _SCORES["quality"]: F.lit(score), _SCORES["naturalness"]: F.lit(score),
        "Approved_Yes_No": F.lit(decision), "Comments": F.lit(comment),
    })


def apply_decisions(review: DataFrame, decisions: DataFrame) -> DataFrame:
    """Scores and approvals from ``(Sample_ID, field, value, at)``; the last write of a field wins.

    ``field`` is the name of a score or approval column. Writes are reduced
    map-side, so one sample with very many of them is no hot spot.
    """
    fields = [*_SCORES.values(), "Approved_Yes_No"]
    latest = decisions.filter(F.col("field").isin(*fields)).groupBy("Sample_ID").agg(*[
        F.max(F.when(F.col("field") == f, F.struct("at", "value"))).alias(f"_{f}") for f in fields
    ])
    joined = review.join(latest, "Sample_ID", "left")
    return joined.select(*[
        F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c)
        if c in fields else F.col(c)
        for c in review.columns
    ])


def repair_entities(review: DataFrame) -> DataFrame:
    """Both entity columns made valid JSON; ``repaired`` counts those that were changed."""
    columns = ["Original_Entities", "Augmented_Entities"]
    changed = F.lit(0)
    for c in columns:
        changed = changed + (~F.col(f"_{c}").eqNullSafe(F.col(c))).cast("int")
    fixed = review.withColumns({f"_{c}": repair_json(F.col(c)) for c in columns})
    return fixed.select(
        *[F.col(f"_{c}").alias(c) if c in columns else F.col(c) for c in review.columns],
        changed.alias("repaired"),
    )


def strategy_mask(strategy: str) -> Column:
    """Which decided rows a review strategy takes."""
    if strategy == "balanced":
        return F.col("approved")
    if strategy == "all_approved":
        return F.col("explicit_yes")
    if strategy == "score_only":
        return F.col("score_ok")
    raise ValueError(f"Unknown strategy: {strategy}")


def final_samples(review: DataFrame, settings: Settings, strategy: str = "balanced") -> DataFrame:
    """Approved rows, typed. Rows with malformed entity JSON are left out.

    ``approved`` is true only for an explicit yes.
    """
    taken = with_decision(review, settings).filter(strategy_mask(strategy))
    parsed = taken.withColumns({
        "_o": parse_entities(F.col("Original_Entities")),
        "_a": parse_entities(F.col("Augmented_Entities")),
    }).filter("_o.ok AND _a.ok")
    return parsed.select(
        identifier(F.col("Sample_ID")).alias("sample_id"),
        F.col("Original_Sentence").alias("original_sentence"),
        F.col("Original_Intent").alias("original_intent"),
        F.col("_o.entities").alias("original_entities"),
        F.col("Augmented_Sentence").alias("augmented_sentence"),
        F.col("Augmented_Intent").alias("augmented_intent"),
        F.col("_a.entities").alias("augmented_entities"),
        F.col("Augmentation_Method").alias("augmentation_method"),
        whole(F.col(_SCORES["quality"])).alias("quality_score"),
        whole(F.col(_SCORES["naturalness"])).alias("naturalness_score"),
        F.col("explicit_yes").alias("approved"),
    )


def training_shape(final: DataFrame, reviewed_at: str | Column | None = None) -> DataFrame:
    """Final samples as training rows with flat provenance columns."""
    at = reviewed_at if isinstance(reviewed_at, Column) else F.lit(reviewed_at).cast("string")
    return final.select(
        F.col("augmented_sentence").alias("sentence"),
        F.col("augmented_intent").alias("intent"),
        F.col("augmented_entities").alias("entities"),
        F.lit(True).alias("_augmented"),
        F.col("augmentation_method").alias("_augmentation_method"),
        F.col("original_sentence").alias("_original_sentence"),
        F.col("quality_score").alias("_quality_score"),
        F.col("naturalness_score").alias("_naturalness_score"),
        at.alias("_review_timestamp"),
        F.col("sample_id").alias("_sample_id"),
    )


def _review_values(sample_id: Column) -> list[Column]:
    empty = F.lit("")
    values = {
        "Sample_ID": sample_id.cast("string"),
        "Original_Sentence": F.col("original_sentence"),
        "Original_Intent": F.col("original_intent"),
        "Original_Entities": entities_json(F.col("original_entities")),
        "Augmented_Sentence": F.col("augmented_sentence"),
        "Augmented_Intent": F.col("augmented_intent"),
        "Augmented_Entities": entities_json(F.col("augmented_entities")),
        "Augmentation_Method": F.col("method"),
        "Quality_Score_1_5": empty, "Naturalness_Score_1_5": empty,
        "Comments": empty, "Approved_Yes_No": empty,
    }
    return [values[c].alias(c) for c in REVIEW_COLUMNS]


def review_rows(augmentations: DataFrame) -> DataFrame:
    """Every augmentation as a review row, numbered uniquely but not consecutively."""
    return augmentations.select(*_review_values(F.monotonically_increasing_id() + 1))


def review_batch(augmentations: DataFrame, max_samples: int = 100, order: list[str] | None = None) -> DataFrame:
    """The first ``max_samples`` augmentations, numbered from 1, with empty review columns.

    The numbering window runs over those rows only, after the limit.
    """
    order = order or ["seq", "method_no"]
    head = augmentations.orderBy(*order).limit(max_samples)
    numbered = head.withColumn("_no", F.row_number().over(Window.orderBy(*order)))
    return numbered.orderBy("_no").select(*_review_values(F.col("_no")))


def integration_report(review: DataFrame, final: DataFrame, settings: Settings, strategy: str) -> DataFrame:
    """One row of review counts next to the size of the final set."""
    counted = review_analysis(review, settings).withColumn("_k", F.lit(1))
    sized = final.agg(F.count("*").alias("approved_samples_count")).withColumn("_k", F.lit(1))
    return counted.join(sized, "_k").select(
        F.col("total_samples").alias("total_samples_in_review_file"),
        "approved_samples_count",
        F.col("rejected_count").alias("rejected_samples_count"),
        F.col("explicit_approvals_count").alias("explicitly_approved_count"),
        F.col("explicit_rejections_count").alias("explicitly_rejected_count"),
        "score_based_approvals_count",
        F.lit(strategy).alias("integration_strategy"),
        F.lit("This report summarizes the integration of human-reviewed augmented samples.").alias("notes"),
    )
