"""Quality rules.

Two families that must not be merged: the generation gate (word ratio, sorted
types, loose letters) and the pair checks (character ratio, ordered types,
diacritics). A pair check is a column holding its message, NULL when it passes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.entities import listed, types_of
from lexiloom.functions.text import (
    ONE_BLANK, has_diacritics, has_vietnamese_letters, let, two_decimals, words,
)

# Words that may stand twice in a row.
MAY_REPEAT = ("của", "và", "là", "có")
# Gate limits.
MAX_WORDS = 20
REPETITION_FROM = 4


# --- generation gate -------------------------------------------------------

def coherent(low_words: Column) -> Column:
    """At most 20 lower-case words, and in more than 3 none makes up more than half.

    A word that makes up more than half of a sorted list also stands in its
    middle, so only that word is counted. No lambda: the test is compiled.
    """
    n = F.size(low_words)
    half = F.floor(n / 2).cast("int")
    others = F.array_remove(low_words, F.get(F.sort_array(low_words), half))
    return (
        F.when(n > MAX_WORDS, False)
        .when(n >= REPETITION_FROM, n - F.size(others) <= half)
        .otherwise(True)
    )


def same_types_sorted(before: Column, after: Column) -> Column:
    return F.sort_array(types_of(before)) == F.sort_array(types_of(after))


def first_failed_rule(
    original: Column, augmented: Column, original_entities: Column, augmented_entities: Column,
    n_original: Column, n_augmented: Column, low_words: Column, settings: Settings,
) -> Column:
    """Name of the first gate rule broken; NULL when the variant passes.

    ``low_words`` are the lower-case words of the variant; they are read only
    where it differs from its original.
    """
    ratio = n_augmented / F.nullif(n_original, F.lit(0))
    # A text without words is a blank one.
    rule = (
        F.when(~F.coalesce(augmented.isNotNull() & (n_augmented > 0), F.lit(False)), "blank")
        .when(augmented == original, "unchanged")
        .when(n_original == 0, "empty_original")
        .when((ratio < settings.min_length_ratio) | (ratio > settings.max_length_ratio), "length_ratio")
    )
    if settings.check_entity_preservation:
        rule = rule.when(F.size(listed(original_entities)) != F.size(listed(augmented_entities)), "entity_count")
        # Most methods leave the entities as they are; only changed ones reach the lambdas of the types.
        changed = original_entities != augmented_entities
        rule = rule.when(changed & ~same_types_sorted(original_entities, augmented_entities), "entity_types")
    if settings.require_vietnamese_characters:
        rule = rule.when(~has_vietnamese_letters(augmented), "vietnamese_characters")
    return rule.when(~coherent(low_words), "coherence")


def python_check(fn: Callable[[str, str, list[dict]], bool]) -> Callable[[Column, Column, Column], Column]:
    """A user check from an ordinary function ``(original, augmented, entities) → valid``.

    It is called for variants that have passed everything before it, batch by
    batch; entities are dictionaries of type and filler.
    """
    @F.arrow_udf("boolean")
    def checked(original: pa.Array, augmented: pa.Array, entities: pa.Array) -> pa.Array:
        rows = zip(original.to_pylist(), augmented.to_pylist(), entities.to_pylist())
        return pa.array([None if a is None else bool(fn(o, a, e)) for o, a, e in rows], pa.bool_())

    return checked


def with_user_checks(variants: DataFrame, checks: Mapping[str, Callable[[Column, Column, Column], Column]]) -> DataFrame:
    """Applies user rules ``(original, augmented, augmented entities) → boolean`` to variants that the gate has passed.

    A rule is a function of columns: an expression, a pandas or Arrow function,
    or ordinary Python by way of ``python_check``. Rules run one after the other
    on the fanned-out rows; a row that is out already reaches them as NULL. The
    first one broken names the row, and a NULL result counts as broken.
    """
    for name, check in checks.items():
        seen = [F.when(F.col("quality_passed"), F.col(c)) for c in ("original_sentence", "augmented_sentence", "augmented_entities")]
        broken = F.col("quality_passed") & ~F.coalesce(check(*seen), F.lit(False))
        variants = variants.withColumn("_broken", broken).withColumns({
            "failed_rule": F.when(F.col("_broken"), name).otherwise(F.col("failed_rule")),
            "quality_passed": F.col("quality_passed") & ~F.col("_broken")}).drop("_broken")
    return variants


# --- pair checks -----------------------------------------------------------

def length_issue(original: Column, augmented: Column, settings: Settings) -> Column:
    n, m = F.char_length(original), F.char_length(augmented)
    ratio = m / F.nullif(n, F.lit(0))

    def told(what: str) -> Column:
        return F.concat(F.lit(f"Too {what} (ratio: "), two_decimals(m, n), F.lit(")"))

    return (
        F.when((F.coalesce(n, F.lit(0)) == 0) | (F.coalesce(m, F.lit(0)) == 0), "Empty text")
        .when(ratio < settings.min_length_ratio, told("short"))
        .when(ratio > settings.max_length_ratio, told("long"))
    )


def diacritics_issue(text: Column) -> Column:
    return F.when(~F.coalesce(has_diacritics(text), F.lit(False)), "No Vietnamese characters found")


def preservation_issue(before: Column, after: Column) -> Column:
    n, m = F.size(listed(before)), F.size(listed(after))
    missing = F.array_position(
        F.transform(listed(after), lambda e: F.coalesce(e["filler"], F.lit("")) == ""), True)
    return (
        F.when(n != m, F.concat(F.lit("Entity count mismatch: "), n.cast("string"), F.lit(" vs "), m.cast("string")))
        .when(types_of(before) != types_of(after), "Entity types don't match")
        .when(missing > 0, F.concat(F.lit("Entity "), (missing - 1).cast("string"), F.lit(" missing filler")))
    )


def boundary_issue(sentence: Column, entities: Column) -> Column:
    lost = F.get(F.filter(listed(entities), lambda e: (e["filler"] != "")
                          & ~F.contains(F.coalesce(sentence, F.lit("")), e["filler"])), F.lit(0))["filler"]
    return F.when(lost.isNotNull(), F.concat(F.lit("Entity '"), lost, F.lit("' not found in sentence")))


def grammar_issue(text: Column) -> Column:
    def repeated(w: Column) -> Column:
        left = F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))
        pairs = F.zip_with(left, F.slice(w, F.lit(2), F.size(w)),
                           lambda a, b: F.when((a == b) & ~a.isin(*MAY_REPEAT), a))
        return F.get(F.filter(pairs, lambda p: p.isNotNull()), F.lit(0))

    twice = let(words(F.coalesce(text, F.lit(""))), repeated)
    return (
        F.when(twice.isNotNull(), F.concat(F.lit("Repeated word: '"), twice, F.lit("'")))
        .when(F.contains(text, F.lit("  ")), "Multiple spaces detected")
        .when(text.rlike(rf"[,.!?](?<={ONE_BLANK}.)"), "Orphaned punctuation")
    )


def intent_issue(before: Column, after: Column) -> Column:
    return F.when(~before.eqNullSafe(after), F.concat(
        F.lit("Intent changed: '"), F.coalesce(before, F.lit("")),
        F.lit("' -> '"), F.coalesce(after, F.lit("")), F.lit("'")))


def pair_issues(settings: Settings) -> dict[str, Column]:
    """The six pair checks over the ``original_*`` / ``augmented_*`` columns, in report order."""
    c = F.col
    return {
        "length_ratio": length_issue(c("original_sentence"), c("augmented_sentence"), settings),
        "vietnamese_chars": diacritics_issue(c("augmented_sentence")),
        "entity_preservation": preservation_issue(c("original_entities"), c("augmented_entities")),
        "entity_boundaries": boundary_issue(c("augmented_sentence"), c("augmented_entities")),
        "basic_grammar": grammar_issue(c("augmented_sentence")),
        "intent_consistency": intent_issue(c("original_intent"), c("augmented_intent")),
    }


def _verdict(df: DataFrame, messages: Mapping[str, Column]) -> DataFrame:
    noted = df.withColumn("_said", F.struct(*[m.alias(name) for name, m in messages.items()]))
    return noted.select(
        *df.columns,
        F.array_compact(F.array(*[
            F.concat(F.lit(f"{name}: "), F.col(f"_said.{name}")) for name in messages
        ])).alias("issues"),
        F.struct(*[F.col(f"_said.{name}").isNull().alias(name) for name in messages]).alias("checks"),
    ).withColumn("valid", F.size("issues") == 0)


def validate_pairs(
    df: DataFrame, settings: Settings,
    extra_checks: Mapping[str, Callable[[], Column]] | None = None,
) -> DataFrame:
    """``valid``, ``issues`` and ``checks`` for every original–augmented pair.

    ``extra_checks`` are user checks: no-argument functions that return a
    message column over the pair's columns, NULL when the check passes.
    """
    messages = pair_issues(settings)
    messages.update({name: check() for name, check in (extra_checks or {}).items()})
    return _verdict(df, messages)


def validate_samples(df: DataFrame) -> DataFrame:
    """The two checks that a final sample allows; it counts as valid whatever they say."""
    return _verdict(df, {
        "vietnamese_chars": diacritics_issue(F.col("sentence")),
        "entity_boundaries": boundary_issue(F.col("sentence"), F.col("entities")),
    }).withColumn("valid", F.lit(True))


def failed_check_counts(validated: DataFrame) -> DataFrame:
    """How many invalid rows failed each check; checks that never failed are absent."""
    names = validated.schema["checks"].dataType.names
    failed = F.array_compact(F.array(*[F.when(~F.col(f"checks.{n}"), F.lit(n)) for n in names]))
    return (
        validated.filter("NOT valid")
        .select(F.explode(failed).alias("check"))
        .groupBy("check").agg(F.count("*").alias("n"))
    )


def issue_kind_counts(validated: DataFrame) -> DataFrame:
    """Issues by type: the message without its quoted parts, ratios and numbers."""
    kind = F.regexp_replace(F.col("issue"), r"(?s)'.*'|\(ratio.*\)|[0-9]+", "")
    return (
        validated.select(F.explode("issues").alias("issue"))
        .groupBy(F.trim(F.regexp_replace(kind, " +", " ")).alias("issue_type")).agg(F.count("*").alias("n"))
    )


def quality_summary(validated: DataFrame, sentence: str = "sentence", pairs: bool = False) -> DataFrame:
    """One row: totals, rates and, for pairs, the mean character-length ratio."""
    share = lambda n: F.coalesce(n / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0))
    passed = F.count_if("valid")
    vietnamese = F.count_if(F.coalesce(has_diacritics(F.col(sentence)), F.lit(False)))
    ratio = F.lit(None).cast("double")
    if pairs:
        ratio = F.char_length("augmented_sentence") / F.nullif(F.char_length("original_sentence"), F.lit(0))
    return validated.agg(
        F.count("*").alias("total_samples"),
        passed.alias("passed_all_checks"),
        vietnamese.alias("samples_with_vietnamese"),
        share(passed).alias("quality_rate"),
        share(vietnamese).alias("vietnamese_rate"),
        F.coalesce(F.avg(ratio), F.lit(0.0)).alias("avg_length_ratio"),
    )
