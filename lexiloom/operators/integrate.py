"""Balancing, merging and de-duplicating training sets.

Tables carry ``seq``, a total order (an orderable struct, coarse field first).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.text import strip
from lexiloom.operators import ranks
from lexiloom.operators.profile import INTENT, TYPE, distribution_summary, label_counts
from lexiloom.operators.rarity import with_any_label
from lexiloom.session import settle

STRATEGIES = ("all", "balanced", "selective")


def first_n_per_group(df: DataFrame, group: str, targets: DataFrame, order: str = "seq") -> DataFrame:
    """The first ``target`` rows of each group in ``order``; groups without a target are dropped.

    A group may hold most of the table, so no group is ever sorted in one
    place. Rows are counted per group and leading field of ``order``, and the
    limit of each group falls in one value of it; the other fields split only
    the rows under that value. Both steps find the value with ``ranks.cut``,
    whose windows have a size of their own. What comes out is the key of each
    group's last row; the table itself is then filtered against it without a
    shuffle. ``targets`` holds ``(group, target)`` with targets above zero.
    """
    first, *others = df.schema[order].dataType.names
    left = targets.select(group, F.col("target").cast("bigint").alias("_left"))
    head = df.select(group, F.col(f"{order}.{first}").alias("_head"), *([F.struct(*[f"{order}.{f}" for f in others]).alias("_rest")] if others else []))

    def counted(rows: DataFrame, value: str) -> DataFrame:
        return settle(rows.groupBy(group, value, "_left").agg(F.count("*").alias("_n")))

    found = settle(ranks.cut(counted(head.join(left, group), "_head"), group, "_head"))
    last = F.struct(F.col("_head").alias(first))
    if others:
        inside = settle(ranks.cut(counted(head.join(found, [group, "_head"]), "_rest"), group, "_rest"))
        found = inside.join(found.select(group, "_head"), group)
        last = F.struct(F.col("_head").alias(first), *[F.col(f"_rest.{f}").alias(f) for f in others])
    return df.join(found.select(group, last.alias("_last")), group).filter(F.col(order) <= F.col("_last")).select(*df.columns)


def balance_targets(original_counts: DataFrame) -> DataFrame:
    """``(intent, n, target)``: how many rows each intent of the original set should gain.

    Intents with at least half the rows of the largest one gain nothing.
    ``original_counts`` is a settled ``label_counts``.
    """
    intents = original_counts.filter(F.col("dimension") == INTENT)
    largest = intents.agg(F.max("n")).first()[0] or 0
    return intents.select(
        F.col("label").alias("intent"), "n",
        F.when(F.col("n") < largest * 0.5, largest - F.col("n")).otherwise(0).alias("target"),
    )


def first_seen(original: DataFrame) -> DataFrame:
    """``(intent, turn)``: where each intent of the original set occurs first."""
    return original.groupBy(F.coalesce("intent", F.lit("unknown")).alias("intent")).agg(F.min("seq").alias("turn"))


def balanced(augmented: DataFrame, original_counts: DataFrame,
             target_distribution: Mapping[str, int] | None = None,
             turns: DataFrame | None = None) -> DataFrame:
    """The first rows of each under-represented intent, up to its target.

    The selection goes intent by intent: in the order of ``target_distribution``,
    or else of ``turns`` (``first_seen`` of the original set). With either,
    ``seq`` gains a leading field ``turn``, so that order decides which copy a
    later de-duplication keeps.
    """
    if target_distribution:
        given = [(intent, n, i) for i, (intent, n) in enumerate(target_distribution.items())]
        targets = augmented.sparkSession.createDataFrame(given, "intent string, target bigint, turn int")
    else:
        targets = balance_targets(original_counts).select("intent", "target")
        targets = targets if turns is None else targets.join(turns, "intent")
    named = augmented.withColumn("_intent", F.coalesce("intent", F.lit("unknown")))
    wanted = targets.filter("target > 0").withColumnRenamed("intent", "_intent")
    chosen = first_n_per_group(named, "_intent", wanted.select("_intent", "target"))
    if "turn" not in wanted.columns:
        return chosen.select(*augmented.columns)
    order = F.struct("turn", *[F.col(f"seq.{f}").alias(f) for f in augmented.schema["seq"].dataType.names])
    placed = chosen.join(wanted.select("_intent", "turn"), "_intent").withColumn("seq", order)
    return placed.select(*augmented.columns)


def selective(augmented: DataFrame, original_counts: DataFrame) -> DataFrame:
    """Rows with an intent or entity type that makes up less than 5 % of the original set."""
    total = distribution_summary(original_counts).first()["total_samples"]
    rare = original_counts.filter(F.col("n") < total * 0.05)
    return with_any_label(
        augmented,
        rare.filter(F.col("dimension") == INTENT).select("label"),
        rare.filter(F.col("dimension") == TYPE).select("label"),
        missing="unknown",
    )


def balance(original_counts: DataFrame, augmented: DataFrame, settings: Settings,
            target_distribution: Mapping[str, int] | None = None,
            turns: DataFrame | None = None) -> DataFrame:
    if settings.strategy == "all":
        return augmented
    if settings.strategy == "balanced":
        return balanced(augmented, original_counts, target_distribution, turns)
    if settings.strategy == "selective":
        return selective(augmented, original_counts)
    raise ValueError(f"Unknown strategy: {settings.strategy}")


def _tag(source: str, augmented: bool):
    return F.struct(F.lit(source).alias("source"), F.lit(augmented).alias("augmented"))


def merge(original: DataFrame, augmented: DataFrame, settings: Settings) -> DataFrame:
    """Original rows (unless switched off), then augmented ones, tagged with their source.

    The tag overwrites what an original row carries, and is only added to an
    augmented row that has none. ``seq`` gains leading fields: the side and, for
    a selection made intent by intent, the intent's turn (NULL for original rows).
    """
    ordered = {f.name: f.dataType for f in augmented.schema["seq"].dataType.fields}

    def placed(df: DataFrame, side: int) -> DataFrame:
        fields = [F.col(f"seq.{f}").alias(f) for f in df.schema["seq"].dataType.names]
        if "turn" in ordered and side == 0:
            fields.insert(0, F.lit(None).cast(ordered["turn"]).alias("turn"))
        return df.withColumn("seq", F.struct(F.lit(side).alias("side"), *fields))

    first, second = placed(original, 0), placed(augmented, 1)
    if settings.add_metadata:
        first = first.withColumn("metadata", _tag("original", False))
        present = F.col("metadata") if "metadata" in second.columns else F.lit(None)
        second = second.withColumn("metadata", F.coalesce(present, _tag("augmentation", True)))
    if not settings.preserve_original:
        return second
    return first.unionByName(second, allowMissingColumns=True)


def deduplicate(df: DataFrame) -> DataFrame:
    """The first row per trimmed lower-case sentence; rows without text are dropped.

    ``row_number() = 1`` keeps one row per sentence in each map task before the
    shuffle, so copies of a hot sentence do not travel; sentences are compared
    by their SHA-256, so a text travels once at most, and not at all where the
    result lacks it.
    """
    plain = F.lower(strip(F.coalesce("sentence", F.lit(""))))
    return (
        df.filter(plain != "").withColumn("_key", F.unhex(F.sha2(plain, 256)))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_key").orderBy("seq")))
        .filter("_rank = 1").drop("_key", "_rank")
    )


def integration_summary(original_counts: DataFrame, augmented_counts: DataFrame,
                        chosen: DataFrame, final: DataFrame, settings: Settings) -> DataFrame:
    """One row of sizes, for the selected rows and the stored final set.

    The counts are settled ``label_counts``; only ``chosen`` is scanned, pruned
    to the columns that its selection reads.
    """
    def sized(df: DataFrame, size: Column, name: str) -> DataFrame:
        return df.agg(size.alias("value")).select(
            F.lit(name).alias("name"), F.coalesce("value", F.lit(0)).alias("value"))

    intents = F.sum(F.when(F.col("dimension") == INTENT, F.col("n")))
    rows = (
        sized(original_counts, intents, "original")
        .unionByName(sized(augmented_counts, intents, "augmented"))
        .unionByName(sized(chosen, F.count("*"), "selected"))
        .unionByName(sized(final, F.count("*"), "final"))
    )

    def value(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("value")))

    kept = value("original") if settings.preserve_original else F.lit(0)
    return rows.agg(
        value("original").alias("original_samples"),
        value("augmented").alias("augmented_samples"),
        value("selected").alias("selected_augmented"),
        value("final").alias("final_samples"),
        (kept + value("selected") - value("final")).alias("duplicates_removed"),
    ).withColumn("strategy_used", F.lit(settings.strategy))
