"""Choosing rows by the rarity of their labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.config import Settings, literal
from lexiloom.functions.entities import types_of
from lexiloom.operators.profile import INTENT, TYPE
from lexiloom.session import settle

#: So many names are looked up in a literal; more of them are joined.
LITERAL_LABELS = 1_000


def _few(labels: DataFrame) -> list[str] | None:
    """The names, or None where there are more than ``LITERAL_LABELS``: one more than that is read at most."""
    names = [row["label"] for row in labels.select("label").limit(LITERAL_LABELS + 1).collect()]
    return names if len(names) <= LITERAL_LABELS else None


def _holds(names: list[str], values: Column) -> Column:
    return F.coalesce(F.arrays_overlap(values, literal(names, "array<string>")), F.lit(False)) if names else F.lit(False)


def with_any_label(df: DataFrame, intents: DataFrame | None, types: DataFrame | None, missing: str) -> DataFrame:
    """Rows whose intent is in ``intents`` or one of whose entity types is in ``types``.

    Both are ``(label)`` tables of distinct names, settled, None to ignore that
    side. A few names are looked up row by row, in one narrow pass. Many are
    matched against the different combinations of intent and types, which are
    few beside the rows; a row is then kept by its own combination.
    """
    if intents is None and types is None:
        return df.limit(0)
    named = [[] if side is None else _few(side) for side in (intents, types)]
    if None not in named:
        return df.where(_holds(named[0], F.array(F.coalesce("intent", F.lit(missing))))
                        | _holds(named[1], types_of(F.col("entities"), missing)))
    kinds = F.array_sort(F.array_distinct(types_of(F.col("entities"), missing)))
    marked = df.withColumn("_labels", F.struct(F.coalesce("intent", F.lit(missing)).alias("intent"), kinds.alias("types")))
    combinations = marked.select("_labels").distinct()
    wanted = []
    if intents is not None:
        wanted.append(combinations.join(intents, F.col("_labels.intent") == F.col("label"), "left_semi"))
    if types is not None:
        each = combinations.select("_labels", F.explode("_labels.types").alias("label"))
        wanted.append(each.join(types.select("label"), "label", "left_semi").select("_labels"))
    found = settle(reduce(DataFrame.union, wanted).distinct())
    return marked.join(found, "_labels", "left_semi").select(*df.columns)


def rare_samples(df: DataFrame, profile: DataFrame, settings: Settings) -> DataFrame:
    """Utterances worth augmenting under a settled ``rarity_profile``."""
    rare = profile.filter("rare")
    return with_any_label(
        df,
        rare.filter(F.col("dimension") == INTENT).select("label") if settings.augment_rare_intents else None,
        rare.filter(F.col("dimension") == TYPE).select("label") if settings.augment_rare_entities else None,
        missing="",
    )
