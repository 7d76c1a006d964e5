"""Label distributions, rarity and dataset statistics.

Distributions are long tables ``(dimension, label, …, n)``. One pass explodes
each utterance into its labels and counts them with map-side combining, so the
shuffle carries one row per label and task whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.entities import is_object, listed, types_of
from lexiloom.functions.text import clean_text, cleans_to_text, has_diacritics, has_text, strip
from lexiloom.schema import ENTITIES_DDL

INTENT, TYPE, PAIR = "intent", "entity_type", "entity_type_intent"


def label_counts(df: DataFrame, missing: str = "unknown", skip_blank_types: bool = False,
                 pairs: bool = True) -> DataFrame:
    """``(dimension, label, intent, n)``: intents, entity types and (type, intent) pairs.

    Intents count utterances, the other two count entities. ``missing`` names
    absent labels.
    """
    intent = F.coalesce("intent", F.lit(missing))
    types = types_of(F.col("entities"), missing)
    if skip_blank_types:
        types = F.filter(types, lambda t: t != "")
    nothing = F.lit(None).cast("string")

    def row(dimension: str, label: Column, other: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), label.alias("label"), other.alias("intent"))

    rows = F.concat(F.array(row(INTENT, intent, nothing)),
                    F.transform(types, lambda t: row(TYPE, t, nothing)))
    if pairs:
        rows = F.concat(rows, F.transform(types, lambda t: row(PAIR, t, F.coalesce("intent", F.lit(missing)))))
    return (
        df.select(F.explode(rows).alias("r")).select("r.*")
        .groupBy("dimension", "label", "intent").agg(F.count("*").alias("n"))
    )


def rarity_profile(df: DataFrame, settings: Settings) -> DataFrame:
    """``(dimension, label, n, rare)`` for intents and entity types."""
    return label_counts(df, missing="", skip_blank_types=True, pairs=False).select(
        "dimension", "label", "n",
        F.when(F.col("dimension") == INTENT, F.col("n") < settings.min_intent_frequency)
        .otherwise(F.col("n") < settings.min_entity_frequency).alias("rare"),
    )


def rarity_summary(profile: DataFrame) -> DataFrame:
    """One row of totals over a rarity profile."""
    intent = F.col("dimension") == INTENT
    return profile.agg(
        F.coalesce(F.sum(F.when(intent, F.col("n"))), F.lit(0)).alias("total_samples"),
        F.count_if(intent).alias("unique_intents"),
        F.count_if(~intent).alias("unique_entities"),
        F.count_if(intent & F.col("rare")).alias("intent_targets"),
        F.count_if(~intent & F.col("rare")).alias("entity_targets"),
    )


def distribution_summary(counts: DataFrame) -> DataFrame:
    """One row of totals over ``label_counts``."""
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("dimension") == INTENT, F.col("n"))), F.lit(0)).alias("total_samples"),
        F.count_if(F.col("dimension") == INTENT).alias("unique_intents"),
        F.count_if(F.col("dimension") == TYPE).alias("unique_entities"),
    )


def top(counts: DataFrame, k: int | None, key: str = "label") -> DataFrame:
    """Most frequent first, ties by key; all of them without ``k``."""
    ranked = counts.orderBy(F.desc("n"), F.asc(key))
    return ranked if k is None else ranked.limit(k)


def generation_statistics(variants: DataFrame, profile: DataFrame) -> DataFrame:
    """Samples tried, accepted and dropped variants and their share per method; the row without a method is the total.

    ``processed_samples`` counts the whole input, rare or not: it is read off
    ``profile``, the settled ``rarity_profile`` of the input. Every method is
    tried on every rare sample, so the total of those is that of any method.
    """
    each = variants.groupBy("method").agg(
        F.count("*").alias("tried_samples"), F.count_if("quality_passed").alias("generated"), F.count_if(~F.col("quality_passed")).alias("failed"))
    zero = F.lit(0).cast("bigint")
    # A total of zeros where nothing was generated.
    total = each.agg(F.coalesce(F.max("tried_samples"), zero).alias("tried_samples"),
                     *(F.coalesce(F.sum(c), zero).alias(c) for c in ("generated", "failed")))
    size = profile.filter(F.col("dimension") == INTENT).agg(F.sum("n")).first()[0] or 0
    tried = F.col("generated") + F.col("failed")
    rate = F.when(tried == 0, 0.0).otherwise(F.col("generated") / tried)
    rows = each.unionByName(total, allowMissingColumns=True)
    return rows.withColumns({"success_rate": rate, "processed_samples": F.lit(size).cast("bigint")})


def entity_values(df: DataFrame) -> DataFrame:
    """``(kind, value, n)`` for non-blank trimmed entity types and fillers."""
    def values(kind: str) -> Column:
        return F.transform(listed(F.col("entities")), lambda e: F.struct(
            F.lit(kind).alias("kind"), strip(F.coalesce(e[kind], F.lit(""))).alias("value")))

    return (
        df.select(F.explode(F.concat(values("type"), values("filler"))).alias("v")).select("v.*")
        .filter("value <> ''")
        .groupBy("kind", "value").agg(F.count("*").alias("n"))
    )


def entity_statistics(df: DataFrame, values: DataFrame) -> DataFrame:
    """``(metric, value)`` rows; ``values`` is the (settled) ``entity_values`` of ``df``."""
    typed = F.filter(listed(F.col("entities")), lambda e: strip(F.coalesce(e["type"], F.lit(""))) != "")
    some = F.count_if(F.size(listed(F.col("entities"))) > 0)
    totals = df.agg(
        F.sum(F.size(typed)).alias("total_entities"),
        some.alias("samples_with_entities"),
        (F.count("*") - some).alias("samples_without_entities"),
        F.avg(F.size(typed)).alias("average_entities_per_sample"),
    )
    uniques = values.agg(
        F.count_if(F.col("kind") == "type").alias("unique_entity_types"),
        F.count_if(F.col("kind") == "filler").alias("unique_entity_fillers"),
    )
    return _as_metrics(totals).unionByName(_as_metrics(uniques))


def _as_metrics(one_row: DataFrame) -> DataFrame:
    doubles = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in one_row.columns]
    return one_row.select(*doubles).unpivot([], one_row.columns, "metric", "value")


def top_values(values: DataFrame, kind: str, k: int = 20) -> DataFrame:
    return top(values.filter(F.col("kind") == kind).select("value", "n"), k, "value")


def format_issues(raw: DataFrame) -> DataFrame:
    """``(sample_id, issue_no, issue)`` over a raw scan whose ``entities`` is a VARIANT."""
    return raw.select(
        "sample_id", F.posexplode(_faults()).alias("issue_no", "issue"),
    ).withColumn("issue", F.concat(F.lit("Sample "), F.col("sample_id"), F.col("issue")))


def _items() -> Column:
    return F.coalesce(F.try_variant_get("entities", "$", "array<variant>"), F.array().cast("array<variant>"))


def _text_of(item: Column, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", "string")


def _faults() -> Column:
    def fault(item: Column, i: Column) -> Column:
        what = (
            F.when(~is_object(item), ": Not a dictionary")
            .when(~has_text(_text_of(item, "type")), ": Missing 'type'")
            .when(~has_text(_text_of(item, "filler")), ": Missing 'filler'")
        )
        return F.concat(F.lit(", Entity "), i.cast("string"), what)

    return F.array_compact(F.concat(
        F.array(
            F.when(~has_text(F.col("sentence")), ": Missing or empty 'sentence'"),
            F.when(~has_text(F.col("intent")), ": Missing or empty 'intent'"),
            F.when(F.col("entities").isNull(), ": Missing 'entities' field"),
        ),
        F.transform(_items(), fault),
    ))


def format_report(raw: DataFrame) -> DataFrame:
    """``(metric, value)`` rows of the format check; entity faults leave a sample valid."""
    good = F.filter(_items(), lambda e: is_object(e) & has_text(_text_of(e, "type")) & has_text(_text_of(e, "filler")))
    shaped = raw.select(
        has_text(F.col("sentence")).alias("s"), has_text(F.col("intent")).alias("i"),
        F.col("entities").isNotNull().alias("e"), F.size(_items()).alias("n"),
        F.transform(good, lambda e: _text_of(e, "type")).alias("types"),
    )
    totals = {
        "total_samples": F.lit(1), "valid_samples": F.col("s") & F.col("i"), "sentence_coverage": F.col("s"),
        "intent_coverage": F.col("i"), "entities_coverage": F.col("e"), "total_entities": F.size("types"),
        "samples_with_entities": F.col("n") > 0,
    }
    # One pass: the totals and the types are counted in one table, whose types are then counted themselves.
    counted = _tallied(shaped, F.concat(
        F.array(*(_tally("metric", F.lit(name), n) for name, n in totals.items())),
        F.transform("types", lambda t: _tally("type", t, F.lit(1)))))
    metric = lambda name: F.coalesce(F.sum(F.when((F.col("section") == "metric") & (F.col("key") == name), F.col("n"))), F.lit(0))
    return _as_metrics(counted.agg(*(metric(name).alias(name) for name in totals),
                                   F.count_if(F.col("section") == "type").alias("unique_entity_types")))


def label_map(df: DataFrame) -> DataFrame:
    """``(label, id)`` of the BIO tagging scheme over the sorted entity types.

    The rank runs over distinct types only, a label set.
    """
    types = df.select(F.explode(F.transform(listed(F.col("entities")), lambda e: e["type"])).alias("type")) \
        .filter("type IS NOT NULL").distinct()
    return _tags(types)


def _tags(types: DataFrame) -> DataFrame:
    ranked = types.withColumn("i", F.row_number().over(Window.orderBy("type")))
    tagged = ranked.select(F.inline(F.array(
        F.struct(F.concat(F.lit("B-"), F.col("type")).alias("label"), (F.col("i") * 2 - 1).alias("id")),
        F.struct(F.concat(F.lit("I-"), F.col("type")).alias("label"), (F.col("i") * 2).alias("id")),
    )))
    outside = types.sparkSession.range(1).select(F.lit("O").alias("label"), F.lit(0).alias("id"))
    return outside.unionByName(tagged)


def _tally(section: str, key: Column, n: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), key.alias("key"), n.cast("bigint").alias("n"))


def _tallied(df: DataFrame, tallies: Column) -> DataFrame:
    """``(section, key, n)``: what the rows tally, summed in each task before the shuffle."""
    return (df.select(F.inline(F.filter(tallies, lambda t: t["n"] > 0)))
            .groupBy("section", "key").agg(F.sum("n").alias("n")))


def audit_counts(df: DataFrame, clean: bool = False) -> DataFrame:
    """All that an audit counts of utterances, in one pass: ``(intent, marked, some, type, filler, n)``.

    A row counts utterances of an intent, with or without diacritics and
    entities, where ``marked`` is set, and else entities of a type and filler,
    as they stand. With ``clean``, ``some`` asks for entities that
    ``normalise`` keeps; diacritics are letters, which ``clean_text`` keeps.
    """
    entities = listed(F.col("entities"))
    some = F.exists(entities, lambda e: cleans_to_text(e["type"]) & cleans_to_text(e["filler"])) if clean else F.size(entities) > 0
    nothing = F.array(F.lit(None)).cast(ENTITIES_DDL)
    # The first element stands for the utterance. Columns before the explode: what stands inside a generator is interpreted.
    rows = df.select(
        F.coalesce("intent", F.lit("unknown")).alias("intent"),
        F.coalesce(has_diacritics(F.col("sentence")), F.lit(False)).alias("marked"), some.alias("some"),
        F.concat(nothing, entities).alias("items"))
    whole = F.col("i") == 0
    return (rows.select("intent", "marked", "some", F.posexplode_outer("items").alias("i", "e"))
            .groupBy(*(F.when(whole, F.col(c)).alias(c) for c in ("intent", "marked", "some")), "e.type", "e.filler")
            .agg(F.count("*").alias("n")))


def audit_tallies(counts: DataFrame, clean: bool = False) -> DataFrame:
    """``(section, key, n)`` of ``audit_counts``; with ``clean`` each different entity is cleaned, once.

    Sections are ``totals``, the labels of ``label_counts``, the values of
    ``entity_values`` (``value_type``, ``value_filler``) and the types as they
    stand (``tag``).
    """
    n, row = F.col("n"), F.col("marked").isNotNull()
    utterances = counts.filter(row).select(F.array(
        _tally("totals", F.lit("samples"), n),
        _tally("totals", F.lit("with_entities"), F.when(F.col("some"), n)),
        _tally("totals", F.lit("diacritics"), F.when(F.col("marked"), n)),
        _tally(INTENT, F.col("intent"), n)).alias("tallies"))
    entities = counts.filter(~row)
    if clean:
        entities = entities.withColumns({c: clean_text(F.col(c)) for c in ("type", "filler")}).filter("type <> '' AND filler <> ''")
    trimmed = {c: strip(F.coalesce(c, F.lit(""))) for c in ("type", "filler")}
    entities = entities.select(F.array(
        _tally("totals", F.lit("entities"), F.when(trimmed["type"] != "", n)),
        _tally(TYPE, F.coalesce("type", F.lit("unknown")), n),
        *(_tally(f"value_{c}", text, F.when(text != "", n)) for c, text in trimmed.items()),
        _tally("tag", F.col("type"), F.when(F.col("type").isNotNull(), n))).alias("tallies"))
    return (utterances.unionByName(entities).select(F.inline_outer("tallies")).filter("n > 0")
            .groupBy("section", "key").agg(F.sum("n").alias("n")))


def _total(key: str) -> Column:
    return F.coalesce(F.sum(F.when((F.col("section") == "totals") & (F.col("key") == key), F.col("n"))), F.lit(0))


def counted_values(counts: DataFrame) -> DataFrame:
    """``entity_values`` read off ``audit_tallies``."""
    return counts.filter(F.col("section").startswith("value_")).select(
        F.substring("section", 7, 100).alias("kind"), F.col("key").alias("value"), "n")


def counted_labels(counts: DataFrame) -> DataFrame:
    """Intents and types of ``label_counts``, read off ``audit_tallies``."""
    return counts.filter(F.col("section").isin(INTENT, TYPE)).select(F.col("section").alias("dimension"), F.col("key").alias("label"), "n")


def counted_label_map(counts: DataFrame) -> DataFrame:
    return _tags(counts.filter(F.col("section") == "tag").select(F.col("key").alias("type")))


def counted_statistics(counts: DataFrame) -> DataFrame:
    """``entity_statistics`` read off ``audit_tallies``."""
    samples, entities = _total("samples"), _total("entities")
    return _as_metrics(counts.agg(
        entities.alias("total_entities"),
        _total("with_entities").alias("samples_with_entities"),
        (samples - _total("with_entities")).alias("samples_without_entities"),
        (entities / F.nullif(samples, F.lit(0))).alias("average_entities_per_sample"),
        F.count_if(F.col("section") == "value_type").alias("unique_entity_types"),
        F.count_if(F.col("section") == "value_filler").alias("unique_entity_fillers"),
    ))


def counted_quality(counts: DataFrame) -> DataFrame:
    """The totals of a quality report on final samples, all of which count as valid."""
    samples, marked = _total("samples"), _total("diacritics")
    share = lambda n: F.coalesce(n / F.nullif(samples, F.lit(0)), F.lit(0.0))
    return counts.agg(samples.alias("total_samples"), samples.alias("passed_all_checks"), marked.alias("samples_with_vietnamese"),
                      share(samples).alias("quality_rate"), share(marked).alias("vietnamese_rate"))


def augmentation_ratio(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: both sizes and the growth in percent."""
    counted = before.select(F.lit(1).alias("was"), F.lit(0).alias("now")) \
        .unionByName(after.select(F.lit(0).alias("was"), F.lit(1).alias("now")))
    was, now = F.coalesce(F.sum("was"), F.lit(0)), F.coalesce(F.sum("now"), F.lit(0))
    return counted.agg(
        was.alias("input_samples"), now.alias("final_samples"),
        F.when(was > 0, (now / F.nullif(was, F.lit(0)) - 1) * 100).otherwise(0.0).alias("augmentation_ratio"),
    )
