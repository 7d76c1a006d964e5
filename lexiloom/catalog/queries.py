"""One registered query per operator, with its SQL counterpart where there is one.

Every query reads the driver's tables whole. Queries about files first write
what they read, derived from those tables, into the work folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import oracles as O
from lexiloom.catalog import tables as T
from lexiloom.catalog.tables import SETTINGS
from lexiloom.config import load_settings, vocabulary_from, vocabulary_table
from lexiloom.functions.entities import normalise, parse_entities, repair_json
from lexiloom.functions.text import clean_text, has_diacritics, has_text, has_vietnamese_letters, words
from lexiloom.operators import augment, integrate, profile, quality, review, vocabulary
from lexiloom.operators.rarity import rare_samples
from lexiloom.plans import jobs, runs
from lexiloom.session import settle, work_folder
from lexiloom.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ALL_METHODS = replace(SETTINGS, max_variations=4)
#: About as many lines does a task write where their order matters.
LINES_PER_TASK = 200_000


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def flat(entities: Column | str) -> Column:
    """Entities as one comparable string."""
    return F.array_join(F.transform(entities, lambda e: F.concat_ws("=", e["type"], e["filler"])), ";")


def big(column: Column | str, name: str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint").alias(name)


def variants(spark: SparkSession, sf: str, settings=SETTINGS) -> DataFrame:
    return augment.candidates(T.utterances(spark, sf), settings)


def extra(spark: SparkSession, sf: str) -> DataFrame:
    """The accepted variants as a training set of their own, stored."""
    kept = augment.accepted(variants(spark, sf)).select(
        F.struct("seq.block", "seq.doc", "seq.sent", F.col("method_no").alias("method")).alias("seq"),
        F.col("augmented_sentence").alias("sentence"), F.col("augmented_intent").alias("intent"),
        F.col("augmented_entities").alias("entities"))
    return settle(kept)


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The utterances as a table, for jobs that pass over them several times."""
    return settle(T.utterances(spark, sf))


def originals(spark: SparkSession, sf: str) -> DataFrame:
    """The utterances in the order fields of ``extra``."""
    order = F.struct("seq.block", "seq.doc", "seq.sent", F.lit(0).alias("method"))
    return T.utterances(spark, sf).select(order.alias("seq"), "sentence", "intent", "entities")


# --- text, entities and predicates over whole texts ------------------------

@query("p8_clean_text", f"""SELECT doc_id, {O.strip(
    f"regexp_replace(regexp_replace({O.strip('text')}, '{O.WS}+', ' ', 'g'), '[^a-zA-Z0-9_ .,!?\\p{{L}}\\p{{N}}-]', '', 'g')")
    } AS cleaned FROM documents""")
def p8_clean_text(spark, sf):
    return T.documents(spark, sf, "doc_id", "text").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


_CLEAN = lambda x: O.strip(f"regexp_replace({x}, '[^a-zA-Z0-9_ .,!?\\p{{L}}\\p{{N}}-]', '', 'g')")


@query("p9_normalise_entities", O.sql(O.UTT, f"""
SELECT sample_id, {O.flat('clean')} AS entities FROM (SELECT sample_id, list_filter(list_transform(entities,
  lambda e: {{'type': {_CLEAN('e.type')}, 'filler': {_CLEAN('e.filler')}}}), lambda e: e.type <> '' AND e.filler <> '') AS clean FROM utt)"""))
def p9_normalise_entities(spark, sf):
    return T.utterances(spark, sf).select("sample_id", flat(normalise(F.col("entities"))).alias("entities"))


@query("q5_vietnamese_letters", O.sql(O.UTT, f"""
SELECT sample_id, regexp_matches(lower(sentence), '[aeiouy{O.DIA}]') AS loose FROM utt"""))
def q5_vietnamese_letters(spark, sf):
    return T.utterances(spark, sf).select("sample_id", has_vietnamese_letters(F.col("sentence")).alias("loose"))


@query("q6_coherence", O.sql(O.UTT, f"""
SELECT sample_id, NOT (n > 20 OR (n > 3 AND list_max(list_transform(list_distinct(lw), lambda x: len(list_filter(lw, lambda y: y = x)))) > n // 2)) AS coherent
FROM (SELECT sample_id, n, CASE WHEN n <= 20 THEN {O.words('lower(sentence)')} END AS lw FROM utt)"""))
def q6_coherence(spark, sf):
    low = T.utterances(spark, sf).withColumn("low", words(F.lower("sentence")))
    return low.select("sample_id", quality.coherent(F.col("low")).alias("coherent"))


@query("q8_diacritics", f"SELECT doc_id, regexp_matches(lower(text), '[{O.DIA}]') AS diacritics FROM documents")
def q8_diacritics(spark, sf):
    return T.documents(spark, sf, "doc_id", "text").select("doc_id", has_diacritics(F.col("text")).alias("diacritics"))


def pair_query(name: str, issue: str, sql: str) -> None:
    """One pair check over every turn and the turn after it, whole texts."""
    def run(spark, sf):
        return T.turn_pairs(spark, sf).select("sample_id", quality.pair_issues(SETTINGS)[issue].alias("issue"))
    query(name, O.sql(O.PAIRS, f"SELECT sample_id, {sql} AS issue FROM pairs"))(run)


_RATIO = "length(s)::DOUBLE / length(os)"
PAIR_SQL = {
    "length_ratio": f"""CASE WHEN length(os) = 0 OR length(s) = 0 THEN 'Empty text'
      WHEN {_RATIO} < 0.7 THEN printf('Too short (ratio: %.2f)', {_RATIO})
      WHEN {_RATIO} > 2.0 THEN printf('Too long (ratio: %.2f)', {_RATIO}) END""",
    "vietnamese_chars": f"CASE WHEN NOT regexp_matches(lower(s), '[{O.DIA}]') THEN 'No Vietnamese characters found' END",
    "entity_preservation": """CASE WHEN len(oe) <> len(e) THEN 'Entity count mismatch: ' || len(oe) || ' vs ' || len(e)
      WHEN list_transform(oe, lambda x: x.type) <> list_transform(e, lambda x: x.type) THEN 'Entity types don''t match'
      WHEN list_position(list_transform(e, lambda x: x.filler = ''), true) > 0
        THEN 'Entity ' || (list_position(list_transform(e, lambda x: x.filler = ''), true) - 1) || ' missing filler' END""",
    "entity_boundaries": """(SELECT 'Entity ''' || f[1].filler || ''' not found in sentence'
      FROM (SELECT list_filter(e, lambda x: x.filler <> '' AND NOT contains(s, x.filler)) AS f) WHERE len(f) > 0)""",
    "basic_grammar": f"""CASE WHEN len(rep(s)) > 0 THEN 'Repeated word: ''' || rep(s)[1] || ''''
      WHEN contains(s, '  ') THEN 'Multiple spaces detected'
      WHEN regexp_matches(s, '{O.WS}[,.!?]') THEN 'Orphaned punctuation' END""",
    "intent_consistency": "CASE WHEN oi <> i THEN 'Intent changed: ''' || oi || ''' -> ''' || i || '''' END",
}
_REP = (f"list_transform(list_filter(list_zip({O.words('s')}, ({O.words('s')})[2:]), lambda p: p[1] = p[2] "
        f"AND p[1] NOT IN ('của', 'và', 'là', 'có')), lambda p: p[1])")
PAIR_SQL["basic_grammar"] = PAIR_SQL["basic_grammar"].replace("rep(s)", f"({_REP})")

pair_query("q7_length_ratio", "length_ratio", PAIR_SQL["length_ratio"])
pair_query("q8_pair_diacritics", "vietnamese_chars", PAIR_SQL["vietnamese_chars"])
pair_query("q9_entity_preservation", "entity_preservation", PAIR_SQL["entity_preservation"])
pair_query("q10_entity_boundaries", "entity_boundaries", PAIR_SQL["entity_boundaries"])
pair_query("q11_basic_grammar", "basic_grammar", PAIR_SQL["basic_grammar"])
pair_query("q12_intent_consistency", "intent_consistency", PAIR_SQL["intent_consistency"])

_CHECKS = ",\nchecked AS (SELECT *, " + ", ".join(f"{sql} AS {name}" for name, sql in PAIR_SQL.items()) + " FROM pairs)"
CHECKED = O.PAIRS + _CHECKS
CHECKED_VARIANTS = O.CAND + """,
pairs AS (SELECT sample_id, method, sentence AS os, a AS s, intent AS oi, intent AS i, entities AS oe, ae AS e
  FROM variants WHERE failed_rule IS NULL)""" + _CHECKS
_SAID = ", ".join(f"CASE WHEN {name} IS NOT NULL THEN '{name}: ' || {name} END" for name in PAIR_SQL)
_FINE = " AND ".join(f"{name} IS NULL" for name in PAIR_SQL)


@query("q12_validate_pairs", O.sql(CHECKED, f"""
SELECT sample_id, {_FINE} AS valid, array_to_string(list_filter([{_SAID}], lambda x: x IS NOT NULL), ' | ') AS issues,
  length_ratio IS NULL AS length_ok, basic_grammar IS NULL AS grammar_ok FROM checked"""))
def q12_validate_pairs(spark, sf):
    return quality.validate_pairs(T.turn_pairs(spark, sf), SETTINGS).select(
        "sample_id", "valid", F.array_join("issues", " | ").alias("issues"),
        F.col("checks.length_ratio").alias("length_ok"), F.col("checks.basic_grammar").alias("grammar_ok"))


@query("q12_validate_variants", O.sql(CHECKED_VARIANTS, f"""
SELECT sample_id, method, {_FINE} AS valid, array_to_string(list_filter([{_SAID}], lambda x: x IS NOT NULL), ' | ') AS issues FROM checked"""))
def q12_validate_variants(spark, sf):
    checked = quality.validate_pairs(augment.accepted(variants(spark, sf)), SETTINGS)
    return checked.select("sample_id", "method", "valid", F.array_join("issues", " | ").alias("issues"))


@query("q13_dataset_quality", O.sql(CHECKED, f"""
SELECT count(*) AS total_samples, count(*) FILTER (WHERE {_FINE}) AS passed_all_checks,
  count(*) FILTER (WHERE vietnamese_chars IS NULL) AS samples_with_vietnamese,
  count(*) FILTER (WHERE {_FINE})::DOUBLE / count(*) AS quality_rate,
  count(*) FILTER (WHERE vietnamese_chars IS NULL)::DOUBLE / count(*) AS vietnamese_rate,
  round(avg({_RATIO}), 6) AS avg_length_ratio FROM checked"""))
def q13_dataset_quality(spark, sf):
    checked = quality.validate_pairs(T.turn_pairs(spark, sf), SETTINGS)
    return quality.quality_summary(checked, "augmented_sentence", pairs=True).withColumn(
        "avg_length_ratio", F.round("avg_length_ratio", 6))


@query("q13_failed_checks", O.sql(CHECKED, " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) AS n FROM checked WHERE {name} IS NOT NULL HAVING count(*) > 0"
    for name in PAIR_SQL)))
def q13_failed_checks(spark, sf):
    checked = quality.validate_pairs(T.turn_pairs(spark, sf), SETTINGS)
    return quality.failed_check_counts(checked).withColumnRenamed("check", "check_name")


@query("q13_issues_by_type", O.sql(CHECKED, f"""
SELECT trim(regexp_replace(regexp_replace(issue, '(?s)''.*''|\\(ratio.*\\)|[0-9]+', '', 'g'), ' +', ' ', 'g')) AS issue_type, count(*) AS n
FROM (SELECT unnest([{_SAID}]) AS issue FROM checked) WHERE issue IS NOT NULL GROUP BY 1"""))
def q13_issues_by_type(spark, sf):
    return quality.issue_kind_counts(quality.validate_pairs(T.turn_pairs(spark, sf), SETTINGS))


@query("q13_final_samples", f"""WITH {O.UTT}
SELECT count(*) AS total_samples, count(*) AS passed_all_checks,
  count(*) FILTER (WHERE regexp_matches(lower(sentence), '[{O.DIA}]')) AS samples_with_vietnamese,
  count(*) FILTER (WHERE regexp_matches(lower(sentence), '[{O.DIA}]'))::DOUBLE / count(*) AS vietnamese_rate FROM utt""")
def q13_final_samples(spark, sf):
    checked = quality.validate_samples(T.utterances(spark, sf))
    return quality.quality_summary(checked).select(
        "total_samples", "passed_all_checks", "samples_with_vietnamese", "vietnamese_rate")


# --- rewriting -------------------------------------------------------------

def rewrite_query(name: str, method: str, ctes: str, table: str) -> None:
    def run(spark, sf):
        return augment.rewrite(T.utterances(spark, sf), method, SETTINGS).select(
            "sample_id", "augmented_sentence", flat("augmented_entities").alias("augmented_entities"))
    query(name, O.sql(O.UTT + ",\n" + ctes, f"""
SELECT sample_id, a AS augmented_sentence, {O.flat('ae')} AS augmented_entities FROM {table}"""))(run)


rewrite_query("a3_synonym_replacement", "synonym_replacement", O.SYN, "m_synonym")
rewrite_query("a6_politeness", "politeness_addition", O.POLITE, "m_polite")
rewrite_query("a7_restructure", "sentence_restructuring", O.MOVED, "m_moved")
rewrite_query("a8_time_variation", "time_variation", O.TIMED, "m_time")


def _found(e: str, i: int) -> str:
    return f"CASE WHEN len(entities) >= {i + 1} THEN coalesce({O._entity_synonym(e, f'entity{i}')}, '-') END"


@query("a4_entity_synonym", O.sql(O.UTT, f"""
SELECT sample_id, array_to_string(list_filter([{', '.join(_found(f'entities[{i + 1}]', i) for i in range(3))}], lambda x: x IS NOT NULL), ';') AS synonyms FROM utt"""))
def a4_entity_synonym(spark, sf):
    found = augment.entity_synonyms(F.col("entities"), F.col("sample_id"), SETTINGS)
    return T.utterances(spark, sf).select("sample_id", F.array_join(
        F.transform(found, lambda e: F.coalesce(e["synonym"], F.lit("-"))), ";").alias("synonyms"))


@query("a5_action_word", O.sql(O.UTT, f"""
SELECT sample_id, array_to_string(CASE WHEN spot = 0 THEN sw ELSE list_concat(list_concat(sw[1:spot - 1], [{O._ACTION}]), sw[spot + 1:]) END, ' ') AS replaced
FROM (SELECT *, coalesce({O._ACTION_AT}, 0) AS spot FROM (SELECT sample_id, w AS sw FROM utt))"""))
def a5_action_word(spark, sf):
    return augment.replace_action(T.utterances(spark, sf), SETTINGS).select("sample_id", "replaced")


@query("a9_time_lookup", O.sql(O.UTT, f"""
SELECT sample_id, array_to_string(list_filter([{', '.join(
    f"CASE WHEN len(entities) >= {i + 1} THEN coalesce({O._time_of(f'entities[{i + 1}]', f'entity{i}')}, '-') END" for i in range(3))}], lambda x: x IS NOT NULL), ';') AS variations FROM utt"""))
def a9_time_lookup(spark, sf):
    found = augment.time_synonyms(F.col("entities"), F.col("sample_id"), SETTINGS)
    return T.utterances(spark, sf).select("sample_id", F.array_join(
        F.transform(found, lambda e: F.coalesce(e["variation"], F.lit("-"))), ";").alias("variations"))


@query("a1_variants", O.sql(O.CAND4, f"""
SELECT sample_id, method, a AS augmented_sentence, {O.flat('ae')} AS augmented_entities, intent AS augmented_intent,
  failed_rule IS NULL AS quality_passed FROM variants"""))
def a1_variants(spark, sf):
    return variants(spark, sf, ALL_METHODS).select(
        "sample_id", "method", "augmented_sentence", flat("augmented_entities").alias("augmented_entities"),
        "augmented_intent", "quality_passed")


@query("a2_variant_metadata", O.sql(O.CAND, """
SELECT sample_id, method, n AS original_length, an AS augmented_length, an::DOUBLE / n AS length_ratio,
  len(ae) = len(entities) AS entity_count_preserved FROM variants"""))
def a2_variant_metadata(spark, sf):
    return variants(spark, sf).select(
        "sample_id", "method", big("metadata.original_length", "original_length"),
        big("metadata.augmented_length", "augmented_length"),
        F.col("metadata.length_ratio").alias("length_ratio"),
        F.col("metadata.entity_count_preserved").alias("entity_count_preserved"))


@query("a1_issues", O.sql(O.CAND, """
SELECT sample_id, sentence AS original_sentence, a AS augmented_sentence, method, 'quality_check_failed' AS reason, failed_rule
FROM variants WHERE failed_rule IS NOT NULL"""))
def a1_issues(spark, sf):
    return augment.rejected(variants(spark, sf)).select(
        "sample_id", "original_sentence", "augmented_sentence", "method", "reason", "failed_rule")


@query("q1_gate_rules", O.sql(O.CAND4, """
SELECT method, coalesce(failed_rule, 'passed') AS rule, count(*) AS n FROM variants GROUP BY 1, 2"""))
def q1_gate_rules(spark, sf):
    return variants(spark, sf, ALL_METHODS).groupBy(
        "method", F.coalesce("failed_rule", F.lit("passed")).alias("rule")).agg(F.count("*").alias("n"))


@query("q2_q3_q4_pair_gate", O.sql(O.PAIRS, f"""
SELECT sample_id, {O.strip('s')} <> '' AND s <> os AS changed, an::DOUBLE / on_ BETWEEN 0.7 AND 2.0 AS words_in_range,
  list_sort(list_transform(oe, lambda x: x.type)) = list_sort(list_transform(e, lambda x: x.type)) AS same_types
FROM (SELECT *, len({O.words('s')}) AS an, len({O.words('os')}) AS on_ FROM pairs)"""))
def q2_q3_q4_pair_gate(spark, sf):
    ratio = F.size(words(F.col("augmented_sentence"))) / F.size(words(F.col("original_sentence")))
    return T.turn_pairs(spark, sf).select(
        "sample_id",
        (has_text(F.col("augmented_sentence")) & (F.col("augmented_sentence") != F.col("original_sentence"))).alias("changed"),
        ratio.between(SETTINGS.min_length_ratio, SETTINGS.max_length_ratio).alias("words_in_range"),
        quality.same_types_sorted(F.col("original_entities"), F.col("augmented_entities")).alias("same_types"))


def quoted(sentence, entities, sample, settings):
    """A user's own rewriting method: the sentence between guillemets."""
    return F.struct(F.concat(F.lit("« "), sentence, F.lit(" »")).alias("sentence"), entities.alias("entities"))


@query("x1_custom_method", O.sql(O.UTT, f"""
SELECT sample_id, 'quoted' AS method, '« ' || sentence || ' »' AS augmented_sentence, {O.flat('entities')} AS augmented_entities,
  n + 2 AS augmented_length FROM utt"""))
def x1_custom_method(spark, sf):
    own = replace(SETTINGS, methods=("quoted",))
    found = augment.candidates(T.utterances(spark, sf), own, extra_methods={"quoted": quoted})
    return found.select("sample_id", "method", "augmented_sentence", flat("augmented_entities").alias("augmented_entities"),
                        big("metadata.augmented_length", "augmented_length"))


@query("x2_custom_check", O.sql(O.CAND, """
SELECT sample_id, method, CASE WHEN failed_rule IS NULL AND contains(a, 'Please') THEN 'no_please' ELSE failed_rule END AS failed_rule FROM variants"""))
def x2_custom_check(spark, sf):
    checks = {"no_please": lambda original, augmented, entities: ~F.contains(augmented, F.lit("Please"))}
    return augment.candidates(T.utterances(spark, sf), SETTINGS, extra_checks=checks).select(
        "sample_id", "method", "failed_rule")


def _polite(original: str, augmented: str, entities: list[dict]) -> bool:
    return "Please" not in augmented and len(entities) < 3


@query("x2_python_check", O.sql(O.CAND, """
SELECT sample_id, method, CASE WHEN failed_rule IS NULL AND (contains(a, 'Please') OR len(ae) >= 3) THEN 'user_rule' ELSE failed_rule END AS failed_rule,
  failed_rule IS NULL AND NOT contains(a, 'Please') AND len(ae) < 3 AS quality_passed FROM variants"""))
def x2_python_check(spark, sf):
    """An ordinary Python function as a check."""
    found = augment.candidates(T.utterances(spark, sf), SETTINGS, extra_checks={"user_rule": quality.python_check(_polite)})
    return found.select("sample_id", "method", "failed_rule", "quality_passed")


@query("x3_extended_vocabulary", O.sql(O.UTT, f"""
SELECT sample_id, array_to_string(list_filter([{', '.join(
    f"CASE WHEN len(entities) >= {i + 1} THEN CASE WHEN contains(lower(entities[{i + 1}].type), 'device') AND contains(lower(entities[{i + 1}].filler), 'zu') AND NOT ({' OR '.join(f"contains(lower(entities[{i + 1}].filler), {O.q(t)}) OR lower(entities[{i + 1}].filler) IN ({', '.join(O.q(x) for x in s)})" for t, s in O.VOCABULARY.devices.items())}) THEN 'nach' ELSE '-' END END" for i in range(3))}], lambda x: x IS NOT NULL), ';') AS added FROM utt"""))
def x3_extended_vocabulary(spark, sf):
    longer = SETTINGS.vocabulary.extended("devices", {"zu": ["nach"]})
    table = vocabulary_table(spark, longer)
    own = replace(SETTINGS, vocabulary=vocabulary_from(table))
    found = augment.entity_synonyms(F.col("entities"), F.col("sample_id"), own)
    return T.utterances(spark, sf).select("sample_id", F.array_join(F.transform(
        found, lambda e: F.when(e["synonym"] == "nach", e["synonym"]).otherwise("-")), ";").alias("added"))


_TERMS = [(i, t) for i, t in enumerate(dict(O.VOCABULARY.devices))]


@query("n2_vocabulary_lookup", O.sql(O.UTT, f"""
SELECT filler, arg_min(original, ord) AS original, min(ord) AS ord FROM (SELECT DISTINCT e.filler AS filler FROM (SELECT unnest(entities) AS e FROM utt))
JOIN (VALUES {', '.join(f"({i}::BIGINT, {O.q(t)})" for i, t in _TERMS)}) v(ord, original) ON contains(lower(filler), original) GROUP BY 1"""))
def n2_vocabulary_lookup(spark, sf):
    fillers = T.utterances(spark, sf).select(F.explode(F.transform("entities", lambda e: e["filler"])).alias("filler"))
    terms = vocabulary_table(spark, SETTINGS.vocabulary).filter("kind = 'devices'")
    return vocabulary.lookup_terms(fillers, terms, "filler").select("filler", "original", big("ord", "ord"))


@query("n2_long_vocabulary", O.sql(O.TURNS + """,
terms AS (SELECT original, -length(original) AS ord FROM (
  SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS original FROM benchmark UNION SELECT 'q') WHERE length(original) > 3 OR original = 'q')""", """
SELECT text, arg_min(original, (ord, original)) AS original, min(ord) AS ord
FROM (SELECT DISTINCT sentence AS text FROM turns) JOIN terms ON contains(lower(text), original) GROUP BY 1"""))
def n2_long_vocabulary(spark, sf):
    """All words of the benchmark items, longest first, and one letter."""
    words_of = T.load(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("original")).filter(F.char_length("original") > 3)
    terms = words_of.union(spark.range(1).select(F.lit("q"))).distinct().select("original", (-F.char_length("original")).alias("ord"))
    return vocabulary.lookup_terms(T.turns(spark, sf), terms, "sentence").withColumnRenamed("sentence", "text")


# --- profiles --------------------------------------------------------------

def frequent(spark, sf, several_passes: bool = True):
    """Settings whose thresholds follow the number of documents, so that both kinds of label occur at any size."""
    n = T.load(spark, sf, "documents").count()
    u = stored(spark, sf) if several_passes else T.utterances(spark, sf)
    return u, replace(SETTINGS, min_intent_frequency=n * 2, min_entity_frequency=n * 2 // 5)


_RARE = """labels AS (
  SELECT 'intent' AS dimension, intent AS label, count(*) AS n FROM utt GROUP BY 2
  UNION ALL SELECT 'entity_type', e.type, count(*) FROM (SELECT unnest(entities) AS e FROM utt) GROUP BY 2),
rarity AS (SELECT dimension, label, n, n < CASE dimension WHEN 'intent' THEN t * 2 ELSE t * 2 // 5 END AS rare
  FROM labels, (SELECT count(*) AS t FROM documents))"""


@query("g1_rarity_profile", O.sql(O.UTT + ",\n" + _RARE, "SELECT dimension, label, n, rare FROM rarity"))
def g1_rarity_profile(spark, sf):
    u, settings = frequent(spark, sf, several_passes=False)
    return profile.rarity_profile(u, settings)


@query("s4_settings_file", O.sql(O.UTT + ",\n" + _RARE.replace("t * 2 // 5", "t * 3 // 5"), "SELECT dimension, label, n, rare FROM rarity"))
def s4_settings_file(spark, sf):
    """Thresholds from a settings file that has sections without content."""
    n, path = T.load(spark, sf, "documents").count(), work_folder(spark)
    text = (f"vocabularies:\nquality_control:\naugmentation:\n  min_intent_frequency: {n * 2}\n  min_entity_frequency: {n * 3 // 5}\n"
            "  sample_augmentation_methods:\n")
    spark.range(1).select(F.lit(text)).write.text(path)
    return profile.rarity_profile(T.utterances(spark, sf), load_settings(spark, f"{path}/part-*"))


@query("g1_rarity_summary", O.sql(O.UTT + ",\n" + _RARE, """
SELECT (SELECT count(*) FROM utt) AS total_samples, """ + O.counted(
    ("unique_intents", "dimension = 'intent'"), ("unique_entities", "dimension <> 'intent'"),
    ("intent_targets", "dimension = 'intent' AND rare"), ("entity_targets", "dimension <> 'intent' AND rare")) + " FROM rarity"))
def g1_rarity_summary(spark, sf):
    u, settings = frequent(spark, sf, several_passes=False)
    return profile.rarity_summary(profile.rarity_profile(u, settings))


@query("p2_rare_samples", O.sql(O.UTT + ",\n" + _RARE, """
SELECT sample_id FROM utt WHERE intent IN (SELECT label FROM rarity WHERE dimension = 'intent' AND rare)
  OR list_has_any(list_transform(entities, lambda e: e.type), (SELECT list(label) FROM rarity WHERE dimension = 'entity_type' AND rare))"""))
def p2_rare_samples(spark, sf):
    u, settings = frequent(spark, sf)
    return rare_samples(u, settle(profile.rarity_profile(u, settings)), settings).select("sample_id")


@query("g2_distribution", O.sql(O.UTT, O.label_counts("utt")))
def g2_distribution(spark, sf):
    return profile.label_counts(T.utterances(spark, sf))


@query("g3_generation_statistics", O.sql(O.CAND4, """
SELECT method, (SELECT count(*) FROM utt) AS processed_samples, count(DISTINCT sample_id) AS tried_samples,
  count(*) FILTER (WHERE failed_rule IS NULL) AS generated, count(*) FILTER (WHERE failed_rule IS NOT NULL) AS failed,
  count(*) FILTER (WHERE failed_rule IS NULL)::DOUBLE / count(*) AS success_rate FROM variants GROUP BY ROLLUP (method)"""))
def g3_generation_statistics(spark, sf):
    u, settings = frequent(spark, sf)
    return profile.generation_statistics(augment.candidates(u, ALL_METHODS), settle(profile.rarity_profile(u, settings)))


_VALUES = """vals AS (SELECT kind, value, count(*) AS n FROM (
  SELECT 'type' AS kind, e.type AS value FROM (SELECT unnest(entities) AS e FROM utt)
  UNION ALL SELECT 'filler', e.filler FROM (SELECT unnest(entities) AS e FROM utt)) GROUP BY 1, 2)"""


@query("g4_entity_statistics", O.sql(O.UTT + ",\n" + _VALUES, """
SELECT 'total_entities' AS metric, sum(len(entities))::DOUBLE AS value FROM utt
UNION ALL SELECT 'samples_with_entities', count(*) FILTER (WHERE len(entities) > 0)::DOUBLE FROM utt
UNION ALL SELECT 'samples_without_entities', count(*) FILTER (WHERE len(entities) = 0)::DOUBLE FROM utt
UNION ALL SELECT 'average_entities_per_sample', sum(len(entities))::DOUBLE / count(*) FROM utt
UNION ALL SELECT 'unique_entity_types', count(*) FILTER (WHERE kind = 'type')::DOUBLE FROM vals
UNION ALL SELECT 'unique_entity_fillers', count(*) FILTER (WHERE kind = 'filler')::DOUBLE FROM vals"""))
def g4_entity_statistics(spark, sf):
    u = T.utterances(spark, sf)
    return profile.entity_statistics(u, settle(profile.entity_values(u)))


@query("t1_top_fillers", O.sql(O.UTT + ",\n" + _VALUES,
       "SELECT value, n FROM vals WHERE kind = 'filler' ORDER BY n DESC, value LIMIT 20"))
def t1_top_fillers(spark, sf):
    return profile.top_values(profile.entity_values(T.utterances(spark, sf)), "filler", 20)


@query("g6_label_map", O.sql(O.UTT, """
SELECT tag || type AS label, i * 2 - (tag = 'B-')::BIGINT AS id FROM (
  SELECT type, row_number() OVER (ORDER BY type) AS i FROM (SELECT DISTINCT e.type AS type FROM (SELECT unnest(entities) AS e FROM utt))),
  (VALUES ('B-'), ('I-')) v(tag)
UNION ALL SELECT 'O', 0"""))
def g6_label_map(spark, sf):
    return profile.label_map(T.utterances(spark, sf)).select("label", big("id", "id"))


@query("g9_augmentation_ratio", O.sql(O.CAND, """
SELECT (SELECT count(*) FROM utt) AS input_samples, count(*) AS final_samples,
  (count(*)::DOUBLE / (SELECT count(*) FROM utt) - 1) * 100 AS augmentation_ratio FROM variants WHERE failed_rule IS NULL"""))
def g9_augmentation_ratio(spark, sf):
    return profile.augmentation_ratio(T.utterances(spark, sf), augment.accepted(variants(spark, sf)))


# --- balancing and merging -------------------------------------------------

_SETS = O.CAND + ",\n" + O.EXTRA
_TARGETS = """original_counts AS (SELECT intent, count(*) AS n FROM utt GROUP BY 1),
targets AS (SELECT intent, n, CASE WHEN n < m * 0.5 THEN m - n ELSE 0 END AS target
  FROM original_counts, (SELECT max(n) AS m FROM original_counts))"""
_BALANCED = _SETS + ",\n" + _TARGETS + """,
turns AS (SELECT intent, row_number() OVER (ORDER BY place) AS turn FROM (
  SELECT intent, min(doc_id * 1000000 + sent_no) AS place FROM utt GROUP BY 1)),
chosen AS (SELECT * FROM (SELECT extra.*, target, turn, row_number() OVER (PARTITION BY intent ORDER BY doc_id, sent_no, method_no) AS rn
  FROM extra JOIN targets USING (intent) JOIN turns USING (intent)) WHERE rn <= target)"""
_SELECTIVE = _SETS + """,
chosen AS (SELECT *, 0 AS turn FROM extra WHERE
  intent IN (SELECT intent FROM utt GROUP BY 1 HAVING count(*) < (SELECT count(*) FROM utt) * 0.05)
  OR list_has_any(list_transform(entities, lambda e: e.type), (SELECT list(t) FROM (
    SELECT t FROM (SELECT unnest(list_transform(entities, lambda e: e.type)) AS t FROM utt) GROUP BY 1
    HAVING count(*) < (SELECT count(*) FROM utt) * 0.05))))"""
_MERGED = """,
merged AS (
  SELECT 0 AS side, 0 AS turn, doc_id, sent_no, 0 AS method_no, sentence, intent, entities, 'original' AS source FROM utt
  UNION ALL SELECT 1, turn, doc_id, sent_no, method_no, sentence, intent, entities, 'augmentation' FROM chosen),
final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(sentence) ORDER BY side, turn, doc_id, sent_no, method_no) AS k
  FROM merged) WHERE k = 1)"""
_KEYS = "doc_id, sent_no, method_no, sentence, intent"


def keyed(df: DataFrame) -> DataFrame:
    return df.select(F.col("seq.doc").alias("doc_id"), big("seq.sent", "sent_no"), big("seq.method", "method_no"),
                     "sentence", "intent")


def settled_counts(df: DataFrame) -> DataFrame:
    return settle(profile.label_counts(df))


@query("n3_balance_targets", O.sql(O.UTT + ",\n" + _TARGETS, "SELECT intent, n, target FROM targets"))
def n3_balance_targets(spark, sf):
    return integrate.balance_targets(settled_counts(originals(spark, sf)))


@query("u3_all", O.sql(_SETS, f"SELECT {_KEYS} FROM extra"))
def u3_all(spark, sf):
    return keyed(integrate.balance(settled_counts(originals(spark, sf)), extra(spark, sf), replace(SETTINGS, strategy="all")))


@query("u4_balanced", O.sql(_BALANCED, f"SELECT {_KEYS} FROM chosen"))
def u4_balanced(spark, sf):
    return keyed(integrate.balance(settled_counts(originals(spark, sf)), extra(spark, sf), SETTINGS))


@query("w1_first_n_given_targets", O.sql(_SETS, f"""
SELECT {_KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY doc_id, sent_no, method_no) AS rn FROM extra)
WHERE rn <= CASE intent WHEN 'en/long' THEN 1234 WHEN 'fr/short' THEN 77 WHEN 'es/medium' THEN 1 ELSE 0 END"""))
def w1_first_n_given_targets(spark, sf):
    wanted = {"en/long": 1234, "fr/short": 77, "es/medium": 1, "absent": 5}
    return keyed(integrate.balance(settled_counts(originals(spark, sf)), extra(spark, sf), SETTINGS, wanted))


@query("u5_selective", O.sql(_SELECTIVE, f"SELECT {_KEYS} FROM chosen"))
def u5_selective(spark, sf):
    return keyed(integrate.balance(settled_counts(originals(spark, sf)), extra(spark, sf), replace(SETTINGS, strategy="selective")))


@query("u1_p10_merge_tagged", O.sql(_SELECTIVE + _MERGED, f"SELECT side, {_KEYS}, source, source <> 'original' AS augmented FROM merged"))
def u1_p10_merge_tagged(spark, sf):
    first = settle(originals(spark, sf))
    settings = replace(SETTINGS, strategy="selective")
    merged = integrate.merge(first, integrate.balance(settled_counts(first), extra(spark, sf), settings), settings)
    return merged.select(
        big("seq.side", "side"), F.col("seq.doc").alias("doc_id"), big("seq.sent", "sent_no"), big("seq.method", "method_no"),
        "sentence", "intent", "metadata.source", "metadata.augmented")


@query("u2_deduplicate", O.sql(O.UTT, """
SELECT doc_id, sent_no, sentence, intent FROM (SELECT *, row_number() OVER (PARTITION BY lower(sentence) ORDER BY doc_id, sent_no) AS k FROM utt) WHERE k = 1"""))
def u2_deduplicate(spark, sf):
    return integrate.deduplicate(T.utterances(spark, sf)).select(
        F.col("seq.doc").alias("doc_id"), big("seq.sent", "sent_no"), "sentence", "intent")


@query("w2_deduplicate_documents", f"""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lower({O.strip('text')}) ORDER BY doc_id) AS k FROM documents
WHERE {O.strip('text')} <> '') WHERE k = 1""")
def w2_deduplicate_documents(spark, sf):
    whole = T.load(spark, sf, "documents").select(F.struct("doc_id").alias("seq"), F.col("text").alias("sentence"))
    return integrate.deduplicate(whole).select("seq.doc_id")


def merge_query(name: str, strategy: str, ctes: str) -> None:
    def run(spark, sf):
        result = jobs.merge_augmented(settle(originals(spark, sf)), extra(spark, sf), replace(SETTINGS, strategy=strategy))
        return result.final.select(
            F.col("seq.doc").alias("doc_id"), big("seq.sent", "sent_no"), big("seq.method", "method_no"),
            "sentence", "intent", flat("entities").alias("entities"), "metadata.source")
    query(name, O.sql(ctes + _MERGED, f"SELECT {_KEYS}, {O.flat('entities')} AS entities, source FROM final"))(run)


merge_query("j3_merge_all", "all", _SETS + ",\nchosen AS (SELECT *, 0 AS turn FROM extra)")
merge_query("j3_merge_balanced", "balanced", _BALANCED)
merge_query("j3_merge_selective", "selective", _SELECTIVE)


@query("g10_integration_summary", O.sql(_BALANCED + _MERGED, """
SELECT (SELECT count(*) FROM utt) AS original_samples, (SELECT count(*) FROM extra) AS augmented_samples,
  (SELECT count(*) FROM chosen) AS selected_augmented, (SELECT count(*) FROM final) AS final_samples,
  (SELECT count(*) FROM merged) - (SELECT count(*) FROM final) AS duplicates_removed, 'balanced' AS strategy_used"""))
def g10_integration_summary(spark, sf):
    return jobs.merge_augmented(settle(originals(spark, sf)), extra(spark, sf), SETTINGS).summary


# --- review ----------------------------------------------------------------

@query("p3_approval", O.sql(O.REVIEW, """
SELECT sid AS sample_id, yes AS explicit_yes, no AS explicit_no, ok AS score_ok, approved, rejected FROM decided"""))
def p3_approval(spark, sf):
    return review.with_decision(T.reviews(spark, sf), SETTINGS).select(
        F.col("Sample_ID").alias("sample_id"), "explicit_yes", "explicit_no", "score_ok", "approved", "rejected")


@query("p4_min_scores", O.sql(O.REVIEW, """
SELECT sid AS sample_id FROM scored WHERE CASE WHEN coalesce(qs, '') = '' THEN 0 ELSE qn END >= 2
  AND CASE WHEN coalesce(ns, '') = '' THEN 0 ELSE nn END >= 0"""))
def p4_min_scores(spark, sf):
    return review.filter_by_scores(T.reviews(spark, sf), 2.0, 0.0).select(F.col("Sample_ID").alias("sample_id"))


def final_query(name: str, strategy: str, mask: str) -> None:
    def run(spark, sf):
        f = review.final_samples(T.reviews(spark, sf), SETTINGS, strategy)
        return f.select(
            big("sample_id", "sample_id"), "original_intent", "augmented_sentence",
            flat("original_entities").alias("original_entities"), flat("augmented_entities").alias("augmented_entities"),
            "augmentation_method", big("quality_score", "quality_score"), big("naturalness_score", "naturalness_score"), "approved")
    query(name, O.sql(O.FINAL, f"""
SELECT doc_id AS sample_id, oi AS original_intent, s AS augmented_sentence, source_entity AS original_entities, ef AS augmented_entities,
  m AS augmentation_method, trunc(qn)::BIGINT AS quality_score, trunc(nn)::BIGINT AS naturalness_score, yes AS approved
FROM final WHERE {mask}"""))(run)


final_query("p5_final_samples", "balanced", "approved")
final_query("p5_final_explicit", "all_approved", "yes")
final_query("p5_final_scores", "score_only", "ok")


@query("p6_parse_entities", """WITH t AS (
  SELECT event_id, CASE event_id % 8 WHEN 0 THEN '[' || props || ']' WHEN 1 THEN '[{k: ' || regexp_extract(props, '(\\d+)', 1) || '}]'
    WHEN 2 THEN '"[{type: ' || event_type || ', filler: ' || regexp_extract(props, '(\\d+)', 1) || ' }]"' WHEN 4 THEN '[{k: 1' WHEN 5 THEN '  ' WHEN 3 THEN '[{a} {b}]' WHEN 6 THEN '[{ok : true}]' END AS text FROM events)
SELECT event_id, coalesce(trim(text), '') = '' OR json_valid(text) AS ok,
  CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END AS n_entities FROM t""")
def p6_parse_entities(spark, sf):
    parsed = T.entity_texts(spark, sf).withColumn("p", parse_entities(F.col("text")))
    return parsed.select("event_id", F.col("p.ok").alias("ok"), big(F.size("p.entities"), "n_entities"))


@query("p7_training_shape", O.sql(O.FINAL, """
SELECT s AS sentence, i AS intent, ef AS entities, true AS _augmented, m AS _augmentation_method, trunc(qn)::BIGINT AS _quality_score,
  trunc(nn)::BIGINT AS _naturalness_score, doc_id AS _sample_id FROM final WHERE approved"""))
def p7_training_shape(spark, sf):
    t = review.training_shape(review.final_samples(T.reviews(spark, sf), SETTINGS))
    return t.select("sentence", "intent", flat("entities").alias("entities"), "_augmented", "_augmentation_method",
                    big("_quality_score", "_quality_score"), big("_naturalness_score", "_naturalness_score"), big("_sample_id", "_sample_id"))


@query("p11_filter_review", O.sql(O.REVIEW, """
SELECT sid AS sample_id FROM review WHERE m = 'synonym_replacement' AND lower(ap) = 'yes' AND (contains(lower(os), 'the') OR contains(lower(s), 'the'))"""))
def p11_filter_review(spark, sf):
    return review.filter_review(T.reviews(spark, sf), "synonym_replacement", "approved", "The").select(
        F.col("Sample_ID").alias("sample_id"))


@query("p12_auto_approve", O.sql(O.REVIEW, """
SELECT sid AS sample_id, CASE WHEN coalesce(qn >= 4 AND nn >= 4, false) AND coalesce(lower(ap), '') NOT IN ('yes', 'no') THEN 'yes' ELSE ap END AS approved
FROM scored"""))
def p12_auto_approve(spark, sf):
    return review.auto_approve(T.reviews(spark, sf), SETTINGS).select(
        F.col("Sample_ID").alias("sample_id"), F.col("Approved_Yes_No").alias("approved"))


@query("p13_stamp", O.sql(O.REVIEW, """
SELECT sid AS sample_id, '4' AS quality, '4' AS naturalness, 'yes' AS approved, 'Auto-approved for demo' AS comments FROM review"""))
def p13_stamp(spark, sf):
    return review.stamp_decisions(T.reviews(spark, sf)).select(
        F.col("Sample_ID").alias("sample_id"), F.col("Quality_Score_1_5").alias("quality"),
        F.col("Naturalness_Score_1_5").alias("naturalness"), F.col("Approved_Yes_No").alias("approved"),
        F.col("Comments").alias("comments"))


@query("p14_n4_apply_decisions", O.sql(O.REVIEW, """,
writes AS (SELECT user_id::VARCHAR AS sid, ts, event_id, CASE event_type WHEN 'click' THEN 'q' WHEN 'view' THEN 'n' WHEN 'error' THEN '-' ELSE 'a' END AS f,
  CASE WHEN event_type IN ('click', 'view') THEN (event_id % 5 + 1)::VARCHAR WHEN event_type = 'signup' THEN 'yes' ELSE 'no' END AS v FROM events),
latest AS (SELECT sid, f, arg_max(v, (ts, event_id)) AS v FROM writes GROUP BY 1, 2)
SELECT sid AS sample_id, coalesce(l1.v, qs) AS quality, coalesce(l2.v, ns) AS naturalness, coalesce(l3.v, ap) AS approved
FROM review LEFT JOIN (SELECT * FROM latest WHERE f = 'q') l1 USING (sid) LEFT JOIN (SELECT * FROM latest WHERE f = 'n') l2 USING (sid)
LEFT JOIN (SELECT * FROM latest WHERE f = 'a') l3 USING (sid)""").replace("decided AS", "decided_ AS").replace("FROM scored)\n,", "FROM scored),"))
def p14_n4_apply_decisions(spark, sf):
    return review.apply_decisions(T.reviews(spark, sf), T.decisions(spark, sf)).select(
        F.col("Sample_ID").alias("sample_id"), F.col("Quality_Score_1_5").alias("quality"),
        F.col("Naturalness_Score_1_5").alias("naturalness"), F.col("Approved_Yes_No").alias("approved"))


@query("p15_repair_json", """WITH e AS (SELECT event_id, event_type AS t, regexp_extract(props, '(\\d+)', 1) AS k, props FROM events)
SELECT event_id, CASE event_id % 8 WHEN 0 THEN '[' || props || ']' WHEN 1 THEN '[{"k": ' || k || '}]'
  WHEN 2 THEN '[{"type": "' || t || '", "filler": ' || k || '}]'
  WHEN 3 THEN '[{"type": "' || t || '"},{"filler": ' || k || '.5}]'
  WHEN 6 THEN '[{ "ok": true, "none": null, "at": "' || k || ':30", "name": "' || t || '"}]' ELSE '[]' END AS repaired FROM e""")
def p15_repair_json(spark, sf):
    return T.entity_texts(spark, sf).select("event_id", repair_json(F.col("text")).alias("repaired"))


@query("g7_review_analysis", O.sql(O.REVIEW, "SELECT count(*) AS total_samples, " + O.counted(
    ("approved_count", "approved"), ("rejected_count", "rejected"), ("explicit_approvals_count", "yes"),
    ("explicit_rejections_count", "no"), ("score_based_approvals_count", "ok")) + " FROM decided"))
def g7_review_analysis(spark, sf):
    return review.review_analysis(T.reviews(spark, sf), SETTINGS)


_PROGRESS = """count(*) AS total, count(*) FILTER (WHERE lower(ap) = 'yes') AS approved, count(*) FILTER (WHERE lower(ap) = 'no') AS rejected,
  count(*) FILTER (WHERE lower(ap) IS NULL OR lower(ap) NOT IN ('yes', 'no')) AS pending,
  coalesce(count(*) FILTER (WHERE lower(ap) = 'yes')::DOUBLE / nullif(count(*), 0), 0) AS approval_rate"""


def progress_query(name: str, method: str, where: str, method_sql: str, where_sql: str) -> None:
    def run(spark, sf):
        rows = T.reviews(spark, sf).withColumn("Augmentation_Method", F.expr(method)).filter(where)
        return review.review_progress(rows).withColumnRenamed("Augmentation_Method", "method")
    source = f"SELECT {method_sql} AS method, ap FROM review WHERE {where_sql}"
    query(name, O.sql(O.REVIEW, f"""SELECT method, {_PROGRESS}, false AS is_total FROM ({source}) GROUP BY method
UNION ALL SELECT NULL, {_PROGRESS}, true FROM ({source})"""))(run)


progress_query("g8_review_progress", "Augmentation_Method", "true", "m", "true")
progress_query("g8_rows_without_method", "CASE WHEN CAST(Sample_ID AS BIGINT) % 3 > 0 THEN Augmentation_Method END", "true",
               "CASE WHEN doc_id % 3 > 0 THEN m END", "true")
progress_query("g8_review_without_rows", "Augmentation_Method", "Original_Intent = 'none of them'", "m", "oi = 'none of them'")


_REPORT = f"""count(*) AS total_samples_in_review_file,
  (SELECT count(*) FROM final WHERE approved) AS approved_samples_count, {O.counted(
    ("rejected_samples_count", "rejected"), ("explicitly_approved_count", "yes"),
    ("explicitly_rejected_count", "no"), ("score_based_approvals_count", "ok"))}, 'balanced' AS integration_strategy"""


@query("j2_integration_report", O.sql(O.FINAL, f"SELECT {_REPORT} FROM decided"))
def j2_integration_report(spark, sf):
    return jobs.integrate_review(T.reviews(spark, sf), SETTINGS).report.drop("notes")


# --- sources and sinks -----------------------------------------------------

def lines_folder(spark, sf) -> str:
    """Utterances as JSON lines, some cut off, some without a field, some blank."""
    path = work_folder(spark)
    T.utterances(spark, sf).select(odd_line(F.col("seq.sent") % 10).alias("value")).write.text(path)
    return path


def odd_line(i: Column) -> Column:
    """An utterance as a JSON line, with a fault by its number."""
    whole = F.to_json(F.struct("sentence", "intent", "entities"))
    return (
        F.when(i == 1, F.substring(whole, F.lit(1), F.char_length(whole) - 4))
        .when(i == 2, F.to_json(F.struct("sentence", "entities")))
        .when(i == 3, F.to_json(F.struct("intent", "entities")))
        .when(i == 4, F.to_json(F.struct("sentence", "intent")))
        .when(i == 5, F.lit("   "))
        .otherwise(whole)
    )


@query("s1_validated_jsonl", O.sql(O.UTT, f"""
SELECT sentence, intent, CASE WHEN sent_no % 10 = 4 THEN '' ELSE {O.flat('entities')} END AS entities FROM utt WHERE sent_no % 10 NOT IN (1, 2, 3, 5)"""))
def s1_validated_jsonl(spark, sf):
    return readers.read_utterances(spark, lines_folder(spark, sf)).select("sentence", "intent", flat("entities").alias("entities"))


@query("s1_rejected_lines", O.sql(O.UTT, """
SELECT CASE sent_no % 10 WHEN 1 THEN 'Invalid JSON' WHEN 2 THEN 'Missing ''intent'' field' ELSE 'Missing ''sentence'' field' END AS reason,
  count(*) AS n FROM utt WHERE sent_no % 10 IN (1, 2, 3) GROUP BY 1"""))
def s1_rejected_lines(spark, sf):
    return readers.rejected_lines(spark, lines_folder(spark, sf)).groupBy("reason").agg(F.count("*").alias("n"))


@query("s2_lenient_jsonl", O.sql(O.UTT, """
SELECT CASE WHEN sent_no % 10 <> 3 THEN sentence END AS sentence, CASE WHEN sent_no % 10 <> 2 THEN intent END AS intent FROM utt WHERE sent_no % 10 NOT IN (1, 5)"""))
def s2_lenient_jsonl(spark, sf):
    return readers.read_lenient(spark, lines_folder(spark, sf)).select("sentence", "intent")


def odd_folder(spark, sf) -> str:
    """Utterances whose entity lists hold odd elements."""
    path = work_folder(spark)
    u = T.utterances(spark, sf)
    i = F.col("seq.sent") % 6
    whole = F.to_json(F.struct("sentence", "intent", "entities"))
    odd = lambda entities: F.concat(F.lit('{"sentence": '), F.to_json(F.array("sentence")).substr(F.lit(2), F.char_length(F.to_json(F.array("sentence"))) - 2),
                                    F.lit(', "intent": " ", "entities": '), F.lit(entities), F.lit("}"))
    line = (
        F.when(i == 1, odd('["loose", {"type": "t", "filler": "f"}]'))
        .when(i == 2, odd('[{"type": " ", "filler": "f"}, {"type": "t"}]'))
        .when(i == 3, F.to_json(F.struct("sentence", "intent")))
        .otherwise(whole)
    )
    u.select(line.alias("value")).write.text(path)
    return path


_ODD = O.UTT + """,
odd AS (SELECT sent_no % 6 AS i, len(entities) AS n, entities FROM utt)"""


@query("g5_format_report", O.sql(_ODD, """
SELECT 'total_samples' AS metric, count(*)::DOUBLE AS value FROM odd
UNION ALL SELECT 'valid_samples', count(*) FILTER (WHERE i NOT IN (1, 2))::DOUBLE FROM odd
UNION ALL SELECT 'sentence_coverage', count(*)::DOUBLE FROM odd
UNION ALL SELECT 'intent_coverage', count(*) FILTER (WHERE i NOT IN (1, 2))::DOUBLE FROM odd
UNION ALL SELECT 'entities_coverage', count(*) FILTER (WHERE i <> 3)::DOUBLE FROM odd
UNION ALL SELECT 'total_entities', sum(CASE i WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 0 ELSE n END)::DOUBLE FROM odd
UNION ALL SELECT 'samples_with_entities', count(*) FILTER (WHERE i <> 3 AND (i IN (1, 2) OR n > 0))::DOUBLE FROM odd
UNION ALL SELECT 'unique_entity_types', (count(DISTINCT t) + (SELECT count(*) FILTER (WHERE i = 1) > 0 FROM odd)::INT)::DOUBLE
  FROM (SELECT unnest(entities).type AS t FROM odd WHERE i IN (0, 4, 5))"""))
def g5_format_report(spark, sf):
    return profile.format_report(readers.read_raw(spark, odd_folder(spark, sf)))


@query("g5_format_issues", O.sql(_ODD, """
SELECT issue, count(*) AS n FROM (SELECT unnest(CASE i
  WHEN 1 THEN [': Missing or empty ''intent''', ', Entity 0: Not a dictionary']
  WHEN 2 THEN [': Missing or empty ''intent''', ', Entity 0: Missing ''type''', ', Entity 1: Missing ''filler''']
  WHEN 3 THEN [': Missing ''entities'' field'] ELSE []::VARCHAR[] END) AS issue FROM odd) GROUP BY 1"""))
def g5_format_issues(spark, sf):
    found = profile.format_issues(readers.read_raw(spark, odd_folder(spark, sf)))
    tail = F.expr("substr(issue, char_length('Sample ' || sample_id) + 1)")
    return found.groupBy(tail.alias("issue")).agg(F.count("*").alias("n"))


_REVIEW_COLUMNS = """sid AS sample_id, os AS original_sentence, oi AS original_intent, oe AS original_entities, s AS augmented_sentence,
  m AS method, nullif(e, '') AS augmented_entities, nullif(qs, '') AS quality, ns AS naturalness, comments, nullif(ap, '') AS approved"""


def review_columns(df: DataFrame) -> DataFrame:
    names = {"Sample_ID": "sample_id", "Original_Sentence": "original_sentence", "Original_Intent": "original_intent",
             "Original_Entities": "original_entities", "Augmented_Sentence": "augmented_sentence",
             "Augmentation_Method": "method", "Augmented_Entities": "augmented_entities", "Quality_Score_1_5": "quality",
             "Naturalness_Score_1_5": "naturalness", "Comments": "comments", "Approved_Yes_No": "approved"}
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


@query("s3_review_csv", O.sql(O.REVIEW, f"SELECT {_REVIEW_COLUMNS} FROM review"))
def s3_review_csv(spark, sf):
    path = work_folder(spark)
    writers.write_review(T.reviews(spark, sf), path)
    return review_columns(readers.read_review(spark, path))


@query("s3_by_records", O.sql(O.REVIEW, f"SELECT {_REVIEW_COLUMNS} FROM review"))
def s3_by_records(spark, sf):
    """The records of review files found first, so that files split anywhere."""
    path = work_folder(spark)
    writers.write_review(T.reviews(spark, sf), path)
    return review_columns(readers.read_review(spark, path, by_records=True))


@query("s3_drop_short", O.sql(O.REVIEW, """
SELECT sid AS sample_id, os AS original_sentence, CASE WHEN doc_id % 4 = 2 THEN NULL ELSE nullif(ap, '') END AS approved FROM review WHERE doc_id % 4 <> 1"""))
def s3_drop_short(spark, sf):
    """Rows cut off go; rows with more cells than the header stay, whatever their last named cell."""
    path, row, i = work_folder(spark), T.reviews(spark, sf), F.col("Sample_ID").cast("bigint") % 4
    cells = row.withColumn("Approved_Yes_No", F.when(i == 2, None).otherwise(F.col("Approved_Yes_No")))
    quoted = [F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
              for c in map(F.col, row.columns)]
    line = F.concat_ws(",", *quoted)
    odd = F.when(i == 1, F.concat_ws(",", *quoted[:7])).when(i > 1, F.concat(line, F.lit(",more,cells"))).otherwise(line)
    # Each file begins with the header: a partition's first row, by its number.
    numbered = settle(cells.select(odd.alias("line"), F.monotonically_increasing_id().alias("at")))
    first = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    text = F.concat(F.when(first, ",".join(row.columns) + "\n").otherwise(""), "line")
    numbered.select(F.shiftright("at", 33).alias("file"), text.alias("value"), "at").repartition("file").sortWithinPartitions("file", "at") \
        .select("file", "value").write.partitionBy("file").text(path)
    found = readers.read_review(spark, f"{path}/file=*", drop_short=True)
    return found.select(F.col("Sample_ID").alias("sample_id"), F.col("Original_Sentence").alias("original_sentence"), F.col("Approved_Yes_No").alias("approved"))


@query("s1_line_numbers", O.sql(O.UTT, """
SELECT doc_id % 8 AS file, row_number() OVER (PARTITION BY doc_id % 8 ORDER BY doc_id, sent_no) - 1 AS line, sentence FROM utt
QUALIFY sent_no % 10 NOT IN (1, 2, 3, 5)"""))
def s1_line_numbers(spark, sf):
    """The number of every valid line in its text, a folder of part files, bad and blank lines counted."""
    path = work_folder(spark)
    rows = T.utterances(spark, sf).select((F.col("seq.doc") % 8).alias("file"), "seq", odd_line(F.col("seq.sent") % 10).alias("value"))
    rows = settle(rows)
    # Ranges of the order, so that no task sorts and writes more lines than that, however long a text is.
    ranges = rows.count() // LINES_PER_TASK + 1
    rows.repartitionByRange(ranges, "file", "seq").sortWithinPartitions("file", "seq").select("file", "value").write.partitionBy("file").text(path)
    found = readers.read_utterances(spark, f"{path}/file=*", numbered="folder")
    return found.select(F.regexp_extract("seq.file", "file=([0-9]+)", 1).cast("bigint").alias("file"), "seq.line", "sentence")


@query("s5_newest_batch", O.sql(O.REVIEW, "SELECT sid AS sample_id FROM review WHERE oi <> 'en'"))
def s5_newest_batch(spark, sf):
    path = work_folder(spark)
    rows = T.reviews(spark, sf)
    writers.write_review(rows.filter("Original_Intent = 'en'"), f"{path}/review_samples_1.csv")
    writers.write_review(rows.filter("Original_Intent <> 'en'"), f"{path}/review_samples_2.csv")
    newest = readers.newest_batch(spark, f"{path}/review_samples_*.csv", by="name")
    return readers.read_review(spark, newest).select(F.col("Sample_ID").alias("sample_id"))


@query("s6_head_sample", O.sql(O.UTT, "SELECT sample_id, sentence FROM utt ORDER BY doc_id, sent_no LIMIT 50"))
def s6_head_sample(spark, sf):
    return readers.head(T.utterances(spark, sf)).select("sample_id", "sentence")


@query("s7_k1_training_roundtrip", O.sql(O.FINAL, """
SELECT s AS sentence, i AS intent, ef AS entities, m AS _augmentation_method, trunc(qn)::BIGINT AS _quality_score, doc_id AS _sample_id
FROM final WHERE approved"""))
def s7_k1_training_roundtrip(spark, sf):
    path = f"{work_folder(spark)}.jsonl"
    writers.write_jsonl(review.training_shape(review.final_samples(T.reviews(spark, sf), SETTINGS)), path)
    return readers.read_training_set(spark, path).select(
        "sentence", "intent", flat("entities").alias("entities"), "_augmentation_method",
        big("_quality_score", "_quality_score"), big("_sample_id", "_sample_id"))


@query("s7_k2_json_roundtrip", O.sql(O.UTT, f"SELECT sentence, intent, {O.flat('entities')} AS entities FROM utt"))
def s7_k2_json_roundtrip(spark, sf):
    """A training set exported as one JSON array by several tasks, gzipped as it is several times the documents, read back by several."""
    path = writers.export_for_training(T.utterances(spark, sf), work_folder(spark), "json", compression="gzip")
    return readers.read_training_set(spark, path, one_array=True).select("sentence", "intent", flat("entities").alias("entities"))


@query("s3_mixed_headers", O.sql(O.REVIEW, """
SELECT sid AS sample_id, CASE WHEN doc_id % 2 = 0 THEN comments END AS comments, nullif(ap, '') AS approved FROM review"""))
def s3_mixed_headers(spark, sf):
    """One batch of files with twelve columns and with eleven."""
    path = work_folder(spark)
    rows = T.reviews(spark, sf)
    even = F.col("Sample_ID").cast("bigint") % 2 == 0
    writers.write_review(rows.filter(even), f"{path}/review_samples_1.csv")
    writers.write_review(rows.filter(~even).drop("Comments"), f"{path}/review_samples_2.csv")
    return readers.read_review(spark, f"{path}/*.csv").select(
        F.col("Sample_ID").alias("sample_id"), F.col("Comments").alias("comments"), F.col("Approved_Yes_No").alias("approved"))


@query("p5_large_ids", O.sql(O.FINAL, "SELECT doc_id + 3000000000000 AS sample_id FROM final WHERE approved"))
def p5_large_ids(spark, sf):
    far = (F.col("Sample_ID").cast("bigint") + 3_000_000_000_000).cast("string")
    return review.final_samples(T.reviews(spark, sf).withColumn("Sample_ID", far), SETTINGS).select("sample_id")


def odd_entity_lines(spark, sf):
    """Utterances as JSON lines: entities as they are, among text, or no array at all."""
    path, typed = work_folder(spark), F.to_json("entities")
    shape = F.col("seq.doc") % 3
    loose = F.concat(F.lit('["loose"'), F.when(F.size("entities") > 0, ",").otherwise(""), F.substring(typed, F.lit(2), F.char_length(typed)))
    entities = F.when(shape == 0, typed).when(shape == 1, loose).otherwise('"none"')
    T.utterances(spark, sf).select(F.to_json(F.struct("sentence", "intent", F.parse_json(entities).alias("entities")))).write.text(path)
    return path


@query("s1_odd_entities", O.sql(O.UTT, f"SELECT sentence, intent, CASE WHEN doc_id % 3 = 2 THEN '' ELSE {O.flat('entities')} END AS entities FROM utt"))
def s1_odd_entities(spark, sf):
    return readers.read_utterances(spark, odd_entity_lines(spark, sf)).select("sentence", "intent", flat("entities").alias("entities"))


@query("s2_odd_entities", O.sql(O.UTT, f"SELECT sentence, CASE WHEN doc_id % 3 < 2 THEN {O.flat('entities')} END AS entities FROM utt"))
def s2_odd_entities(spark, sf):
    return readers.read_lenient(spark, odd_entity_lines(spark, sf)).select("sentence", flat("entities").alias("entities"))


@query("p9_odd_entity_issues", O.sql(O.UTT, """
SELECT CASE doc_id % 3 WHEN 1 THEN '"loose"' ELSE '"none"' END AS entity, count(*) AS n FROM utt WHERE doc_id % 3 > 0 GROUP BY 1"""))
def p9_odd_entity_issues(spark, sf):
    return readers.odd_entities(spark, odd_entity_lines(spark, sf)).groupBy("entity").agg(F.count("*").alias("n"))


@query("k11_final_set_twice", O.sql(O.FINAL, "SELECT doc_id AS _sample_id, 'batch' AS batch FROM final WHERE approved"))
def k11_final_set_twice(spark, sf):
    """A batch written twice is there once."""
    path = work_folder(spark)
    final = review.training_shape(review.final_samples(T.reviews(spark, sf), SETTINGS))
    for batch in ("other", "batch", "batch"):
        writers.write_final(final, path, batch)
    return spark.read.schema("_sample_id bigint, batch string").json(path).filter("batch = 'batch'")


@query("k2_augmentation_envelope", O.sql(O.CAND, "SELECT 'batch' AS timestamp, count(*) AS total_augmentations FROM variants WHERE failed_rule IS NULL"))
def k2_augmentation_envelope(spark, sf):
    path = work_folder(spark)
    writers.write_augmentations(augment.accepted(variants(spark, sf)), path, "batch")
    return spark.read.schema("timestamp string, total_augmentations bigint").json(f"{path}/metadata")


def read_flat(spark, path, columns):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("nullValue", "\x00") \
        .option("emptyValue", "").schema(", ".join(f"{c} string" for c in columns)).csv(path)


_JSON_LIST = """'[' || array_to_string(list_transform(entities, lambda e: '{"type":' || to_json(e.type)::VARCHAR || ',"filler":' || to_json(e.filler)::VARCHAR || '}'), ',') || ']'"""


@query("k3_k9_flat_csv", O.sql(O.UTT, f"SELECT sentence, intent, {_JSON_LIST} AS entities, 'original' AS source FROM utt"))
def k3_k9_flat_csv(spark, sf):
    path = work_folder(spark)
    u = T.utterances(spark, sf)
    tagged = integrate.merge(u, u.limit(0), SETTINGS)
    writers.write_dataset(tagged, path, replace(SETTINGS, output_format="csv"))
    return read_flat(spark, path, ["sentence", "intent", "entities", "source"])


@query("k9_metadata_stripped", O.sql(O.UTT, f"SELECT sentence, intent, {O.flat('entities')} AS entities, true AS metadata_absent FROM utt"))
def k9_metadata_stripped(spark, sf):
    path = work_folder(spark)
    u = T.utterances(spark, sf)
    tagged = integrate.merge(u, u.limit(0), SETTINGS)
    writers.write_dataset(tagged, path, replace(SETTINGS, add_metadata=False))
    schema = "sentence string, intent string, entities array<struct<type:string,filler:string>>, metadata struct<source:string>"
    return spark.read.schema(schema).json(path).select(
        "sentence", "intent", flat("entities").alias("entities"), F.col("metadata").isNull().alias("metadata_absent"))


@query("k4_training_csv", O.sql(O.UTT, f"SELECT sentence, intent, {_JSON_LIST} AS entities_json, len(entities)::VARCHAR AS entity_count FROM utt"))
def k4_training_csv(spark, sf):
    path = writers.export_for_training(T.utterances(spark, sf), work_folder(spark), "csv")
    return read_flat(spark, path, ["sentence", "intent", "entities_json", "entity_count"])


@query("k5_w3_review_export", O.sql(O.CAND, """
SELECT row_number() OVER (ORDER BY doc_id, sent_no, method_no)::VARCHAR AS sample_id, sentence AS original_sentence, a AS augmented_sentence,
  intent AS augmented_intent, method, '' AS approved FROM variants WHERE failed_rule IS NULL ORDER BY doc_id, sent_no, method_no LIMIT 100"""))
def k5_w3_review_export(spark, sf):
    batch = review.review_batch(augment.accepted(variants(spark, sf)), 100)
    return batch.select(
        F.col("Sample_ID").alias("sample_id"), F.col("Original_Sentence").alias("original_sentence"),
        F.col("Augmented_Sentence").alias("augmented_sentence"), F.col("Augmented_Intent").alias("augmented_intent"),
        F.col("Augmentation_Method").alias("method"), F.col("Approved_Yes_No").alias("approved"))


@query("k7_integration_report_file", O.sql(O.FINAL, f"SELECT {_REPORT} FROM decided"))
def k7_integration_report_file(spark, sf):
    path = work_folder(spark)
    result = jobs.integrate_review(T.reviews(spark, sf), SETTINGS)
    jobs.write_integration(result, path, "batch")
    counts = ["total_samples_in_review_file", "approved_samples_count", "rejected_samples_count",
              "explicitly_approved_count", "explicitly_rejected_count", "score_based_approvals_count"]
    schema = ", ".join(f"{c} bigint" for c in counts) + ", integration_strategy string"
    return spark.read.schema(schema).json(f"{path}/report/integration_report_batch")


@query("k8_quality_report", O.sql(CHECKED + """,
failed AS (SELECT k, count(*) AS n FROM (SELECT unnest([""" + ", ".join(
    f"CASE WHEN {name} IS NOT NULL THEN '{name}' END" for name in PAIR_SQL) + f"""]) AS k FROM checked) WHERE k IS NOT NULL GROUP BY 1),
kinds AS (SELECT t AS k, count(*) AS n FROM (SELECT unnest(e).type AS t FROM pairs) GROUP BY 1),
roles AS (SELECT i AS k, count(*) AS n FROM pairs GROUP BY 1)""", f"""
SELECT 'totals' AS section, 1 AS position, 'total_samples' AS key, count(*) AS n, NULL::DOUBLE AS rate FROM checked
UNION ALL SELECT 'totals', 2, 'passed_all_checks', count(*) FILTER (WHERE {_FINE}), count(*) FILTER (WHERE {_FINE})::DOUBLE / count(*) FROM checked
UNION ALL SELECT 'totals', 3, 'samples_with_vietnamese', count(*) FILTER (WHERE vietnamese_chars IS NULL), count(*) FILTER (WHERE vietnamese_chars IS NULL)::DOUBLE / count(*) FROM checked
UNION ALL SELECT 'failed_checks', row_number() OVER (ORDER BY n DESC, k), k, n, NULL FROM failed
UNION ALL SELECT * FROM (SELECT 'intents', row_number() OVER (ORDER BY n DESC, k) AS p, k, n, NULL FROM roles) WHERE p <= 10
UNION ALL SELECT * FROM (SELECT 'entity_types', row_number() OVER (ORDER BY n DESC, k) AS p, k, n, NULL FROM kinds) WHERE p <= 10"""))
def k8_quality_report(spark, sf):
    """The report of all pairs, written and read back."""
    path = work_folder(spark)
    # Checked once; everything in the report is counted from what is kept of it.
    checked = settle(quality.validate_pairs(T.turn_pairs(spark, sf), SETTINGS).select(
        "original_sentence", "augmented_sentence", F.col("augmented_intent").alias("intent"),
        F.col("augmented_entities").alias("entities"), "checks", "valid"))
    counts = settle(profile.label_counts(checked, pairs=False))
    jobs.write_quality_report(jobs.quality_report(checked, counts, "augmented_sentence", pairs=True), path)
    schema = "section string, position bigint, key string, n bigint, rate double"
    return spark.read.schema(schema).json(f"{path}/quality_report_stats")


_REPAIRED = f"""CASE doc_id % 8 WHEN 0 THEN e WHEN 7 THEN e WHEN 4 THEN e WHEN 5 THEN e
  WHEN 6 THEN '[{{"type": "' || comments || '", "filler": "' || oi || '"}}]' ELSE '[]' END"""


@query("k10_p15_reviewed_csv", O.sql(O.REVIEW, f"SELECT sid AS sample_id, oe AS original_entities, {_REPAIRED} AS augmented_entities FROM review"))
def k10_p15_reviewed_csv(spark, sf):
    path = writers.export_reviewed(T.reviews(spark, sf), work_folder(spark), "csv")
    back = readers.read_review(spark, path)
    return back.select(F.col("Sample_ID").alias("sample_id"), F.col("Original_Entities").alias("original_entities"),
                       F.col("Augmented_Entities").alias("augmented_entities"))


@query("k10_reviewed_json", O.sql(O.REVIEW, """
SELECT sid AS sample_id, comments || '=' || oi AS original_entities,
  CASE WHEN doc_id % 8 IN (0, 6, 7) THEN comments || '=' || oi WHEN doc_id % 8 = 4 THEN 'bare=object' ELSE '' END AS augmented_entities FROM review"""))
def k10_reviewed_json(spark, sf):
    path = writers.export_reviewed(T.reviews(spark, sf), work_folder(spark), "json")
    ent = "array<struct<type:string,filler:string>>"
    back = readers.read_array(spark, path, f"Sample_ID string, Original_Entities {ent}, Augmented_Entities {ent}")
    return back.select(
        F.col("Sample_ID").alias("sample_id"), flat("Original_Entities").alias("original_entities"),
        flat("Augmented_Entities").alias("augmented_entities"))


@query("k11_final_set", O.sql(O.FINAL, """
SELECT s AS sentence, i AS intent, ef AS entities, doc_id AS _sample_id, 'batch' AS batch FROM final WHERE approved"""))
def k11_final_set(spark, sf):
    path = work_folder(spark)
    final = review.training_shape(review.final_samples(T.reviews(spark, sf), SETTINGS))
    writers.write_final(final, path, "batch")
    schema = "sentence string, intent string, entities array<struct<type:string,filler:string>>, _sample_id bigint, batch string"
    return spark.read.schema(schema).json(path).select(
        "sentence", "intent", flat("entities").alias("entities"), "_sample_id", "batch")


# --- jobs ------------------------------------------------------------------

_J1 = (O.UTT + ",\n" + _RARE).replace("utt AS (", "every AS (").replace("FROM utt", "FROM every") + """,
utt AS (SELECT * FROM every WHERE intent IN (SELECT label FROM rarity WHERE dimension = 'intent' AND rare)
  OR list_has_any(list_transform(entities, lambda e: e.type), (SELECT list(label) FROM rarity WHERE dimension = 'entity_type' AND rare)))"""
_J1 = O.CAND.replace(O.UTT, _J1)


@query("j1_k6_generate", O.sql(_J1, """
SELECT sample_id, method, sentence AS original_sentence, a AS augmented_sentence, intent AS augmented_intent FROM variants WHERE failed_rule IS NULL"""))
def j1_k6_generate(spark, sf):
    u, settings = frequent(spark, sf)
    return jobs.generate(u, settings).augmentations.select(
        "sample_id", "method", "original_sentence", "augmented_sentence", "augmented_intent")


@query("k6_generation_files", O.sql(_J1, """
SELECT 'augmentation' AS kind, sentence AS original_sentence, a AS augmented_sentence, method FROM variants WHERE failed_rule IS NULL
UNION ALL SELECT 'issue', sentence, a, method FROM variants WHERE failed_rule IS NOT NULL"""))
def k6_generation_files(spark, sf):
    """Everything that a generation writes, read back."""
    u, settings = frequent(spark, sf)
    path = work_folder(spark)
    jobs.write_generation(jobs.generate(u, settings), path, "batch")
    columns = ["original_sentence", "augmented_sentence", "method"]
    schema = ", ".join(f"{c} string" for c in columns)

    def back(folder, kind):
        return spark.read.schema(schema).json(f"{path}/augmented/{folder}").select(F.lit(kind).alias("kind"), *columns)

    return back("augmented_data_batch/augmentations", "augmentation").unionByName(
        back("generation_stats_batch/quality_issues", "issue"))


@query("j4_chain_final", O.sql(O.CAND, """
SELECT row_number() OVER (ORDER BY doc_id, sent_no, method_no) AS sample_id, sentence AS original_sentence, a AS augmented_sentence,
  method AS augmentation_method FROM variants WHERE failed_rule IS NULL ORDER BY doc_id, sent_no, method_no LIMIT 100"""))
def j4_chain_final(spark, sf):
    """The whole chain as a user runs it: one review batch, all of it accepted."""
    every = replace(SETTINGS, min_intent_frequency=2 ** 62)
    chain = jobs.generate_and_integrate(stored(spark, sf), every, review.stamp_decisions, max_review_samples=100)
    return chain.integration.final.select("sample_id", "original_sentence", "augmented_sentence", "augmentation_method")


@query("j1_statistics", O.sql(_J1, """
SELECT method, (SELECT count(*) FROM every) AS processed_samples, count(DISTINCT sample_id) AS tried_samples,
  count(*) FILTER (WHERE failed_rule IS NULL) AS generated, count(*) FILTER (WHERE failed_rule IS NOT NULL) AS failed,
  count(*) FILTER (WHERE failed_rule IS NULL)::DOUBLE / count(*) AS success_rate FROM variants GROUP BY ROLLUP (method)"""))
def j1_statistics(spark, sf):
    u, settings = frequent(spark, sf)
    return jobs.generate(u, settings).statistics


@query("j4_generate_and_integrate", O.sql(O.CAND, """
SELECT (SELECT count(*) FROM utt) AS input_samples, count(*) AS final_samples,
  (count(*)::DOUBLE / (SELECT count(*) FROM utt) - 1) * 100 AS augmentation_ratio FROM variants WHERE failed_rule IS NULL"""))
def j4_generate_and_integrate(spark, sf):
    """The steps of the chain over all variants: each is reviewed and integrated, not just a batch of them."""
    u = stored(spark, sf)
    every = replace(SETTINGS, min_intent_frequency=2 ** 62)
    generation = jobs.generate(u, every)
    everything = review.stamp_decisions(review.review_rows(generation.augmentations))
    result = jobs.integrate_review(everything, every)
    return profile.augmentation_ratio(u, result.final)


@query("j4_resume_after_review", O.sql(O.CAND, """
SELECT sample_id, original_sentence, augmented_sentence, augmentation_method, (SELECT count(*) FROM utt) AS input_samples,
  count(*) OVER () AS final_samples, (count(*) OVER ()::DOUBLE / (SELECT count(*) FROM utt) - 1) * 100 AS augmentation_ratio
FROM (SELECT row_number() OVER (ORDER BY doc_id, sent_no, method_no) AS sample_id, sentence AS original_sentence, a AS augmented_sentence,
  method AS augmentation_method FROM variants WHERE failed_rule IS NULL ORDER BY doc_id, sent_no, method_no LIMIT 100) WHERE sample_id % 3 <> 0"""))
def j4_resume_after_review(spark, sf):
    """The chain stopped at its review batch, gone on with after people rejected every third row, and resumed once more."""
    every = replace(SETTINGS, min_intent_frequency=2 ** 62)
    path = work_folder(spark)
    runs.start(stored(spark, sf), every, path, "batch", max_review_samples=100)
    if runs.resume(spark, every, path) is not None:
        raise AssertionError("resumed without a review")
    batch = readers.read_review(spark, f"{path}/review/review_samples_batch.csv")
    decided = review.stamp_decisions(batch).withColumn(
        "Approved_Yes_No", F.when(F.col("Sample_ID").cast("bigint") % 3 == 0, "no").otherwise("yes"))
    writers.write_review(decided, f"{path}/review/reviewed_samples_1.csv")
    runs.resume(spark, every, path)
    log = runs.resume(spark, every, path)
    schema = "_sample_id bigint, _original_sentence string, sentence string, _augmentation_method string"
    return spark.read.schema(schema).json(f"{path}/final/batch=batch").select(
        F.col("_sample_id").alias("sample_id"), F.col("_original_sentence").alias("original_sentence"),
        F.col("sentence").alias("augmented_sentence"), F.col("_augmentation_method").alias("augmentation_method"),
        *(F.lit(log[c]).alias(c) for c in ("input_samples", "final_samples", "augmentation_ratio")))


@query("j5_audit_labels", O.sql(O.UTT, f"""
SELECT value, count(*) AS n FROM (SELECT {_CLEAN('e.type')} AS value, {_CLEAN('e.filler')} AS f FROM (SELECT unnest(entities) AS e FROM utt))
WHERE value <> '' AND f <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT 20"""))
def j5_audit_labels(spark, sf):
    u = T.utterances(spark, sf)
    raw = u.select("sample_id", "seq", "sentence", "intent", F.parse_json(F.to_json("entities")).alias("entities"))
    return jobs.audit(raw, u).top_types


_TIDY = lambda x: O.strip(f"regexp_replace(regexp_replace({O.strip(x)}, '{O.WS}+', ' ', 'g'), '[^a-zA-Z0-9_ .,!?\\p{{L}}\\p{{N}}-]', '', 'g')")
_AUDIT = _ODD + f""",
cl AS (SELECT sample_id, intent, {_TIDY('sentence')} AS sentence, list_filter(list_transform(entities,
  lambda e: {{'type': {_CLEAN('e.type')}, 'filler': {_CLEAN('e.filler')}}}), lambda e: e.type <> '' AND e.filler <> '') AS entities FROM utt),
ce AS (SELECT unnest(entities) AS e FROM cl),
vals AS (SELECT 'type' AS kind, e.type AS value, count(*) AS n FROM ce GROUP BY ALL UNION ALL SELECT 'filler', e.filler, count(*) FROM ce GROUP BY ALL),
roles AS (SELECT intent AS value, count(*) AS n FROM cl GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, value) AS p FROM vals),
tags AS (SELECT value, row_number() OVER (ORDER BY value) AS i FROM vals WHERE kind = 'type'),
issues AS ({ORACLES['g5_format_issues'].split(_ODD)[1]}),
report AS ({ORACLES['g5_format_report'].split(_ODD)[1]}),
marked AS (SELECT count(*) FILTER (WHERE regexp_matches(lower(sentence), '[{O.DIA}]')) AS n FROM cl)"""


@query("j5_audit_outputs", O.sql(_AUDIT, f"""
SELECT 'format_issues' AS output, issue AS key, n::DOUBLE AS value FROM issues
UNION ALL SELECT 'format_report', metric, value FROM report
UNION ALL SELECT 'cleaned', 'rows', count(*) FROM cl
UNION ALL SELECT 'cleaned', 'digest', sum(('0x' || substr(md5(concat_ws('|', sample_id, sentence, intent, {O.flat('entities')})), 1, 6))::BIGINT) FROM cl
UNION ALL SELECT 'entity_statistics', 'total_entities', (SELECT count(*) FROM ce)
UNION ALL SELECT 'entity_statistics', 'samples_with_entities', count(*) FILTER (WHERE len(entities) > 0) FROM cl
UNION ALL SELECT 'entity_statistics', 'samples_without_entities', count(*) FILTER (WHERE len(entities) = 0) FROM cl
UNION ALL SELECT 'entity_statistics', 'average_entities_per_sample', (SELECT count(*) FROM ce)::DOUBLE / count(*) FROM cl
UNION ALL SELECT 'entity_statistics', 'unique_entity_' || kind || 's', count(*) FROM vals GROUP BY kind
UNION ALL SELECT 'top_' || kind || 's', value, n FROM ranked WHERE p <= 20
UNION ALL SELECT 'label_map', tag || value, i * 2 - (tag = 'B-')::BIGINT FROM tags, (VALUES ('B-'), ('I-')) v(tag)
UNION ALL SELECT 'label_map', 'O', 0
UNION ALL SELECT 'quality_report/totals', k, CASE k WHEN 'samples_with_vietnamese' THEN (SELECT n FROM marked) ELSE (SELECT count(*) FROM cl) END
  FROM (VALUES ('total_samples'), ('passed_all_checks'), ('samples_with_vietnamese')) t(k)
UNION ALL SELECT * FROM (SELECT 'quality_report/intents', value, n FROM roles ORDER BY n DESC, value LIMIT 10)
UNION ALL SELECT 'quality_report/entity_types', value, n FROM ranked WHERE kind = 'type' AND p <= 10"""))
def j5_audit_outputs(spark, sf):
    """Every output of the audit; the cleaned rows by their number and an order-free digest."""
    found = jobs.audit(readers.read_raw(spark, odd_folder(spark, sf)), T.utterances(spark, sf))
    tail = F.expr("substr(issue, char_length('Sample ' || sample_id) + 1)")
    row = F.concat_ws("|", "sample_id", "sentence", "intent", flat("entities"))
    cleaned = found.cleaned.agg(F.count("*").alias("rows"), F.sum(F.conv(F.substring(F.md5(row), 1, 6), 16, 10).cast("bigint")).alias("digest"))
    outputs = {
        "format_issues": found.format_issues.groupBy(tail.alias("key")).agg(F.count("*").alias("value")),
        "format_report": found.format_report,
        "cleaned": cleaned.unpivot([], ["rows", "digest"], "key", "value"),
        "entity_statistics": found.entity_statistics,
        "top_types": found.top_types, "top_fillers": found.top_fillers, "label_map": found.label_map,
    }
    tables = [t.toDF("key", "value").select(F.lit(name).alias("output"), "key", F.col("value").cast("double")) for name, t in outputs.items()]
    tables.append(found.quality_report.select(
        F.concat(F.lit("quality_report/"), F.col("section")).alias("output"), "key", F.col("n").cast("double").alias("value")))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole
