"""Rewriting utterances: each rare sample fans out into a few gated variants.

A method is a function ``(sentence, entities, sample, settings) → struct<sentence,
entities>`` of columns. All methods of a row are evaluated in one narrow stage
and exploded; nothing here shuffles.

Lambdas are interpreted, and what is used twice within a lambda or a branch is
evaluated twice. So the built-in methods with look-ups are ``Rounds``: columns
that rest on those of the round before. Lambdas over entities are left to rows
where compiled tests don't rule a change out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.config import Settings, entries_literal, literal
from lexiloom.functions.draw import chance, choose, draw
from lexiloom.functions.entities import listed
from lexiloom.functions.text import (
    BLANK, NO_BLANK, replace_first, replace_first_match, strip, whole_term_pattern, words,
)
from lexiloom.operators.quality import first_failed_rule, with_user_checks
from lexiloom.schema import ENTITIES_DDL

Method = Callable[[Column, Column, Column, Settings], Column]
#: Functions ``(prefix, settings) → columns by name``, evaluated one after the other over the columns sentence, entities,
#: _key and those of ``_scanned``; the last one gives ``<prefix>_sentence`` and ``<prefix>_entities``.
Rounds = tuple[Callable[[str, Settings], dict[str, Column]], ...]

# Words in an entity type that select the vocabulary to search.
DEVICE_TYPES = ("device",)
PLACE_TYPES = ("space", "location", "room")
TIME_TYPES = ("time", "duration", "delay")
#: Up to so many terms are compiled, each into the code; more are looked up in a literal.
MAX_COMPILED = 96


def _names(entity_type: Column, keywords: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | F.contains(entity_type, F.lit(keyword))
    return hit


def _pair(sentence: Column, entities: Column) -> Column:
    return F.struct(sentence.alias("sentence"), entities.cast(ENTITIES_DDL).alias("entities"))


def _known(text: Column, vocabulary: Column) -> Column:
    """The first entry whose term is in the text or whose synonyms hold the text."""
    return F.get(F.filter(vocabulary, lambda v: F.contains(text, v["original"])
                          | F.array_contains(v["synonyms"], text)), F.lit(0))


def entity_synonyms(entities: Column, sample: Column, settings: Settings) -> Column:
    """Entities with ``text`` (the stripped filler) and ``synonym``, NULL if none is known.

    Device terms come before places. A filler that contains a term draws one
    of its synonyms; a filler that is itself a synonym maps back to the term.
    """
    devices = entries_literal(settings.vocabulary.devices)
    places = entries_literal(settings.vocabulary.locations)

    prepared = F.transform(listed(entities), lambda e: F.struct(
        e["type"].alias("type"),
        e["filler"].alias("filler"),
        strip(F.coalesce(e["filler"], F.lit(""))).alias("text"),
        F.lower(strip(F.coalesce(e["filler"], F.lit("")))).alias("low"),
        F.lower(F.coalesce(e["type"], F.lit(""))).alias("kind"),
    ))
    found = F.transform(prepared, lambda e: F.struct(
        e["type"].alias("type"), e["filler"].alias("filler"), e["text"].alias("text"), e["low"].alias("low"),
        F.coalesce(
            F.when(_names(e["kind"], DEVICE_TYPES), _known(e["low"], devices)),
            F.when(_names(e["kind"], PLACE_TYPES), _known(e["low"], places)),
        ).alias("hit"),
    ))
    return F.transform(found, lambda e, i: F.struct(
        e["type"].alias("type"), e["filler"].alias("filler"), e["text"].alias("text"),
        F.when(
            F.contains(e["low"], e["hit"]["original"]),
            choose(e["hit"]["synonyms"],
                   draw(settings.seed, sample, "synonym_replacement", F.concat(F.lit("entity"), i.cast("string")))),
        ).otherwise(e["hit"]["original"]).alias("synonym"),
    ))


def _fold(sentence: Column, entities: Column, field: str, applies: Callable[[Column, Column], Column]) -> Column:
    """Entities taken in order; where ``applies``, text is replaced in the sentence and the filler."""
    def step(done: Column, e: Column) -> Column:
        swap = applies(done["sentence"], e)
        return F.struct(
            F.when(swap, replace_first(done["sentence"], e["text"], e[field]))
            .otherwise(done["sentence"]).alias("sentence"),
            F.concat(done["entities"], F.array(F.struct(
                e["type"].alias("type"),
                F.when(swap, e[field]).otherwise(e["filler"]).alias("filler"),
            ))).alias("entities"),
        )
    return F.aggregate(entities, _pair(sentence, F.array()), step)


def _holds_one(text: Column, terms: Iterable[str]) -> Column:
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(text, F.lit(term))
    return hit


def _compiled(terms: Iterable[object]) -> bool:
    """Whether a look-up is compiled: few terms, all of them text."""
    listed_terms = list(terms)
    return len(listed_terms) <= MAX_COMPILED and all(isinstance(term, str) for term in listed_terms)


def _scanned(entities: Column) -> dict[str, Column]:
    """``_types`` and ``_fillers``: all of them in one lower-case text each, a line for each.

    ``_gap``: whether an entity lacks either; ``_loose``: whether a filler starts or ends with a blank.
    """
    types, fillers = entities["type"], entities["filler"]
    gap = lambda texts: F.array_join(texts, "\n") != F.array_join(texts, "\n", "\0")
    lines = lambda texts: F.concat(F.lit("\n"), F.lower(F.array_join(texts, "\n")), F.lit("\n"))
    return {
        "_types": lines(types), "_fillers": lines(fillers), "_gap": gap(types) | gap(fillers),
        "_loose": F.array_join(fillers, "\n").rlike(rf"(?:^|\n)[{BLANK}]|[{BLANK}](?:\n|$)"),
    }


def _may_change(keywords: tuple[str, ...], held: Column) -> Column:
    """False only where no entity has one of the keywords in its type, or ``held`` rules all fillers out.

    An entity without type or without filler is not ruled out.
    """
    return F.coalesce((_holds_one(F.col("_types"), keywords) & held) | F.col("_gap"), F.lit(True))


def _swapped(prefix: str) -> tuple[Column, Column]:
    """Sentence and entities after the entity swaps of a method, which are NULL where nothing can change."""
    swap = F.col(f"{prefix}_swap")
    return F.when(swap.isNull(), F.col("sentence")).otherwise(swap["sentence"]), F.coalesce(swap["entities"], listed(F.col("entities")))


def _synonym_entities(prefix: str, settings: Settings) -> dict[str, Column]:
    sentence, entities = F.col("sentence"), listed(F.col("entities"))

    def applies(text: Column, e: Column) -> Column:
        ok = (e["synonym"] != "") & (e["synonym"] != e["text"])
        if settings.require_present:
            ok = ok & F.contains(text, e["synonym"])
        return F.coalesce(ok, F.lit(False))

    entries = [*settings.vocabulary.devices.items(), *settings.vocabulary.locations.items()]

    swap = _fold(sentence, entity_synonyms(entities, F.col("_key"), settings), "synonym", applies)
    if _compiled(x for term, synonyms in entries for x in (term, *synonyms)):
        # A term in the fillers with a synonym in the sentence, or the other way round.
        held, fillers = F.lit(False), F.col("_fillers")
        for term, synonyms in entries:
            forth, back = F.contains(fillers, F.lit(term)), _holds_one(fillers, (f"\n{synonym}\n" for synonym in synonyms))
            back = back | (F.col("_loose") & _holds_one(fillers, synonyms))
            if settings.require_present:
                forth, back = forth & _holds_one(sentence, synonyms), back & F.contains(sentence, F.lit(term))
            held = held | forth | back
        swap = F.when(_may_change(DEVICE_TYPES + PLACE_TYPES, held), swap)
    return {f"{prefix}_swap": swap}


def _words_round(prefix: str, text: Column) -> dict[str, Column]:
    return {f"{prefix}_words": words(text)}


def _low_words_round(prefix: str, settings: Settings) -> dict[str, Column]:
    """The words again, lower-case; they hold no blanks, so a plain split will do."""
    return {f"{prefix}_low": F.split(F.lower(F.array_join(f"{prefix}_words", " ")), " ")}


def _action_round(prefix: str, settings: Settings) -> dict[str, Column]:
    names = literal([name for name in settings.vocabulary.actions if name != ""], "array<string>")
    return {f"{prefix}_action": F.get(F.array_intersect(f"{prefix}_low", names), F.lit(0))}


def _action_replaced(prefix: str, sample: Column, settings: Settings) -> Column:
    """The first word that names an action replaced; words re-joined by single spaces."""
    w, action = F.col(f"{prefix}_words"), F.col(f"{prefix}_action")
    synonyms = literal(settings.vocabulary.actions, "map<string,array<string>>")
    at = F.array_position(F.col(f"{prefix}_low"), action).cast("int")
    new = choose(F.try_element_at(synonyms, action), draw(settings.seed, sample, "synonym_replacement", "action"))
    # NULL, an error, for an action without synonyms.
    return F.when(action.isNull(), F.array_join(w, " ")).otherwise(F.array_join(F.concat(
        F.slice(w, F.lit(1), at - 1), F.when(new.isNotNull(), F.array(new)), F.slice(w, at + 1, F.size(w))), " "))


def replace_action(df: DataFrame, settings: Settings) -> DataFrame:
    """``replaced``: each sentence with the first word that names an action replaced."""
    rounds = (lambda p, s: _words_round(p, F.col("sentence")), _low_words_round, _action_round,
              lambda p, s: {"replaced": _action_replaced(p, sample_key(df), s)})
    out = df
    for columns in rounds:
        out = out.withColumns(columns("_out", settings))
    return out.select(*df.columns, "replaced")


SYNONYMS: Rounds = (
    _synonym_entities,
    lambda p, s: _words_round(p, _swapped(p)[0]),
    _low_words_round,
    _action_round,
    lambda p, s: {f"{p}_sentence": _action_replaced(p, F.col("_key"), s), f"{p}_entities": _swapped(p)[1]},
)


def add_politeness(sentence: Column, entities: Column, sample: Column, settings: Settings) -> Column:
    """A polite prefix and a polite suffix, each with its own probability."""
    def phrase(options: list[str], probability: float, slot: str) -> Column:
        if not options:
            return F.lit(None).cast("string")
        gate = draw(settings.seed, sample, "politeness_addition", f"{slot}_gate")
        pick = draw(settings.seed, sample, "politeness_addition", slot)
        return F.when(chance(gate, probability), choose(literal(options, "array<string>"), pick))

    prefix = phrase(settings.vocabulary.prefixes, settings.prefix_chance, "prefix")
    suffix = phrase(settings.vocabulary.suffixes, settings.suffix_chance, "suffix")
    return _pair(F.concat_ws(" ", prefix, sentence, suffix), listed(entities))


def _moved(sentence: Column, markers: tuple[str, ...], keep_tail: bool) -> tuple[Column, Column]:
    """(found, text with the first marked expression moved to the front)."""
    one = "|".join(map(re.escape, markers))
    word = rf"[{NO_BLANK}&&[^,]]"
    # The lead runs from the start of the marker's line. Anchoring it there keeps
    # the search linear, and the tests skip it for most sentences.
    pattern = rf"(?:^|\n)([^\n]*?)({one}) ({word}+)([{BLANK}]|,|$)"
    found = sentence.rlike(rf"(?:{one}) {word}")
    if markers and _compiled(markers):
        found = _holds_one(sentence, [f"{marker} " for marker in markers]) & found
    lead, marker, words_moved, after = (F.regexp_extract(sentence, pattern, i) for i in (1, 2, 3, 4))
    text = F.concat(marker, F.lit(" "), words_moved, F.lit(", "), strip(lead), after)
    if keep_tail:
        text = F.concat(text, F.regexp_extract(sentence, rf"{pattern}((?s).*)$", 5))
    return found, text


def restructure(sentence: Column, entities: Column, sample: Column, settings: Settings) -> Column:
    """The first time expression, or else the first place expression, moved to the front."""
    timed, by_time = _moved(sentence, settings.time_markers, settings.keep_tail)
    placed, by_place = _moved(sentence, settings.place_markers, settings.keep_tail)
    return _pair(F.when(timed, by_time).when(placed, by_place).otherwise(sentence), listed(entities))


def time_synonyms(entities: Column, sample: Column, settings: Settings) -> Column:
    """Entities with ``text`` and ``variation``, a drawn variation of the first time term in it."""
    times = entries_literal(settings.vocabulary.times)
    prepared = F.transform(listed(entities), lambda e: F.struct(
        e["type"].alias("type"), e["filler"].alias("filler"),
        strip(F.coalesce(e["filler"], F.lit(""))).alias("text"),
        F.lower(strip(F.coalesce(e["filler"], F.lit("")))).alias("low"),
        _names(F.lower(F.coalesce(e["type"], F.lit(""))), TIME_TYPES).alias("timed"),
    ))
    return F.transform(prepared, lambda e, i: F.struct(
        e["type"].alias("type"), e["filler"].alias("filler"), e["text"].alias("text"),
        F.when(e["timed"], choose(
            F.get(F.filter(times, lambda v: F.contains(e["low"], v["original"])), F.lit(0))["synonyms"],
            draw(settings.seed, sample, "time_variation", F.concat(F.lit("entity"), i.cast("string"))),
        )).alias("variation"),
    ))


def _time_entities(prefix: str, settings: Settings) -> dict[str, Column]:
    entities, times = listed(F.col("entities")), settings.vocabulary.times
    swap = _fold(F.col("sentence"), time_synonyms(entities, F.col("_key"), settings), "variation",
                 lambda text, e: F.coalesce(e["variation"] != "", F.lit(False)))
    if _compiled(times):
        swap = F.when(_may_change(TIME_TYPES, _holds_one(F.col("_fillers"), times)), swap)
    return {f"{prefix}_swap": swap}


def _time_text(prefix: str, settings: Settings) -> dict[str, Column]:
    return {f"{prefix}_text": _swapped(prefix)[0]}


def _time_round(prefix: str, settings: Settings) -> dict[str, Column]:
    """The number, from 1, of the first time term in the whole sentence."""
    low, times = F.lower(f"{prefix}_text"), list(settings.vocabulary.times)
    held = F.array(*[F.contains(low, F.lit(term)) for term in times]) if _compiled(times) and times else \
        F.transform(literal(times, "array<string>"), lambda term: F.contains(low, term))
    return {f"{prefix}_at": F.array_position(held, True)}


def _time_drawn(prefix: str, settings: Settings) -> dict[str, Column]:
    at, times = F.col(f"{prefix}_at"), settings.vocabulary.times
    synonyms = F.get(literal(list(times.values()), "array<array<string>>"), (at - 1).cast("int"))
    return {f"{prefix}_new": F.when(at > 0, choose(synonyms, draw(settings.seed, F.col("_key"), "time_variation", "general")))}


def _time_replaced(prefix: str, settings: Settings) -> dict[str, Column]:
    text, at, new, times = F.col(f"{prefix}_text"), F.col(f"{prefix}_at"), F.col(f"{prefix}_new"), settings.vocabulary.times
    if _compiled(times):
        # A constant pattern is compiled once. The term is looked for before its surroundings.
        varied = F.when(new.isNull(), text)
        for i, term in enumerate(times, 1):
            quick = F.lit(rf"(?=(?iu:\Q{term}\E)){whole_term_pattern(term)}")
            varied = varied.when(at == i, replace_first_match(text, quick, new))
    else:
        patterns = literal([whole_term_pattern(term) for term in times], "array<string>")
        varied = F.when(new.isNull(), text).otherwise(replace_first_match(text, F.get(patterns, (at - 1).cast("int")), new))
    return {f"{prefix}_sentence": varied, f"{prefix}_entities": _swapped(prefix)[1]}


#: Time entities varied, then the first time term of the whole sentence.
TIMES: Rounds = (_time_entities, _time_text, _time_round, _time_drawn, _time_replaced)

METHODS: dict[str, Method | Rounds] = {
    "synonym_replacement": SYNONYMS,
    "politeness_addition": add_politeness,
    "sentence_restructuring": restructure,
    "time_variation": TIMES,
}


def _rounds(method: Method | Rounds) -> Rounds:
    if isinstance(method, tuple):
        return method
    return (
        lambda p, s: {f"{p}_out": method(F.col("sentence"), F.col("entities"), F.col("_key"), s)},
        lambda p, s: {f"{p}_{field}": F.col(f"{p}_out.{field}") for field in ("sentence", "entities")},
    )


def _made(df: DataFrame, methods: Mapping[str, Method | Rounds], settings: Settings) -> DataFrame:
    """Adds ``<prefix>_sentence`` and ``<prefix>_entities`` of each method.

    One method comes after the other: the lambdas of each cut the generated code, whose methods would get too long for
    the JVM to compile if the rounds of all went side by side.
    """
    df = df.withColumns(_scanned(listed(F.col("entities"))))
    for prefix, method in methods.items():
        for take in _rounds(method):
            df = df.withColumns(take(prefix, settings))
    return df


def sample_key(df: DataFrame) -> Column:
    """What choices are keyed by: the sample id, or the sentence of a table without one."""
    return F.col("sample_id").cast("string") if "sample_id" in df.columns else F.col("sentence")


def rewrite(df: DataFrame, method: str | Method, settings: Settings) -> DataFrame:
    """One method applied to every utterance, ungated."""
    made = _made(df.withColumn("_key", sample_key(df)), {"_out": METHODS[method] if isinstance(method, str) else method}, settings)
    return made.select(
        *df.columns,
        F.col("_out_sentence").alias("augmented_sentence"),
        F.col("_out_entities").alias("augmented_entities"),
    )


def candidates(
    df: DataFrame,
    settings: Settings,
    num_variations: int | None = None,
    extra_methods: Mapping[str, Method] | None = None,
    extra_checks: Mapping[str, Callable[[Column, Column, Column], Column]] | None = None,
) -> DataFrame:
    """Every variant of every utterance with its metadata and its verdict.

    One row per utterance and method, for the first ``num_variations`` methods
    of the settings. ``quality_passed`` is the gate's verdict, ``failed_rule``
    the first rule broken, ``error`` set where no verdict is possible.
    ``extra_checks`` are the user's rules, see ``quality.with_user_checks``.
    """
    known = {**METHODS, **(extra_methods or {})}
    wanted = settings.methods[:settings.max_variations if num_variations is None else num_variations]
    unknown = [m for m in wanted if m not in known]
    if unknown:
        raise ValueError(f"Unknown augmentation method: {unknown[0]}")

    key = sample_key(df)
    carried = [c for c in ("sample_id", "seq") if c in df.columns]
    prepared = df.select(
        *carried, "sentence", "intent", listed(F.col("entities")).alias("entities"),
        key.alias("_key"), F.size(words(F.col("sentence"))).alias("_was"))
    sentence, entities, was = F.col("sentence"), F.col("entities"), F.col("_was")

    # Columns of their own, so that each method is compiled and evaluated once: lambdas are interpreted.
    outs = [f"_out{i}" for i in range(len(wanted))]
    made = _made(prepared, {o: known[m] for o, m in zip(outs, wanted)}, settings)
    # Most variants of some methods equal their original, whose words are counted already.
    # One lambda for all of them: as so many columns they would make a method too long for the JVM to compile.
    split = made.withColumn("_lows", F.transform(
        F.array(*[f"{o}_sentence" for o in outs]), lambda text: F.when(text != sentence, words(F.lower(text)))))

    def judged(method: str, i: int, o: str) -> Column:
        made_sentence, made_entities, low = F.col(f"{o}_sentence"), F.col(f"{o}_entities"), F.get("_lows", F.lit(i))
        size = F.when(low.isNull(), was).otherwise(F.size(low))
        rule = first_failed_rule(sentence, made_sentence, entities, made_entities, was, size, low, settings)
        return F.struct(
            F.lit(method).alias("method"),
            made_sentence.alias("augmented_sentence"),
            made_entities.alias("augmented_entities"),
            size.alias("augmented_length"),
            F.when((was > 0) & made_sentence.isNotNull(), rule).alias("failed_rule"),
        )

    # A variant is judged before the explode: a later filter on the verdict then
    # reads a field and never re-evaluates the rewriting.
    # The array is a column too: what stands inside a generator is interpreted, whatever it is. The outer form, as
    # the optimizer would repeat the whole rewriting below it to test that the array isn't empty.
    tries = F.array(*[judged(m, i, o) for i, (m, o) in enumerate(zip(wanted, outs))])
    fanned = split.select(*carried, "sentence", "intent", "entities", "_was", tries.alias("_tries")).select(
        *carried, "sentence", "intent", "entities", "_was", F.posexplode_outer("_tries").alias("method_no", "_try"))
    made_one = F.col("_try.augmented_sentence").isNotNull()
    error = F.when(was == 0, "division by zero").when(~made_one, "no synonym to choose")
    variants = fanned.select(
        *carried, "method_no",
        sentence.alias("original_sentence"),
        F.col("_try.augmented_sentence"),
        F.col("intent").alias("original_intent"),
        F.col("intent").alias("augmented_intent"),
        entities.alias("original_entities"),
        F.col("_try.augmented_entities"),
        F.col("_try.method"),
        F.struct(
            F.col("_try.method").alias("method"),
            was.alias("original_length"),
            F.col("_try.augmented_length").alias("augmented_length"),
            (F.col("_try.augmented_length") / F.nullif(was, F.lit(0))).alias("length_ratio"),
            (F.size("_try.augmented_entities") == F.size(entities)).alias("entity_count_preserved"),
        ).alias("metadata"),
        (F.col("_try.failed_rule").isNull() & (was > 0) & made_one).alias("quality_passed"),
        F.col("_try.failed_rule"),
        error.alias("error"),
    )
    return with_user_checks(variants, extra_checks or {})


def accepted(variants: DataFrame) -> DataFrame:
    return variants.filter("quality_passed").drop("failed_rule", "error")


def rejected(variants: DataFrame) -> DataFrame:
    """The issue table: what was tried, and why it was dropped."""
    return variants.filter("NOT quality_passed").select(
        *[c for c in ("sample_id", "seq", "method_no") if c in variants.columns],
        "original_sentence",
        F.when(F.col("error").isNull(), F.col("augmented_sentence")).alias("augmented_sentence"),
        "method",
        F.when(F.col("error").isNull(), "quality_check_failed").alias("reason"),
        "failed_rule", "error",
    )
