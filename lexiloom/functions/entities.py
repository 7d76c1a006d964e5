"""Expressions over ``array<struct<type, filler>>`` and over its JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.text import BLANK, clean_text, let, strip
from lexiloom.schema import ENTITIES, ENTITIES_DDL


def listed(entities: Column) -> Column:
    """NULL read as no entities."""
    return F.coalesce(entities, F.array().cast(ENTITIES_DDL))


def types_of(entities: Column, missing: str = "") -> Column:
    return F.transform(listed(entities), lambda e: F.coalesce(e["type"], F.lit(missing)))


def normalise(entities: Column) -> Column:
    """Type and filler cleaned; entities left without either are dropped."""
    cleaned = F.transform(
        listed(entities),
        lambda e: F.struct(clean_text(e["type"]).alias("type"), clean_text(e["filler"]).alias("filler")),
    )
    return F.filter(cleaned, lambda e: (e["type"] != "") & (e["filler"] != ""))


def objects(entities: Column) -> Column:
    """The objects of a VARIANT array as typed entities; what is no array holds none."""
    items = F.coalesce(F.try_variant_get(entities, "$", "array<variant>"), F.array().cast("array<variant>"))
    return F.transform(F.filter(items, is_object), lambda e: F.struct(
        F.try_variant_get(e, "$.type", "string").alias("type"),
        F.try_variant_get(e, "$.filler", "string").alias("filler"),
    ))


def normalise_variant(entities: Column) -> Column:
    """``normalise`` over a VARIANT column; elements that are not objects are dropped."""
    return normalise(objects(entities))


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def entities_json(entities: Column) -> Column:
    return F.to_json(listed(entities))


def parse_entities(text: Column) -> Column:
    """Entity JSON text → ``struct<ok, entities>``.

    Malformed text is not ok; blank text, and JSON that is not an array, hold
    no entities. ``from_json`` alone would turn a bare object into an array.
    """
    plain = strip(F.coalesce(text, F.lit("")))
    value = F.try_parse_json(plain)
    none = F.array().cast(ENTITIES_DDL)
    is_array = F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))
    return F.struct(
        ((plain == "") | value.isNotNull()).alias("ok"),
        F.when(is_array, F.coalesce(F.from_json(plain, ENTITIES), none)).otherwise(none).alias("entities"),
    )


# Marks around a value between the pass that finds it and the passes that quote it.
_OPEN, _CLOSE = "\x01", "\x02"
_GAP = f"[{BLANK}]*"
# The JSON literals that stay unquoted.
_LITERAL = r"true|false|null|-?\d+(?:\.\d+)?"


def _quote_pairs(text: Column, prefix: str) -> Column:
    """``key: value`` → ``"key": value`` with the value quoted unless it is a literal."""
    marked = F.regexp_replace(text, rf"({prefix})([A-Za-z0-9_]+){_GAP}:{_GAP}([^,\]}}]+)",
                              rf'$1"$2": {_OPEN}$3{_CLOSE}')
    literals = F.regexp_replace(marked, rf"{_OPEN}{_GAP}({_LITERAL}){_GAP}{_CLOSE}", "$1")
    return F.regexp_replace(literals, rf"{_OPEN}{_GAP}([^{_CLOSE}]*?){_GAP}{_CLOSE}", '"$1"')


def repair_json(text: Column) -> Column:
    """Entity JSON text made valid, or ``[]``; text that is valid already is kept.

    Bare keys and values are quoted. If that is not enough, the objects of an
    array are repaired one by one; a single hopeless object empties the array.
    """
    def valid(t: Column) -> Column:
        return F.try_parse_json(t).isNotNull()

    def repaired(body: Column) -> Column:
        return let(_quote_pairs(body, rf"[{{,]{_GAP}"), lambda quoted: F.when(valid(quoted), quoted)
                   .when(quoted.startswith("[") & quoted.endswith("]"), let(_object_texts(quoted), lambda objects: F.when(
                       F.forall(objects, valid), F.concat(F.lit("["), F.array_join(objects, ","), F.lit("]")))
                       .otherwise("[]")))
                   .otherwise("[]"))

    def unwrapped(plain: Column) -> Column:
        wrapped = (F.char_length(plain) > 1) & plain.startswith('"') & plain.endswith('"')
        body = F.when(wrapped, F.substring(plain, F.lit(2), F.char_length(plain) - 2)).otherwise(plain)
        return let(body, lambda b: F.when(b == "", "[]").when(valid(b), b).otherwise(repaired(b)))

    return let(strip(F.coalesce(text, F.lit(""))), unwrapped)


def _object_texts(array: Column) -> Column:
    """The texts of an array's objects, each with its pairs quoted."""
    inner = F.substring(array, F.lit(2), F.char_length(array) - 2)
    pieces = F.filter(F.split(inner, rf"(?={_GAP}\{{)"), lambda p: strip(p) != "")
    return F.transform(pieces, lambda p: _quote_pairs(
        F.when(p.startswith("{"), p).otherwise(F.concat(F.lit("{"), strip(p))), ""))
