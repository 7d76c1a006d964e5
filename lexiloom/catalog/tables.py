"""Curation inputs derived from the driver's tables: whole tables, whole texts.

``documents`` gives one utterance per sentence, ``conversations`` one per turn
(the whole turn), ``labels`` with ``documents`` a review table, and ``events``
entity JSON in various states of repair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.config import Settings, Vocabulary
from lexiloom.functions.text import strip, words
from lexiloom.schema import ENTITIES_DDL

#: Into how many partitions to deal the source tables; None leaves their scans alone. For
#: files of a single row group, which are one task otherwise.
PARTITIONS: int | None = None

# Frequent words of the four languages of the tables.
VOCABULARY = Vocabulary(
    devices={
        "the": ["this", "that"], "de": ["du", "des"], "la": ["le", "les"],
        "der": ["die", "das"], "er": ["es", "re"],
    },
    locations={"and": ["with", "for"], "und": ["von", "zu"], "que": ["el", "es"], "et": ["ou", "un"]},
    actions={
        "the": ["a", "this", "that"], "is": ["was", "be"], "de": ["del", "des", "von"],
        "la": ["le", "les"], "of": ["for"],
    },
    times={"on": ["upon", "at"], "en": ["dans"], "der": ["dem", "den"], "to": ["till", "until", "unto"]},
    prefixes=["Please", "Por favor", "Kindly"],
    suffixes=["now", "merci", "bitte", "gracias"],
)
SETTINGS = Settings(
    vocabulary=VOCABULARY,
    time_markers=("at", "by", "als"),
    place_markers=("in", "en", "von"),
    seed=7,
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df if PARTITIONS is None else df.repartition(PARTITIONS, *keys)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Whole documents, pruned to some columns."""
    return dealt(load(spark, sf_dir, "documents").select(*columns), "doc_id")


def _entity(when: Column, kind: Column, filler: Column) -> Column:
    return F.when(when, F.struct(kind.alias("type"), filler.alias("filler")))


def _entities(w: Column, n: Column, group: Column) -> Column:
    """First, middle and last word of a sentence, typed by length."""
    first, middle, last = F.get(w, F.lit(0)), F.get(w, F.floor(n / 2).cast("int")), F.get(w, n - 1)
    size = F.char_length(middle)
    return F.array_compact(F.array(
        _entity(n >= 1, F.when(F.char_length(first) <= 4, "device")
                .otherwise(F.concat(F.lit("device_"), group)), first),
        _entity(n >= 3, F.when(size <= 3, "time_at").when(size <= 6, "target_number").when(size <= 9, "duration")
                .otherwise(F.concat(F.lit("changing_value_"), size.cast("string"))), middle),
        _entity(n >= 2, F.lit("living_space"), last),
    )).cast(ENTITIES_DDL)


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sentence of every document; the intent is the language and a length class."""
    pieces = documents(spark, sf_dir, "doc_id", "lang", "text").select(
        "doc_id", "lang", F.posexplode(F.split("text", "[.!?\n]+")).alias("sent_no", "piece"))
    rows = pieces.select("doc_id", "sent_no", "lang", strip(F.col("piece")).alias("sentence")).filter("sentence <> ''")
    rows = rows.withColumn("w", words(F.col("sentence"))).withColumn("n", F.size("w"))
    return rows.select(
        F.concat_ws("-", "doc_id", "sent_no").alias("sample_id"),
        # The leading field groups documents, so that counts per group and intent stay few.
        F.struct(F.shiftright("doc_id", 12).alias("block"), F.col("doc_id").alias("doc"),
                 F.col("sent_no").alias("sent")).alias("seq"),
        "sentence",
        F.concat("lang", F.lit("/"), F.when(F.col("n") <= 2, "short").when(F.col("n") <= 6, "medium")
                 .otherwise("long")).alias("intent"),
        _entities(F.col("w"), F.col("n"), F.col("lang")).alias("entities"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation turn, the whole turn as its sentence and the role as its intent."""
    said = dealt(load(spark, sf_dir, "conversations"), "conv_id")
    rows = said.withColumn("w", words(F.col("text"))).withColumn("n", F.size("w"))
    return rows.select(
        F.concat_ws("-", "conv_id", "turn").alias("sample_id"),
        F.struct(F.shiftright("conv_id", 12).alias("block"), F.col("conv_id").alias("conv"),
                 F.col("turn").alias("turn")).alias("seq"),
        F.col("text").alias("sentence"),
        F.col("role").alias("intent"),
        _entities(F.col("w"), F.col("n"), F.col("role")).alias("entities"),
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as the original and the turn after it as its counterpart."""
    t = turns(spark, sf_dir)
    conv, turn = F.col("seq.conv"), F.col("seq.turn")
    first = t.select(conv.alias("conv"), turn.alias("turn"), "sample_id",
                     *[F.col(c).alias(f"original_{c}") for c in ("sentence", "intent", "entities")])
    second = t.select(conv.alias("conv"), (turn - 1).alias("turn"),
                      *[F.col(c).alias(f"augmented_{c}") for c in ("sentence", "intent", "entities")])
    return first.join(second, ["conv", "turn"])


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review row per labelled document, with the gaps and slips of hand-filled tables."""
    d = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents"), "doc_id")
    i = F.col("doc_id")

    def cases(by: int, values: list) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for residue, value in enumerate(values):
            if value is not None:
                out = out.when(i % by == residue, value if isinstance(value, Column) else F.lit(value))
        return out

    entity = F.concat(F.lit('[{"type": "'), "source", F.lit('", "filler": "'), "lang", F.lit('"}]'))
    entities = cases(8, [
        entity, F.lit('[{"type": "cut'), "", None, '{"type": "bare", "filler": "object"}', "null",
        F.concat(F.lit("[{type: "), "source", F.lit(", filler: "), "lang", F.lit("}]")), entity,
    ])
    return d.select(
        i.cast("string").alias("Sample_ID"),
        F.col("text").alias("Original_Sentence"),
        F.col("lang").alias("Original_Intent"),
        entity.alias("Original_Entities"),
        F.concat(F.lit("Please "), "text").alias("Augmented_Sentence"),
        F.col("lang").alias("Augmented_Intent"),
        entities.alias("Augmented_Entities"),
        F.when(F.col("lang") == "en", "synonym_replacement").otherwise("politeness_addition").alias("Augmentation_Method"),
        cases(7, [None, "", "abc", "NaN", " 4 ", "4.5", (F.col("quality") * 4 + 1).cast("string")]).alias("Quality_Score_1_5"),
        cases(5, ["5", None, "3.0", (5 - F.col("toxic") * 3).cast("string"), "4d"]).alias("Naturalness_Score_1_5"),
        F.col("source").alias("Comments"),
        cases(6, [" YES ", "no", None, "", "yes", "maybe"]).alias("Approved_Yes_No"),
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of review decisions: every event writes one field of one labelled document."""
    e = load(spark, sf_dir, "events")
    field = (
        F.when(F.col("event_type") == "click", "Quality_Score_1_5")
        .when(F.col("event_type") == "view", "Naturalness_Score_1_5")
        .when(F.col("event_type") == "error", "Comments")
        .otherwise("Approved_Yes_No")
    )
    value = F.when(F.col("event_type").isin("click", "view"), (F.col("event_id") % 5 + 1).cast("string")).otherwise(
        F.when(F.col("event_type") == "signup", "yes").otherwise("no"))
    return e.select(F.col("user_id").cast("string").alias("Sample_ID"), field.alias("field"), value.alias("value"),
                    F.struct("ts", "event_id").alias("at"))


def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as entity JSON: intact, with bare words, quoted, without commas, cut off, blank."""
    e = dealt(load(spark, sf_dir, "events").select("event_id", "event_type", "props"), "event_id")
    k = F.regexp_extract("props", r"(\d+)", 1)
    i = F.col("event_id") % 8
    text = (
        F.when(i == 0, F.concat(F.lit("["), "props", F.lit("]")))
        .when(i == 1, F.concat(F.lit("[{k: "), k, F.lit("}]")))
        .when(i == 2, F.concat(F.lit('"[{type: '), "event_type", F.lit(", filler: "), k, F.lit(' }]"')))
        .when(i == 3, F.concat(F.lit("[{type: "), "event_type", F.lit("} {filler: "), k, F.lit(".5}]")))
        .when(i == 4, F.concat(F.lit("[{k: "), k))
        .when(i == 5, F.lit("  "))
        .when(i == 6, F.concat(F.lit(" [{ ok : true , none : null, at: "), k, F.lit(":30, name: "), "event_type", F.lit("}] ")))
    )
    return e.select("event_id", text.alias("text"))
