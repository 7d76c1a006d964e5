"""Writing datasets and reports. Every sink is a folder of part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexiloom.config import Settings
from lexiloom.functions.entities import entities_json, listed
from lexiloom.operators.review import repair_entities
from lexiloom.schema import ENTITIES
from lexiloom.session import shuffled_once

_ENGINE_COLUMNS = ("seq", "sample_id")
#: The rows of a compressed file, which is read by one task.
_COMPRESSED_ROWS = 200_000


def write_jsonl(df: DataFrame, path: str, mode: str = "error", without: tuple[str, ...] = _ENGINE_COLUMNS,
                compression: str = "none") -> str:
    """UTF-8 JSON lines; NULL fields are written out, the engine's own columns are not."""
    kept = df.select(*[c for c in df.columns if c not in without])
    kept.write.mode(mode).option("ignoreNullFields", False).option("compression", compression).json(path)
    return path


def write_array(df: DataFrame, path: str, mode: str = "error", without: tuple[str, ...] = _ENGINE_COLUMNS,
                compression: str = "none") -> str:
    """One JSON array, in the order of ``seq`` where there is one.

    The part files of the folder, one after the other, are the document, and all
    of them appear at once, when the last is written. No rows give an empty array.
    Compressed files can't be split, so there are more of them, of 200,000 rows at most.
    """
    most = 0 if compression == "none" else _COMPRESSED_ROWS

    def write(lines: DataFrame) -> str:
        lines.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", most).text(path)
        return path

    kept = F.struct(*[c for c in df.columns if c not in without])
    order = F.col("seq") if "seq" in df.columns else F.monotonically_increasing_id()
    text = df.select(order.alias("_order"), F.to_json(kept, {"ignoreNullFields": "false"}).alias("value"))
    # Unlike orderBy, this shuffles whatever order the rows come in, and so the jobs below find them alike.
    ordered = text.repartitionByRange("_order").sortWithinPartitions("_order").select("value")
    rows = shuffled_once(ordered).select("value", F.monotonically_increasing_id().alias("_at"))
    ends = rows.agg(F.min("_at").alias("first"), F.max("_at").alias("last")).first()
    if ends["first"] is None:
        return write(df.sparkSession.range(1).select(F.lit("[]").alias("value")))
    opening = F.when(F.col("_at") == ends["first"], "[").otherwise(",")
    closing = F.when(F.col("_at") == ends["last"], "]").otherwise("")
    return write(rows.select(F.concat(opening, "value", closing).alias("value")))


def _write_csv(df: DataFrame, path: str, mode: str, compression: str = "none") -> str:
    df.write.mode(mode).option("compression", compression).option("header", True).option("quote", '"').option("escape", '"') \
        .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_augmentations(augmentations: DataFrame, path: str, stamp: str, mode: str = "error") -> str:
    """The augmentations as JSON lines and, next to them, one row describing the run.

    The rows are counted while they are written, not by another pass. Variants repeat their originals, so the
    lines are gzipped, which readers of JSON lines unpack as they go.
    """
    counted = Observation()
    watched = augmentations.drop("method_no").observe(counted, F.count(F.lit(1)).alias("n"))
    write_jsonl(watched, f"{path}/augmentations", mode, compression="gzip")
    envelope = augmentations.sparkSession.range(1).select(
        F.lit(stamp).alias("timestamp"), F.lit(counted.get["n"]).cast("bigint").alias("total_augmentations"),
        F.current_timestamp().cast("string").alias("generation_timestamp"))
    envelope.write.mode(mode).json(f"{path}/metadata")
    return path


def flattened(df: DataFrame, settings: Settings) -> DataFrame:
    """Sentence, intent, entities as JSON text and, with metadata on, the source."""
    columns = [
        F.coalesce("sentence", F.lit("")).alias("sentence"),
        F.coalesce("intent", F.lit("")).alias("intent"),
        entities_json(F.col("entities")).alias("entities"),
    ]
    if settings.add_metadata:
        source = F.col("metadata.source") if "metadata" in df.columns else F.lit(None)
        columns.append(F.coalesce(source, F.lit("unknown")).alias("source"))
    return df.select(*columns)


def write_dataset(df: DataFrame, path: str, settings: Settings, mode: str = "error") -> str:
    """A merged dataset in the format of the settings; metadata is dropped unless it is on."""
    kept = df if settings.add_metadata else df.drop("metadata")
    if settings.output_format == "jsonl":
        return write_jsonl(kept, path, mode)
    if settings.output_format == "json":
        return write_array(kept, path, mode)
    if settings.output_format == "csv":
        return _write_csv(flattened(kept, settings), path, mode)
    raise ValueError(f"Unsupported format: {settings.output_format}")


def training_table(df: DataFrame) -> DataFrame:
    return df.select(
        "sentence", "intent",
        entities_json(F.col("entities")).alias("entities_json"),
        F.size(listed(F.col("entities"))).alias("entity_count"),
    )


def export_for_training(df: DataFrame, folder: str, fmt: str = "jsonl", mode: str = "error", compression: str = "none") -> str:
    """A folder of JSON lines, of one JSON array or of CSV."""
    if fmt == "jsonl":
        return write_jsonl(df, f"{folder}/training_data.jsonl", mode, compression=compression)
    if fmt == "json":
        return write_array(df, f"{folder}/training_data.json", mode, compression=compression)
    if fmt == "csv":
        return _write_csv(training_table(df), f"{folder}/training_data.csv", mode, compression)
    raise ValueError(f"Unsupported format: {fmt}")


def write_review(review: DataFrame, path: str, mode: str = "error") -> str:
    """A review table as CSV. A numbered batch is one partition and so one file."""
    return _write_csv(review, path, mode)


def parsed_review(review: DataFrame) -> DataFrame:
    """A reviewed table with repaired entities as arrays."""
    def parse(name: str) -> Column:
        return F.coalesce(F.from_json(name, ENTITIES), listed(F.lit(None).cast(ENTITIES))).alias(name)

    fixed = repair_entities(review).drop("repaired")
    names = ("Original_Entities", "Augmented_Entities")
    return fixed.select(*[parse(c) if c in names else F.col(c) for c in fixed.columns])


def export_reviewed(review: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> str:
    """A reviewed table with its entity JSON repaired; arrays instead of text for JSON."""
    if fmt == "csv":
        return _write_csv(repair_entities(review).drop("repaired"), path, mode)
    if fmt == "json":
        return write_array(parsed_review(review), path, mode)
    raise ValueError(f"Unsupported format: {fmt}")


def write_final(final: DataFrame, path: str, batch: str, fmt: str = "jsonl", mode: str = "overwrite") -> str:
    """Final samples under their batch; entity arrays become JSON text in CSV.

    Only the batch is replaced, so a job that runs again leaves it as it was.
    """
    tagged = final.withColumn("batch", F.lit(batch))
    if fmt == "jsonl":
        tagged.write.mode(mode).partitionBy("batch").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        arrays = [f.name for f in final.schema.fields if f.dataType == ENTITIES or f.name.endswith("entities")]
        flat = tagged.withColumns({c: entities_json(F.col(c)) for c in arrays})
        flat.write.mode(mode).partitionBy("batch").option("partitionOverwriteMode", "dynamic").option("header", True).option("escape", '"') \
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        raise ValueError(f"Unsupported output format: {fmt}")
    return path


def write_report(one_row: DataFrame, path: str, mode: str = "error") -> str:
    """A one-row report as JSON."""
    one_row.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)
    return path
