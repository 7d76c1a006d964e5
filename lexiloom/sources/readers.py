"""Reading utterances, review tables and training sets.

Rows read from files carry ``seq`` (file, block, row), the order of the lines,
and ``sample_id``, a digest of the content that stays the same however the
files are split.
"""

from __future__ import annotations

import csv
from fnmatch import fnmatch
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.entities import is_object, objects
from lexiloom.schema import REVIEW_COLUMNS, REVIEW_REQUIRED, UTTERANCE
from lexiloom.sources import pieces
from lexiloom.sources.arrays import elements
from lexiloom.sources.quoted import records

_CORRUPT = "_corrupt"
# Whether a line parsed depends on the columns asked for, so the test names them
# all: a count then sees the same lines as a full read. The extra terms are
# never true.
_PARSED = f"({_CORRUPT} IS NULL OR char_length(sentence) < 0 OR char_length(intent) < 0 OR (entities IS NULL AND entities IS NOT NULL))"


def _with_order(df: DataFrame) -> DataFrame:
    """``seq`` = file, start of the split within it, row within the task.

    Splits of one file are ordered by their start and rows of one split by
    their row number, so the triple follows the lines of each file.
    """
    return df.withColumn("seq", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))


def _with_id(df: DataFrame) -> DataFrame:
    content = F.concat_ws("|", "sentence", "intent", F.to_json("entities"))
    return df.withColumn("sample_id", F.md5(content))


def _any_entities(extra_fields: list[T.StructField] | None) -> T.StructType:
    """The columns of an utterance, its entities in whatever shape they have."""
    first = [f for f in UTTERANCE.fields if f.name != "entities"]
    return T.StructType([*first, T.StructField("entities", T.VariantType()), *(extra_fields or []), T.StructField(_CORRUPT, T.StringType())])


def scan_utterances(spark: SparkSession, path: str | list[str],
                    extra_fields: list[T.StructField] | None = None, numbered: bool | str = False) -> DataFrame:
    """JSON lines as read, unparsable ones held in ``_corrupt``; blank lines are skipped.

    Entities may have any shape: what is an object counts, the rest is left to
    ``odd_entities``. Keys outside the schema are kept by naming them in ``extra_fields``.

    ``numbered`` counts the lines first: ``seq`` is then (file, line), the same
    however the files are split, for one more pass over them. ``numbered="folder"``
    counts through the part files of each folder, and ``seq`` is (folder, line).
    """
    schema = _any_entities(extra_fields)
    if numbered:
        lines = pieces.numbered(spark, path, folders=numbered == "folder").filter(F.trim("value") != "")
        parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": _CORRUPT})
        return lines.select(F.struct("file", "line").alias("seq"), parsed.alias("_row")).select("_row.*", "seq")
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    return _with_order(rows)


def read_utterances(spark: SparkSession, path: str | list[str],
                    extra_fields: list[T.StructField] | None = None, numbered: bool | str = False) -> DataFrame:
    """Lines that parse and have a sentence and an intent; entities default to none."""
    rows = scan_utterances(spark, path, extra_fields, numbered)
    good = rows.filter(f"{_PARSED} AND sentence IS NOT NULL AND intent IS NOT NULL")
    return _with_id(good.drop(_CORRUPT).withColumn("entities", objects(F.col("entities"))))


def odd_entities(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(seq, reason, entity)`` of entities that the readers leave out of a row that they keep."""
    rows = scan_utterances(spark, path).filter(_PARSED)
    items = F.try_variant_get("entities", "$", "array<variant>")
    given = F.col("entities").isNotNull() & ~F.is_variant_null("entities")
    odd = F.when(items.isNotNull(), F.filter(items, lambda e: ~is_object(e))).when(given, F.array("entities"))
    return rows.select("seq", F.explode(odd).alias("entity")).select(
        "seq", F.lit("Entity is not an object").alias("reason"), F.to_json("entity").alias("entity"))


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What ``read_utterances`` leaves out, with the reason."""
    rows = scan_utterances(spark, path)
    reason = (
        F.when(~F.expr(f"coalesce({_PARSED}, false)"), "Invalid JSON")
        .when(F.col("sentence").isNull(), "Missing 'sentence' field")
        .when(F.col("intent").isNull(), "Missing 'intent' field")
    )
    return rows.select("seq", reason.alias("reason"), F.col(_CORRUPT).alias("line")).filter("reason IS NOT NULL")


def read_lenient(spark: SparkSession, path: str | list[str],
                 extra_fields: list[T.StructField] | None = None, numbered: bool | str = False) -> DataFrame:
    """Every line that parses, whatever it lacks."""
    rows = scan_utterances(spark, path, extra_fields, numbered)
    kept = F.when(F.try_variant_get("entities", "$", "array<variant>").isNotNull(), objects(F.col("entities")))
    return _with_id(rows.filter(_PARSED).drop(_CORRUPT).withColumn("entities", kept))


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Utterances with ``entities`` left as a VARIANT, for checking and normalising odd shapes."""
    rows = spark.read.schema(f"sentence string, intent string, entities variant, {_CORRUPT} string") \
        .option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    parsed = f"{_CORRUPT} IS NULL OR char_length(sentence) < 0 OR char_length(intent) < 0"
    kept = _with_order(rows).filter(parsed).drop(_CORRUPT)
    content = F.concat_ws("|", "sentence", "intent", F.to_json("entities"))
    return kept.withColumn("sample_id", F.md5(content))


def read_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """The objects of files that are one JSON array each, with ``seq`` (file, block, row), their order."""
    parsed = elements(spark, path).select(F.struct("file", "block", "row").alias("seq"), F.from_json("text", schema).alias("_row"))
    return parsed.select("_row.*", "seq")


def read_training_set(spark: SparkSession, path: str | list[str], one_array: bool = False) -> DataFrame:
    """A training set: JSON lines or, with ``one_array``, files that are one JSON array each, split like others."""
    provenance = "_augmented boolean, _augmentation_method string, _original_sentence string, " \
        "_quality_score int, _naturalness_score int, _review_timestamp string, _sample_id bigint"
    schema = T.StructType(UTTERANCE.fields + T.StructType.fromDDL(provenance).fields)
    if one_array:
        return _with_id(read_array(spark, path, schema))
    return _with_id(_with_order(spark.read.schema(schema).json(path)))


def _headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], tuple[list[str], int]]:
    """The files of a batch by their header, and the size of the largest. Only first lines, one of each file, reach the driver."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"), "value").filter("block = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "row").alias("header"), F.max("size").alias("size"))
    files = first.groupBy("header").agg(F.collect_list("file").alias("files"), F.max("size").alias("size")).collect()
    return {tuple(next(csv.reader([r["header"].lstrip("\ufeff")]), [])): (sorted(map(unquote, r["files"])), r["size"]) for r in files}


def _review_rows(spark: SparkSession, files: list[str], header: tuple[str, ...], by_records: bool, least_cells: int) -> DataFrame:
    """The rows of files with one header, read by whole files or by records."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    if by_records:
        found = records(spark, files).filter((F.col("record") > 1) & (F.col("cells") >= least_cells))
        options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
        return found.select(F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("_row")).select("_row.*")
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).schema(schema).csv(files)


def read_review(spark: SparkSession, path: str | list[str], drop_short: bool = False, by_records: bool | None = None) -> DataFrame:
    """A review table, all text. Raises on a file without the required columns.

    Files of one batch may have different headers: each is read under its own.
    Quoted cells may hold line breaks, so files are read whole, one by a task,
    unless one is larger than a split (or ``by_records`` says so): then records
    are found first, and every split is a task. ``drop_short`` drops rows with
    fewer cells than the header, instead of padding them, and keeps longer ones,
    whose further cells are ignored.
    """
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tables = []
    for header, (files, largest) in sorted(_headers(spark, path).items()):
        missing = [c for c in REVIEW_REQUIRED if c not in header]
        if missing:
            raise ValueError(f"Missing required columns: {missing} in {files[0]}")
        rows = _review_rows(spark, files, header, drop_short or (largest > split if by_records is None else by_records), len(header) if drop_short else 0)
        tables.append(rows.withColumns({c: F.lit(None).cast("string") for c in REVIEW_COLUMNS if c not in header}))
    if not tables:
        raise ValueError(f"Missing required columns: {REVIEW_REQUIRED}")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return whole.select(*REVIEW_COLUMNS, *[c for c in whole.columns if c not in REVIEW_COLUMNS])


def newest_batch(spark: SparkSession, pattern: str, by: str = "time") -> str | None:
    """The newest file or folder matching a glob, by modification time (then name) or by name.

    Only the listing is read: the content column is pruned.
    """
    keys = [F.desc("modificationTime"), F.desc("path")] if by == "time" else [F.desc("path")]
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = files.select("path", "modificationTime").orderBy(*keys).limit(1).collect()
    if not newest:
        return None
    # A batch written by Spark is a folder: cut its part file off the path.
    parts = newest[0]["path"].split("/")
    last = pattern.rsplit("/", 1)[-1]
    while not fnmatch(parts[-1], last):
        parts.pop()
    return "/".join(parts)


def head(df: DataFrame, n: int = 50, order: str = "seq") -> DataFrame:
    """The first rows, for a trial run."""
    return df.orderBy(order).limit(n)
