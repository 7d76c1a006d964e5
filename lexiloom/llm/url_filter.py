"""URL filters: host and path rules, and a logistic regression for the urls that no rule fits.

The regression runs on hashed character n-grams of host and path. It is
trained on a small labelled table; scoring is one narrow stage of JVM
expressions, without a shuffle, so a hot host costs no more than any other.
Rules are a table of any length: the different hosts meet the rules of their
domains by equality, and a url then looks through its own host's rules only.

Defined results
- a url that is null or has no ``://`` has an empty host and path; no rule
  fits it, and its score is that of a url without n-grams;
- of rules equally long, the first in the order of their text wins;
- labelled rows with a null url or label are ignored; with fewer than two
  classes left, every score is the share of unwanted urls (0 without rows);
- repeated rows are judged one by one; other columns of the input pass through,
  except those named like an output column, which are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.frames import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Model:
    """Weights of the buckets of n-grams, and the margin of a url without any.

    Where the table had one class only, there are no weights and ``constant`` is the score.
    """

    weights: list[float]
    intercept: float
    constant: float


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(text: Column, mark: str, sizes: tuple[int, ...]) -> Column:
    """The character n-grams of a text, each behind the mark of its field."""
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(text) - n + 1)
        made = F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{n}"), F.substring(text, i, F.lit(n))))
        return F.when(F.char_length(text) >= n, made).otherwise(F.array().cast("array<string>"))
    return F.concat(*(of(n) for n in sizes))


def url_features(urls: DataFrame, column: str = "url", sizes: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """``_host``, ``_path`` and ``_grams`` beside the input."""
    # Marks at both ends of the host and the start of the path make short grams specific.
    parts = urls.withColumns({"_host": host_of(F.col(column)), "_path": path_of(F.col(column))})
    host = F.when(F.col("_host") != "", F.concat(F.lit("."), F.col("_host"), F.lit(".")))
    return parts.withColumn("_grams", F.concat(
        grams(F.coalesce(host, F.lit("")), "h", sizes), grams(F.translate("_path", UPPER, LOWER), "p", sizes)))


def buckets_of(grams: Column, buckets: int) -> Column:
    """The different buckets that hashed n-grams fall into."""
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.hash(g), F.lit(buckets))))


def train(labelled: DataFrame, buckets: int = 1 << 14, strength: float = 0.01, rounds: int = 60) -> Model:
    """Fits on ``labelled`` (url, label: 1 unwanted, 0 wanted), a small table: its rows become vectors of ``buckets`` numbers."""
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").select(
        "url", F.col("label").cast("double").alias("label"))
    classes, share = rows.agg(F.count_distinct("label"), F.coalesce(F.avg("label"), F.lit(0.0))).first()
    if classes < 2:
        return Model([], 0.0, float(share))
    # Stored, so that the buckets of a url are made once and not for each place of its vector.
    held = stored(url_features(rows).select("label", buckets_of(F.col("_grams"), buckets).alias("_held")))
    marks = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.array_contains(F.col("_held"), i).cast("double"))
    vectors = held.select("label", array_to_vector(marks).alias("_features"))
    fitted = LogisticRegression(featuresCol="_features", regParam=strength, maxIter=rounds).fit(vectors)
    return Model([float(f"{w:.9g}") for w in fitted.coefficients.toArray()], float(fitted.intercept), float(share))


def unwanted(featured: DataFrame, model: Model) -> DataFrame:
    """Adds ``score``, the probability that a url is unwanted, by expressions over the weights."""
    if not model.weights:
        return featured.withColumn("score", F.lit(model.constant))
    # One constant for the optimizer, which folds the parsing away.
    weights = F.from_json(F.lit(json.dumps(model.weights)), "array<double>")
    held = buckets_of(F.col("_grams"), len(model.weights))
    margin = F.aggregate(held, F.lit(model.intercept), lambda total, b: total + F.get(weights, b))
    return featured.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def domains(host: Column) -> Column:
    """A host and its parent domains: all that stands behind a dot, and the whole."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as rows (verdict, host, path)."""
    listed = [{"verdict": r.verdict, "host": r.host, "path": r.path} for r in set(rules)]
    made = F.from_json(F.lit(json.dumps(listed)), "array<struct<verdict:string,host:string,path:string>>")
    return spark.range(1).select(F.inline(made))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``_host`` and its rules, the one that wins first, for the hosts that have any.

    The size of an array is the number of rules for a host and its domains.
    """
    text = F.concat("host", "path")
    each = rules.select(F.col("host").alias("_domain"), F.struct(
        (-F.char_length(text)).alias("order"), text.alias("rule"), "path", "verdict").alias("_rule")).distinct()
    # Copies of a host go in the map tasks, before anything is joined.
    pairs = hosts.select("_host").distinct().select("_host", F.explode(F.array_distinct(domains(F.col("_host")))).alias("_domain"))
    return pairs.join(each, "_domain").groupBy("_host").agg(F.sort_array(F.collect_list("_rule")).alias("_rules"))


def judge(urls: DataFrame, rules: list[Rule] | DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Adds host, path, rule, verdict and score to each url.

    ``rules`` are a list, or a table (verdict, host, path).
    """
    table = rules if isinstance(rules, DataFrame) else rule_table(urls.sparkSession, rules)
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "score")]
    rows = urls.select(F.struct(*kept).alias("row"), F.col("url"))
    # Stored, so that the join knows its size: it is broadcast only below Spark's threshold, and a hot host's side can be split.
    ruled = stored(rules_of_hosts(rows.select(host_of(F.col("url")).alias("_host")), table))
    joined = unwanted(url_features(rows), model).join(ruled, "_host", "left")
    first = F.get(F.filter("_rules", lambda r: F.col("_path").startswith(r["path"])), F.lit(0))
    learned = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return joined.withColumn("_first", first).select(
        "row.*", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_first.rule").alias("rule"),
        F.coalesce(F.col("_first.verdict"), learned).alias("verdict"), "score")
