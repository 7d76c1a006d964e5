"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import (
    bpe, centroids, hamming_search, hard_negatives, language_id, minhash, packing, quality_rules, simhash, suffix_dedup, token_counts,
    url_filter, warc,
)
from lexiloom.llm.frames import load
from lexiloom.llm.url_labels import labelled_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
]


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the regression."""
    model = url_filter.train(labelled_urls(spark))
    return url_filter.judge(load(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, model)


@query
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules alone say of every page's url."""
    judged = url_filter.judge(load(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, url_filter.Model([], 0.0, 0.0))
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


_FITS = "((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
ORACLES["url_rules"] = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE """ + " ".join(
    "WHEN " + _FITS.format(h=r.host, p=r.path) + f" THEN '{r.text}'" for r in sorted(URL_RULES, key=lambda r: -len(r.text))) + """ END AS rule FROM u)
SELECT page_id, host, path, rule, CASE """ + " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in URL_RULES) + " END AS ruled FROM r"


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"), size=3, radius=3)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    forest = quality_rules.train(documents, load(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.judge(documents, forest).drop("text")


@query
def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quality rules count in every document, without a model."""
    found = quality_rules.judge(load(spark, sf_dir, "documents", "doc_id", "text"), None)
    return found.select("doc_id", *quality_rules.BASE, "base_failed")


ORACLES["quality_statistics"] = r"""
WITH d AS (SELECT row_number() OVER () AS p, doc_id, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
e AS (SELECT p, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three
  FROM (SELECT p, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
m AS (SELECT p, i FROM e QUALIFY count(*) OVER (PARTITION BY p, three) > 1),
r AS (SELECT p, count(DISTINCT i + j) AS n FROM m, (SELECT unnest(range(3)) AS j) GROUP BY p),
s AS (SELECT d.p, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN r ON d.p = r.p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    documents = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language_id.predict(documents.select("doc_id", "text"), language_id.train(documents)).drop("text")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack_documents(
        load(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
        capacity=1024, end_id=2, derive={"ids_crc32": packing.CRC32})


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    return bpe.encode(load(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), {
        "n_tokens": bpe.WHOLE["n_tokens"],
        "ids_sha256": ("string", pa.string(), lambda c: bpe.sha256(c.ids_text)),
        "decoded_sha256": ("string", pa.string(), lambda c: bpe.sha256(c.decoded)),
    })


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses where strings of 400 bytes are repeated."""
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    spans = suffix_dedup.repeated_spans(documents, length=400)
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    digests = spans.select("key", lost.alias("lost"), F.size("spans").cast("long").alias("runs"), F.sha2("kept", 256).alias("left"))
    text = F.coalesce("text", F.lit(""))
    whole = documents.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return whole.withColumn("key", F.unhex("whole")).join(digests, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("lost", zero).alias("n_removed"), F.coalesce("runs", zero).alias("n_spans"),
        F.coalesce("left", "whole").alias("kept_sha256"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, and read back by looking up every page's url in their index."""
    pages = load(spark, sf_dir, "pages", "page_id", "url", "html")
    archive = warc.write(pages, least_bytes=0)
    found = warc.read(archive, warc.lookup(archive, pages.select("url")))
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


# Base32 takes five hexadecimal digits as four characters.
ORACLES["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, """ + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(x, {5 * i + 1}, 5) AS INTEGER) >> {15 - 5 * j}) & 31), 1)"
    for i in range(8) for j in range(4)) + """ AS payload_digest,
CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN page_id > first THEN first END AS refers_to FROM q"""


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the corpus for every context limit that is some document's length."""
    encoded = token_counts.lengths(load(spark, sf_dir, "documents", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.with_sums(token_counts.histogram(encoded))


@query
def op10_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by 100, among all vectors."""
    vectors = load(spark, sf_dir, "embeddings", "vec_id", "embedding").select(
        "vec_id", hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


ORACLES["op10_hamming_search"] = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
d AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(64 - list_sum(list_transform(list_zip(a.bits, b.bits),
  lambda z: CASE WHEN z[1] = z[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance FROM v a, v b WHERE a.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, vec_id, distance, rank FROM r WHERE rank <= 10"""


@query
def op11_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds from 16 seeds."""
    return centroids.clustered(load(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=16, rounds=3, components=64, scale=64, salt="1:")


# Floored division of a sum by a count, for negative sums too.
_MOVED = """m{r} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
  SELECT k, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY k, i) GROUP BY k),
c{s} AS (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))"""
_ASSIGNED = """a{r} AS (SELECT p, vec_id, any_value(x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT p, vec_id, x, k, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{r}) GROUP BY p, vec_id)"""
ORACLES["op11_ns_bounds"] = """
WITH v AS (SELECT row_number() OVER () AS p, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, x AS c FROM v ORDER BY k LIMIT 16),
""" + ",\n".join(part for r in range(3) for part in (_ASSIGNED.format(r=r), _MOVED.format(r=r, s=r + 1))) + ",\n" + _ASSIGNED.format(r=3) + """
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a3 JOIN c3 USING (k)"""


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, by 4-word shingles."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"), size=4, percent=80)


ORACLES["op12_minhash"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(node, reached) AS (SELECT a, b FROM p UNION SELECT r.node, p.b FROM r JOIN p ON r.reached = p.a),
c AS (SELECT node, min(reached) AS least FROM r GROUP BY node)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id,
  least(doc_id, coalesce(least, doc_id)) = doc_id AS kept FROM s LEFT JOIN c ON doc_id = node"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten negatives for each of the five positives of every vector whose id is divisible by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    rows = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").select("vec_id", "embedding", moved)
    return hard_negatives.mine(hard_negatives.prepared(rows, scale=256), "vec_id % 100 = 0", positives=5, negatives=10,
                               least_percent=30, most_percent=90)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
