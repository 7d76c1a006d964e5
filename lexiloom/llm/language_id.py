"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The text is lower-cased, what is no letter becomes a blank, and the n-grams of
one to three characters are hashed into buckets. Document frequencies count
every training document. The regression is fitted by follow-the-regularised-
leader with an elastic-net penalty, on a sample of at most ``per_language``
documents of each language (about; those whose hash is small) and ``sample`` in
all; a fifth of the sample is held back to calibrate a temperature. Prediction
is one narrow stage over whole texts.

Defined results
- a text that is null or has no letter is ``und`` with score 0, and so is every
  text where there is nothing to learn from; with one language, that one with score 1;
- rows with a null lang or text are not learned from; a null id counts as an
  empty one for the split; repeated rows are judged one by one;
- other columns pass through, except those named like an output column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.frames import give_back, stored, tidied

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
ADDED = ("held_out", "lang_pred", "score")
_LETTER = np.array([chr(i).isalpha() for i in range(0x3000)])
_STEPS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-grams of a text, ascending, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = (points >= len(_LETTER)) | _LETTER[np.minimum(points, len(_LETTER) - 1)]
    points = np.where(letter, points, np.uint32(32))
    points = points[np.append(True, letter[1:] | letter[:-1])] if len(points) else points
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    total, h = np.zeros(BUCKETS, np.int64), np.zeros(len(points), np.uint32)
    for n, step in enumerate(_STEPS):
        if len(points) <= n:
            break
        h = h[:len(points) - n] * np.uint32(31 * 8191 + 2 * n) + points[n:]
        total += np.bincount((h * step) >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    found = np.nonzero(total)[0]
    return found, total[found]


def tf_idf(counts: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sublinear frequencies times ``idf``, of length one."""
    buckets, n = counts
    values = (1 + np.log(n)) * idf[buckets]
    return buckets, values / np.sqrt((values**2).sum() or 1.0)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        buckets, values = tf_idf(gram_counts(text), self.idf)
        chances = softmax((values @ self.weights[buckets] + self.bias) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, rounds: int = 3,
             alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.001) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bucket x class) and bias; the bias is a bucket that every row has, without penalty."""
    z, squares = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights_of(index):
        zi = z[index]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - np.where(index == BUCKETS, 0.0, l1)[:, None], 0)
        return -shrunk / ((beta + np.sqrt(squares[index])) / alpha + l2)

    for _ in range(rounds):
        for (buckets, values), label in zip(rows, labels):
            index, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights_of(index)
            error = softmax(x @ w)
            error[label] -= 1
            gradient = x[:, None] * error
            after = squares[index] + gradient**2
            z[index] += gradient - (np.sqrt(after) - np.sqrt(squares[index])) / alpha * w
            squares[index] = after
    whole = weights_of(np.arange(BUCKETS + 1))
    return whole[:-1], whole[-1]


def fit_temperature(margins: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which the held-back labels are likeliest, between 1/20 and 20."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        chances = softmax(margins / np.exp(log_t))
        return -float(np.log(np.maximum(chances[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, golden = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task's documents: how many have each bucket. Bucket -1: how many there are."""
    total, documents = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            total[gram_counts(text)[0]] += 1
            documents += 1
    found = np.nonzero(total)[0]
    yield pa.RecordBatch.from_pydict({
        "bucket": np.append(found, -1).astype(np.int32), "n": np.append(total[found], documents)})


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            made = [gram_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "mark": batch.column("mark"), "lang": batch.column("lang"),
                "buckets": pa.array([b.astype(np.int32) for b, _ in made], pa.list_(pa.int32())),
                "counts": pa.array([c.astype(np.int32) for _, c in made], pa.list_(pa.int32()))})


def train(documents: DataFrame, per_language: int = 800, sample: int = 8000) -> Model:
    """Fits on the documents (doc_id, text, lang) that aren't held out."""
    known = documents.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "text", "lang", F.xxhash64(F.lit("sample"), "doc_id").alias("mark"))
    counted = known.select("text").mapInArrow(tidied(_frequencies), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequency = np.zeros(BUCKETS)
    documents_in_all = 0
    for bucket, n in counted.collect():  # one row for each bucket at most
        if bucket < 0:
            documents_in_all = n
        else:
            frequency[bucket] = n
    idf = np.log((1 + documents_in_all) / (1 + frequency)) + 1
    # A share of each language's hashes, so that rare languages are seen as often as frequent ones, and all of them
    # within ``sample``. Stored: a few rows whose size Spark knows, so the many rows of one language needn't meet in a task.
    place = F.pmod("mark", F.lit(1_000_003)) / 1_000_003
    sizes = stored(known.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")))
    each = min(per_language, max(sample // max(sizes.count(), 1), 1))
    shares = sizes.select("lang", "least", (F.lit(float(each)) / F.col("n")).alias("share"))
    # ``last`` is a mark's place among those of its language, so the cut falls on all languages alike, but for the first row of each.
    first = place == F.col("least")
    marks = (known.select("mark", "lang").join(shares, "lang").where(first | (place < F.col("share")))
             .select(F.when(first, 0.0).otherwise(place / F.col("share")).alias("last"), "mark", "lang").distinct()
             .orderBy("last", "mark", "lang").limit(sample).select("mark", "lang"))
    # ``sample`` pairs of a number and a language at most, so the texts needn't be shuffled.
    chosen = known.join(F.broadcast(marks), ["mark", "lang"]).select("mark", "lang", "text").limit(sample)
    rows = chosen.mapInArrow(tidied(_vectors), "mark long, lang string, buckets array<int>, counts array<int>").toArrow()
    if not rows.num_rows:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    names = rows["lang"].to_pylist()
    languages = sorted(set(names))
    order = np.lexsort((np.array(names), rows["mark"].to_numpy()))
    labels = np.searchsorted(languages, names)[order]
    buckets, counts = rows["buckets"].combine_chunks(), rows["counts"].combine_chunks()
    vectors = [tf_idf((buckets[int(i)].values.to_numpy(), counts[int(i)].values.to_numpy()), idf) for i in order]
    back = np.arange(len(vectors)) % 5 == 4
    weights, bias = fit_ftrl([v for v, b in zip(vectors, back) if not b], labels[~back], len(languages))
    margins = np.array([v[1] @ weights[v[0]] + bias for v, b in zip(vectors, back) if b])
    return Model(languages, idf, weights, bias, fit_temperature(margins, labels[back]))


def prediction(text: Column, model: Model) -> Column:
    """lang_pred and score of a text, as a struct; only the text goes to Python."""
    @F.arrow_udf("lang_pred string, score double")
    def predicted(texts: pa.Array) -> pa.Array:
        found = [model.predict(t.as_py()) for t in texts]
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["lang_pred", "score"])

    return predicted(text)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Adds held_out, lang_pred and score to every document."""
    rows = documents.select(F.struct("*").alias("row"), held_out().alias("held_out"), prediction(F.col("text"), model).alias("found"))
    return rows.select(*(F.col("row").getField(c).alias(c) for c in documents.columns if c not in ADDED), "held_out", "found.*")
