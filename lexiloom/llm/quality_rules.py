"""Quality rules: fixed limits, then boosted trees over document statistics.

Statistics and verdicts are computed batch by batch in one narrow stage. The
trees are fitted on at most ``sample`` labelled documents (those with the least
hash of their id), whose statistics, a dozen numbers each, go to the driver.

Defined results
- a null text is an empty one: no words, all statistics zero, base_failed;
- repeated rows are judged one by one; labels of one id: the lowest quality counts;
- without labels of both kinds there is no model, and what passes the limits is kept;
- other columns pass through, except those named like an output column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm import trees
from lexiloom.llm.frames import give_back, tidied

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the trees see, and whether the verdict may only rise (+1) or fall (-1) with it.
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "upper_share": -1, "digit_share": 0, "letter_share": 0, "words_per_line": 0,
}
ADDED = (*BASE, "base_failed", "score", "kept")
_KIND = np.zeros(256, np.uint8)
_KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1] = 1, 2
_KIND[ord("a"):ord("z") + 1] = _KIND[128:] = 3


def repeat_words(ids: np.ndarray, different: int) -> int:
    """Positions inside a 3-word window that occurs twice or more."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * different + ids[1:]
    if different > 1 << 20:  # keeps the product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * different + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(ids), bool)
    for found in (order[1:][same], order[:-1][same]):
        for i in range(3):
            covered[found + i] = True
    return int(covered.sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    lines = text.split("\n")
    known: set[str] = set()
    dup = 0
    if len(set(lines)) < len(lines):
        for line in lines:
            if line in known:
                dup += bool(line.strip(BLANKS))
            else:
                known.add(line)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    repeated = repeat_words(ids, len(seen))
    upper, digits, letters = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=4)[1:]
    some = max(n, 1)
    filled = sum(1 for line in lines if line.strip(BLANKS)) or 1
    whole = max(len(raw), 1)
    return [n, word_chars, symbols, dup, repeated], [
        float(np.log1p(n)), word_chars / some, symbols / some, dup / filled, repeated / some, len(seen) / some,
        upper / whole, digits / whole, (upper + letters) / whole, n / filled]


def _measured(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    made = [statistics(t.as_py() or "") for t in texts]
    base = np.array([b for b, _ in made], np.int64).reshape(-1, len(BASE))
    return base, np.array([f for _, f in made], np.float64).reshape(-1, len(FEATURES))


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text and quality of at most ``sample`` labelled documents."""
    chosen = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` pairs of numbers: small whatever the data.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "quality")


def train(documents: DataFrame, labels: DataFrame, sample: int = 20_000) -> trees.Forest | None:
    """Boosted trees for the quality labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                features = _measured(batch.column("text"))[1]
                yield pa.RecordBatch.from_pydict({"x": list(features), "y": batch.column("quality").cast(pa.int32())})
    rows = (labelled_sample(documents, labels, sample).mapInArrow(tidied(run), "x array<double>, y int")
            .limit(sample).toArrow())  # ids may repeat in documents: the bound holds all the same
    y = rows["y"].to_numpy()
    if not len(y):
        return None
    x = np.array(rows["x"].to_pylist())
    order = np.lexsort((*x.T, y))  # the fit doesn't depend on the order of arrival
    return trees.fit(x[order], y[order].astype(float), np.array(list(FEATURES.values())))


def verdict(text: Column, forest: trees.Forest | None, threshold: float = 0.5) -> Column:
    """The base counts, base_failed, score and kept of a text, as a struct; only the text goes to Python."""
    @F.arrow_udf(", ".join([*(f"{c} long" for c in BASE), "base_failed boolean, score double, kept boolean"]))
    def judged(texts: pa.Array) -> pa.Array:
        base, features = _measured(texts)
        give_back()
        n, repeated = base[:, 0], base[:, 4]
        failed = (n < 50) | (100 * repeated > 50 * n)
        score = forest.probability(features) if forest else np.ones(len(base))
        columns = [*base.T, failed, score, ~failed & (score >= threshold)]
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], list(ADDED))

    return judged(text)


def judge(documents: DataFrame, forest: trees.Forest | None, threshold: float = 0.5) -> DataFrame:
    """Adds the base counts, base_failed, score and kept to every document."""
    rows = documents.select(F.struct("*").alias("row"), verdict(F.col("text"), forest, threshold).alias("verdict"))
    return rows.select(*(F.col("row").getField(c).alias(c) for c in documents.columns if c not in ADDED), "verdict.*")
