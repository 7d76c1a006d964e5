"""BPE encoding and decoding of whole texts with a pair occurrence index.

In each batch of a task every different word is encoded once. All their symbols
stand in one array, linked to their neighbours; an index maps each pair, by its
rank, to all its positions. Active ranks are taken in ascending order: all
positions of the pair are merged at once, and only the lists of the pairs at
their sides are updated. Known words are kept for the next batches of the task,
up to ``KEPT_WORDS`` of them (a limit of memory, not of results).

Defined results
- a null or empty text has no tokens and decodes to the empty text;
- special tokens that a text spells out are tokens of their own;
- repeated rows are encoded one by one; an empty table gives no rows;
- other columns of the input are not returned.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lexiloom.llm.byte_tokens import byte_of_character

KEPT_WORDS = 400_000
NEVER = np.int64(1 << 62)
#: White space of Unicode; Python's own split also takes the separators U+001C to U+001F.
_SPACES = re.compile(r"[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")


class Merges:
    """The vocabulary and merges of a word-end BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or level["type"] != "ByteLevel" or split["behavior"] != "Removed":
            raise ValueError(f"{path} is not a lower-casing word-end BPE file")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.inner, self.final = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for character, byte in byte_of_character().items():
            self.inner[byte], self.final[byte] = vocab[character], vocab[character + suffix]
        self.width = np.int64(max(self.tokens) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs])
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; NEVER where there is none."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)


@cache
def merges_of(path: str) -> Merges:
    return Merges(path)


def by_rank(positions: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The pair index of some positions: each rank with its positions."""
    active = ranks < NEVER
    positions, ranks = positions[active], ranks[active]
    order = np.argsort(ranks, kind="stable")
    ranks, positions = ranks[order], positions[order]
    starts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else []
    for start, end in zip(starts, [*starts[1:], len(ranks)]):
        yield int(ranks[start]), positions[start:end]


def first_of_runs(positions: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of ascending positions whose pairs may overlap (a symbol with itself), those merged from the left."""
    chosen, taken = [], -1
    for p, q in zip(positions.tolist(), following[positions].tolist()):
        if p != taken:
            chosen.append(p)
            taken = q
    return np.array(chosen, np.int64)


def encode_words(words: list[str], merges: Merges) -> list[np.ndarray]:
    """The ids of each word (not empty)."""
    raw = [w.encode() for w in words]
    lengths = np.array([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(lengths)
    symbol = merges.inner[data]
    symbol[ends - 1] = merges.final[data[ends - 1]]
    n = len(data)
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    following[ends - 1] = -1
    before[ends - lengths] = -1
    alive, rank = np.ones(n, bool), np.full(n, NEVER)
    inside = np.flatnonzero(following >= 0)
    rank[inside] = merges.rank(symbol[inside], symbol[inside + 1])
    index: dict[int, list[np.ndarray]] = {r: [p] for r, p in by_rank(inside, rank[inside])}
    heap = sorted(index)
    while heap:
        r = heapq.heappop(heap)
        listed = index.pop(r)
        left = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
        left = left[rank[left] == r]  # merged or changed pairs stay in old lists
        if not len(left):
            continue
        if symbol[left[0]] == symbol[following[left[0]]]:
            left = first_of_runs(left, following)
        right = following[left]
        after = following[right]
        symbol[left] = merges.made[r]
        alive[right], rank[right] = False, NEVER
        following[left] = after
        has_after = after >= 0
        before[after[has_after]] = left[has_after]
        rank[left] = NEVER
        ahead = before[left]
        ahead = ahead[ahead >= 0]
        changed = np.concatenate([left[has_after], ahead]) if len(ahead) else left[has_after]
        if not len(changed):
            continue
        changed_rank = merges.rank(symbol[changed], symbol[following[changed]])
        rank[changed] = changed_rank
        for new, positions in by_rank(changed, changed_rank):
            if new in index:
                index[new].append(positions)
            else:
                index[new] = [positions]
                heapq.heappush(heap, new)
    kept = np.flatnonzero(alive)
    return np.split(symbol[kept], np.searchsorted(kept, ends)[:-1])


def lowered(text: str) -> str:
    """NFC, then each character lower-cased by itself (a final sigma is no exception)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@dataclass(frozen=True)
class Coded:
    """A text's tokens: how many, their ids as decimals joined by spaces, and what they decode to."""

    n_tokens: int
    ids_text: str
    decoded: str

    @property
    def ids(self) -> np.ndarray:
        return np.array(self.ids_text.split(), np.int32)


class Coder:
    """Encodes texts, batch by batch; a blank-free stretch of text is looked up whole."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids_text: list[str] = []
        self.decoded: list[str] = []
        self.counts: list[int] = []

    def stretches(self, text: str) -> list[str]:
        """A special token is marked by a leading surrogate, which no text holds."""
        if self.merges.special_split and any(s in text for s in self.merges.special):
            parts = self.merges.special_split.split(text)
            return [s for i, part in enumerate(parts) for s in ([f"\ud800{part}"] if i % 2 else self.stretches_of_plain(part))]
        return self.stretches_of_plain(text)

    def stretches_of_plain(self, text: str) -> list[str]:
        text = lowered(text)
        return [s for s in _SPACES.split(text) if s] if _SEPARATORS.search(text) else text.split()

    def learn(self, fresh: list[str]) -> None:
        """Encodes new stretches: those of all words together, each word once."""
        words: dict[str, int] = {}
        parts = [None if s[0] == "\ud800" else [words.setdefault(w, len(words)) for w in self.merges.pattern.findall(s)] for s in fresh]
        ids = [x.tolist() for x in encode_words(list(words), self.merges)] if words else []
        texts = [" ".join(map(str, x)) for x in ids]
        tokens = self.merges.tokens
        spelt = [" ".join([tokens[i] for i in x]) for x in ids]
        for stretch, part in zip(fresh, parts):
            if part is None:
                self.ids_text.append(str(self.merges.special[stretch[1:]]))
                self.decoded.append(stretch[1:])
                self.counts.append(1)
            else:
                self.ids_text.append(" ".join([texts[w] for w in part]))
                self.decoded.append(" ".join([spelt[w] for w in part]))
                self.counts.append(sum(len(ids[w]) for w in part))

    def code(self, texts: list[str | None]) -> Iterator[Coded]:
        if len(self.known) > KEPT_WORDS:
            self.forget()
        known, before = self.known, len(self.known)
        coded = [np.array([known.setdefault(s, len(known)) for s in self.stretches(t or "")], np.int32) for t in texts]
        fresh = list(known)[before:]
        if fresh:
            self.learn(fresh)
        counts = np.array(self.counts, np.int64)
        for numbers in coded:
            listed = numbers.tolist()
            yield Coded(int(counts[numbers].sum()) if listed else 0, " ".join([self.ids_text[i] for i in listed]),
                        " ".join([self.decoded[i] for i in listed]))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: The columns that ``encode`` returns unless others are asked for: (Spark type, Arrow type, function of Coded).
WHOLE = {
    "n_tokens": ("long", pa.int64(), lambda c: c.n_tokens),
    "ids": ("array<int>", pa.list_(pa.int32()), lambda c: c.ids),
    "decoded": ("string", pa.string(), lambda c: c.decoded),
}


def encode(documents: DataFrame, path: str, derive: dict[str, tuple[str, pa.DataType, Callable[[Coded], object]]] | None = None) -> DataFrame:
    """doc_id and the derived columns of every document (doc_id, text)."""
    derive = derive or WHOLE
    source = documents.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(merges_of(path))
        for batch in batches:
            made = [[] for _ in derive]
            for coded in coder.code(batch.column("text").to_pylist()):
                for column, (_, _, fn) in zip(made, derive.values()):
                    column.append(fn(coded))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, (_, t, _) in zip(made, derive.values()))], ["doc_id", *derive])

    return source.mapInArrow(run, ", ".join([f"doc_id {kind}", *(f"{n} {t}" for n, (t, *_) in derive.items())]))
