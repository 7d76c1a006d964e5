"""Small corpora that hold what operators must survive."""

from __future__ import annotations

import random

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def corpus() -> list[tuple]:
    """doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves."""
    rng = random.Random(7)
    shared, base = prose(rng, 120), prose(rng, 300)
    near = base.split()
    near[150] = "changed"
    texts = [
        None, "", "   \n\t ", "one", "two words", base, base, " ".join(near), shared, f"{prose(rng, 90)} {shared} {prose(rng, 30)}",
        f"{prose(rng, 20)}\n{shared}", "na " * 700, "é" * 900, "ñandú " * 200, "#*$ | <> % & " * 30, "a\nb\na\n\n\na\nc d e\nc d e",
        "\x1c\x85  odd   blanks\x0bhere", "İstanbul ΑΣ ﬁ ½ Ⅷ 五 😀 ẞ", "don't <|endoftext|> we'll <|startoftext|>",
        prose(rng, 5000), "x" * 30_000, *(prose(rng, rng.randint(40, 200)) for _ in range(25)),
    ]
    rows = [(i + 1, t, ("en", "fr", None)[i % 3], f"s{i % 2}", None if t is None else len(t), -1.0, "mine", b"k", "row") for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, "no id here", "en", "s", 10, 0.0, "mine", b"k", "row"), (3, "an id twice", "fr", "s", 11, 0.0, "mine", b"k", "row")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, key binary, row string"
