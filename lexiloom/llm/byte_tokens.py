"""Ids of whole texts by a public byte-level BPE tokenizer file."""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import tiktoken

#: The split of byte-level tokenizer files that name no pattern of their own.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_character() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself, or else the next free code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a tokenizer file as ranks; ids and ranks must agree."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    back = byte_of_character()
    ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    last = 255
    for merge in spec["model"]["merges"]:
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        rank = ranks[bytes(back[c] for c in a + b)]
        if rank <= last:
            raise ValueError(f"{path}: the ids don't follow the order of the merges")
        last = rank
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def ids_of(path: str, text: str | None) -> np.ndarray:
    """Special tokens that a text spells out count as such, as they do by default in the file's own library."""
    return encoding(path).encode_to_numpy(text or "", allowed_special="all")
