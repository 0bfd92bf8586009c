"""A byte-level BPE vocabulary file as tables: pieces, merges, pre-token pattern, special strings."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

# The pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file.

    Visible Latin-1 characters stand for themselves, all other bytes for the
    characters from 256 on, in order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tables of one vocabulary file; ids of merged tokens follow the merge order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = printable_bytes()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda piece: bytes(letters[c] for c in piece)
        self.pieces: dict[int, bytes] = {
            i: raw(p) for p, i in vocab.items() if p not in self.special
        }
        self.pieces |= {i: s.encode() for s, i in self.special.items()}
        self.ids: dict[bytes, int] = {raw(p): i for p, i in vocab.items() if p not in self.special}
        self.size = max(self.pieces) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.left, self.right = left, right
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        order = np.argsort(left * self.size + right, kind="stable")
        self.pair_keys = (left * self.size + right)[order]
        self.pair_ranks = order.astype(np.int64)
        self._find = regex.compile(PATTERN).findall
        strings = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")")

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens in order; a special string in the text is a pre-token of its own."""
        if not any(s in text for s in self.special):
            return self._find(text)
        out: list[str] = []
        for part in self._special.split(text):
            out.extend([part] if part in self.special else self._find(part))
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
