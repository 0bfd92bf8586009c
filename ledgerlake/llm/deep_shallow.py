"""Deep-shallow sorting of the fixed-length suffixes that start at given places.

Shallow: multikey quicksort over machine words, ranges small enough are finished by
one sort of all of them together. Deep: ranges of suffixes that still agree, but not
in all bytes, go into blind tries, which look at single bits that tell members apart
and compare bytes once for each insertion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD = 8
SHALLOW = 24
SMALL = 2_048


def all_words(text: np.ndarray, beyond: int) -> np.ndarray:
    """Eight bytes from each place on, as numbers that compare as the bytes do; zeros follow the text."""
    padded = np.append(text, np.zeros(beyond + WORD, np.uint8))
    words = np.empty(len(padded) - WORD + 1, np.uint64)
    for k in range(WORD):
        n = (len(padded) - k) // WORD
        words[k::WORD] = padded[k : k + WORD * n].view(">u8")
    return words


class BlindTrie:
    """Members of equal length as big-endian numbers; inner nodes hold a bit position."""

    def __init__(self):
        self.root: list | None = None

    def insert(self, value: int, item: int) -> None:
        if self.root is None:
            self.root = [-1, value, [item]]
            return
        node = self.root
        while node[0] >= 0:
            node = node[2] if value >> node[0] & 1 else node[1]
        different = value ^ node[1]
        if not different:
            node[2].append(item)
            return
        bit = different.bit_length() - 1
        parent, side, node = None, 0, self.root
        while node[0] > bit:
            parent, side = node, 1 + (value >> node[0] & 1)
            node = node[side]
        leaf = [-1, value, [item]]
        inner = [bit, node, leaf] if value >> bit & 1 else [bit, leaf, node]
        if parent is None:
            self.root = inner
        else:
            parent[side] = inner

    def groups(self) -> list[list[int]]:
        """Equal members together, in order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] < 0:
                out.append(node[2])
            else:
                stack.extend((node[2], node[1]))
        return out


def shallow_order(at: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the places by their first `depth` bytes, and where bytes change in it."""
    words = [at[places + d] for d in range(0, depth, WORD)]
    order = np.arange(len(places))
    leaf = np.zeros(len(places), np.int64)
    stack, leaves = [(0, len(places), 0)] if len(places) else [], 0
    while stack:
        begin, end, level = stack.pop()
        if end - begin <= SMALL or level == len(words):
            leaf[begin:end] = leaves
            leaves += 1
            continue
        own = order[begin:end]
        key = words[level][own]
        pivot = np.sort(key[:: max(1, len(key) // 64)])[min(32, len(key) // 2)]
        less, more = key < pivot, key > pivot
        order[begin:end] = np.concatenate([own[less], own[~less & ~more], own[more]])
        low, high = begin + int(less.sum()), end - int(more.sum())
        # The range to the left is taken first, so that leaves are numbered in order.
        stack.extend(r for r in ((high, end, level), (low, high, level + 1), (begin, low, level)) if r[1] > r[0])
    keys = [w[order] for w in reversed(words)]
    final = np.lexsort([*keys, leaf])
    order = order[final]
    change = np.ones(len(order), bool)
    if len(order):
        change[1:] = False
        for w in words:
            change[1:] |= w[order[1:]] != w[order[:-1]]
    return order, change


def unequal_ranges(
    at: np.ndarray, places: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int, length: int
) -> np.ndarray:
    """Which ranges of the places have members that differ from `depth` to `length`."""
    members = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    own = places[members]
    differs = np.zeros(len(members), bool)
    for d in range(depth, length, WORD):
        word = at[own + d] >> np.uint64(8 * max(0, WORD - (length - d)))
        differs[1:] |= word[1:] != word[:-1]
    begins = np.cumsum(sizes) - sizes
    differs[begins] = False
    return np.logical_or.reduceat(differs, begins) if len(begins) else np.zeros(0, bool)


def sorted_groups(text: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the places and the group number of each: equal in the first `length` bytes."""
    at = all_words(text, length)
    depth = min(SHALLOW, length // WORD * WORD)
    order, new = shallow_order(at, places, depth)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(order)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    deep = unequal_ranges(at, places[order], starts, sizes, depth, length)
    raw = text.tobytes()
    for begin, size in zip(starts[deep].tolist(), sizes[deep].tolist()):
        trie = BlindTrie()
        items = order[begin : begin + size]
        for item, place in zip(items.tolist(), places[items].tolist()):
            trie.insert(int.from_bytes(raw[place + depth : place + length], "big"), item)
        groups = trie.groups()
        order[begin : begin + size] = [item for group in groups for item in group]
        for group in groups:
            new[begin] = True
            begin += len(group)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, group
