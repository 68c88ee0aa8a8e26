"""Two-stage suffix sorting in numpy: sort the suffixes that are smaller than their successors, induce the rest."""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than its successor; runs of one byte follow what ends them."""
    n = len(text)
    nxt = np.append(text[1:], np.uint8(0))
    differs = text != nxt
    differs[-1] = True
    at = np.flatnonzero(differs)  # the position that settles each suffix: the first at or after it
    settle = at[np.searchsorted(at, np.arange(n))]
    out = text[settle] < nxt[settle]
    out[-1] = False
    return out


def _keys(text: np.ndarray, depth: int) -> np.ndarray:
    """Big-endian 8-byte keys at every offset, zero beyond the end."""
    padded = np.zeros(len(text) + depth + 16, np.uint8)
    padded[: len(text)] = text
    return np.ndarray(len(text) + depth + 8, ">u8", padded, strides=(1,))


def direct_sort(keys: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions `at` in order of their first `depth` bytes (rounded up to 8); only tied ones are compared further."""
    key = keys[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    out, key = at[order], key[order]
    rank = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    for step in range(8, depth, 8):
        same = rank[1:] == rank[:-1]
        tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(tied):
            break
        key = keys[out[tied] + step].astype(np.uint64)
        order = np.lexsort((key, rank[tied]))
        out[tied] = out[tied][order]
        key, r = key[order], rank[tied]
        # A tied group starts at the index of its first member; ranks are renewed as indices of group starts.
        new = np.ones(len(tied), bool)
        new[1:] = (r[1:] != r[:-1]) | (key[1:] != key[:-1])
        rank = rank.copy()
        rank[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1] + len(at)
    return out


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The positions marked in wanted, in order of their suffixes' first `depth` bytes.

    Stage one sorts the needed suffixes that are smaller than their successors directly. Stage two scans the buckets of
    first bytes upwards: each placed suffix places its predecessor if that is larger than it. In a bucket, induced suffixes
    come before the directly sorted ones."""
    small = smaller_than_next(text)
    needed = wanted.copy()  # and of each larger suffix all successors up to a smaller one
    last = len(text) - 1
    front = np.flatnonzero(wanted & ~small)
    while len(front):
        front = front[front < last] + 1
        front = front[~needed[front]]
        needed[front] = True
        front = front[~small[front]]
    keys = _keys(text, depth)
    first = direct_sort(keys, np.flatnonzero(needed & small), depth)
    starts = np.searchsorted(text[first], np.arange(257))
    induced = needed & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[last]:  # the empty suffix, the least of all, induces the last one
        waiting[text[last]].append(np.array([last]))
    out = []

    def place(done: np.ndarray, above: int) -> None:
        before = done[done > 0] - 1
        before = before[induced[before]]
        before = before[text[before] > above]
        if len(before):
            byte = text[before]
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part in np.split(before, cuts):
                waiting[text[part[0]]].append(part)

    for c in range(256):
        level = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        levels = [level]
        while len(level):
            level = level[level > 0] - 1
            level = level[induced[level] & (text[level] == c)]
            levels.append(level)
        large = np.concatenate(levels)
        own = first[starts[c] : starts[c + 1]]
        place(large, c)
        place(own, c)
        out += [large, own]
    order = np.concatenate(out)
    return order[wanted[order]]


def equal_neighbours(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For adjacent suffixes in order, whether their common prefix is at least `depth` bytes (which exist)."""
    keys = _keys(text, depth)
    a, b = order[:-1], order[1:]
    alive = np.flatnonzero(np.maximum(a, b) + depth <= len(text))
    for step in [*range(0, depth - 7, 8), depth - 8]:
        alive = alive[keys[a[alive] + step] == keys[b[alive] + step]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out
