"""Suffix arrays by the difference-cover algorithm, in numpy.

Suffixes at places 1 and 2 modulo 3 are the sample: their first three characters are sorted
and named, and if names repeat, the suffixes of the string of names are sorted in the same
way. The other suffixes sort by their first character and the rank of the sample suffix
behind it, and are merged in by comparing one or two characters and such a rank.
"""

from __future__ import annotations

import numpy as np


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """The order of the keys, a name from 1 up by rank for each, and whether all differ."""
    order = np.argsort(keys)
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new)
    return order, names, bool(new.all())


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers of at least 0) in order.

    A suffix that ends sorts before those it is the beginning of. The length must be below
    2**20, so that three characters or names fit into one 64-bit number.
    """
    n = len(text)
    if n >= 1 << 20:
        raise ValueError("text too long")
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.zeros(n + 3, np.int64)
    s[:n] = np.asarray(text, np.int64) + 1
    if s.max() >= 1 << 20:
        s[:n] = _named(s[:n])[1]
    base = int(s.max()) + 1
    # With a sample place at n if n = 1 (mod 3), the places of each kind pair up for the merge.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    order, names, unique = _named((s[sample] * base + s[sample + 1]) * base + s[sample + 2])
    if not unique:
        order = suffix_array(names - 1)
    rank = np.zeros(n + 3, np.int64)  # of sample suffixes, from 1; ended suffixes rank 0
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]

    step = len(rank) + 1
    rest = np.arange(0, n, 3)
    key = s[rest] * step + rank[rest + 1]
    by = np.argsort(key)
    rest, key = rest[by], key[by]
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = np.searchsorted(s[first] * step + rank[first + 1], key)
    wide = (s[second] * base + s[second + 1]) * step + rank[second + 2]
    before += np.searchsorted(wide, (s[rest] * base + s[rest + 1]) * step + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = before + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at], out[~taken] = rest, sample
    return out


def equal_prefix_groups(text: np.ndarray, starts_ok: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``length`` characters are compared, in suffix order, with the number
    of the group of equal ones that each belongs to. Only places in ``starts_ok`` count."""
    order = suffix_array(text)
    order = order[starts_ok[order]]
    if not len(order):
        return order, order
    # Neighbours in suffix order share their next characters or differ in them, so comparing
    # neighbours is enough; eight characters at a time, as long as they agree.
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[: len(text)] = text % 256
    words = np.zeros(len(text) + 1, np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    same = np.arange(1, len(order))
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length >= 8 else [])]:
        same = same[words[order[same] + at] == words[order[same - 1] + at]]
    if length < 8:
        mask = np.uint64((1 << (8 * length)) - 1)
        same = same[(words[order[same]] & mask) == (words[order[same - 1]] & mask)]
    new = np.ones(len(order), bool)
    new[same] = False
    return order, np.cumsum(new) - 1
