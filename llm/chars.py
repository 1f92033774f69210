"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint32(0x9E3779B1)


def ngrams(texts: list[str | None], sizes: tuple[int, ...], bits: int):
    """For each n-gram size: (feature of the n-gram at each character, is it inside one
    text); and where each text begins among the characters. Letters are lower-cased,
    every text stands between two blanks."""
    low = [" " + (t or "").lower() + " " for t in texts]
    first = np.concatenate(([0], np.cumsum(np.array([len(t) + 1 for t in low], np.int64))))
    chars = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le"), np.uint32)
    breaks = first[1:] - 1
    out, h = [], np.zeros(len(chars), np.uint32)
    crosses = np.zeros(len(chars), dtype=bool)
    for k in range(max(sizes)):
        n = max(len(chars) - k, 0)  # a lone empty text is shorter than a long n-gram
        h[:n] = (h[:n] ^ chars[k:]) * _FACTOR
        h[:n] ^= h[:n] >> np.uint32(15)
        h[n:] = 0
        near = breaks - k
        crosses[near[near >= 0]] = True
        crosses[n:] = True
        if k + 1 in sizes:
            out.append(((h * np.uint32(0x85EBCA6B) + np.uint32(k)) >> np.uint32(32 - bits), ~crosses))
    return out, first[:-1]
