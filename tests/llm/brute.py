"""Plain versions of the operators, for small inputs."""

import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 62


def low(text):
    return (text or "").translate(LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def exact(rows):
    """(id, keep, size) and how many rows stay."""
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, best[low(t)], len(groups[low(t)])) for i, t in rows), key=str), len(groups)


def shingles(text, size):
    w = words(low(text))
    return frozenset([tuple(w)] if 0 < len(w) < size else zip(*[w[k:] for k in range(size)])) if w else frozenset()


def components(sets, share):
    """Smallest key reachable, for a dict of sets."""
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


def repeats(rows, size):
    """(id, words, removed, kept text); a window goes if it also starts under a smaller id."""
    first = {}
    split = [(LAST if i is None else i, words(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - size + 1):
            win = tuple(w[k:k + size])
            first[win] = min(first.get(win, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((None if i == LAST else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def leaks(rows, items, size):
    windows = {}
    for name, text in items:
        w = alnum(text)
        if name is not None and w:
            for k in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[k:k + size]), set()).add(str(name))
    out = []
    for i, t in rows:
        w, hit, names = alnum(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    names |= found
                    hit |= set(range(k, k + n))
        out.append((i, len(w), len(hit), tuple(sorted(names))))
    return sorted(out, key=str)


def unigrams(rows):
    """(id, held out, tokens, known, training tokens, base score)"""
    split = [(i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, words(low(t)) + [None]) for i, t in rows]
    count = Counter(w for _, held, ws in split if not held for w in ws)
    n, v = sum(count.values()), len(count)
    return sorted(((i, held, len(ws), sum(w in count for w in ws), n,
                    round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4))
                   for i, held, ws in split), key=str)
