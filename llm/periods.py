"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are identical) and at least
2q words that can't be extended keeping that period. Periods are treated by scale: for a power
of two t, the periods of 3t to 6t-1 words.

* At scale t every position gets the hash of its next t words. Position i is *synchronising* if
  the least hash of positions i to i+t stands at i or at i+t; positions whose t words have a
  period of t/3 or less do not take part. Whether i is chosen depends on words i to i+2t-1 only,
  so equal contexts are chosen alike; and any t positions in a row hold a chosen one, unless the
  3t-1 words there have a period of t/3 or less.
* A run of period q, 3t <= q < 6t, has t+1 places whose context comes again q words on. Two chosen
  places of one context 3t to 6t-1 words apart so propose a period. A context occurs at most
  every t/3 words, hence in at most 18 places within reach.
* If none of these places is chosen, both halves of the run lie in two neighbouring runs of one
  period of t/3 or less that touch or overlap. Such pairs propose all shifts that map one on the
  other. These regions, and all periods below ``SMALL``, are detected by direct comparison first
  or are runs of a smaller scale.
* A proposal (place, period) is extended to both sides over hashes of 1, 2, 4, ... words, and
  stands if it covers two periods.

The hash of 2w words mixes those of its halves, so that equal hashes mean equal words but for a
chance near 2**-64 a comparison, also in texts built to defeat polynomial hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_batches, same_names
from .tokens import mix, pieces, words

SMALL = 12          # periods below are found by comparing words directly
LEAST_WORDS = 12    # shorter runs are not reported
_LAST = np.uint64(2**64 - 1)
_LEFT = np.uint64(0x9E3779B97F4A7C15)
_OWN = np.uint64(0xD1342543DE82EF95)


class _Texts:
    """Word hashes of some documents, the longest first, so that those of at least w words are
    a prefix; and hashes of 2**k words for each k."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, least: int):
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        self.docs = order[:int((size >= max(least, 2)).sum())]
        self.size = size[self.docs]
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        at = np.repeat(first[self.docs] - self.first[:-1], self.size) + np.arange(self.first[-1])
        self.doc = np.repeat(np.arange(len(self.docs)), self.size)
        self.begin, self.end = self.first[self.doc], self.first[self.doc + 1]
        self.levels = [hashes[at]]

    def words_of(self, least: int) -> int:
        """How many words belong to documents of at least so many."""
        return int(self.first[np.searchsorted(-self.size, -least, side="right")])

    def level(self, k: int) -> np.ndarray:
        """Hashes of the 2**k words from each place; those that overrun a document mean nothing."""
        while len(self.levels) <= k:
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            n = self.words_of(2 * half)
            known = max(0, min(n, len(below) - half))
            out = np.zeros(n, np.uint64)
            out[:known] = mix(below[:known] * _LEFT + below[half:half + known])
            self.levels.append(out)
        return self.levels[k]

    def extend(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For places i < j of one document: equal words before them and from them on."""
        left, right = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        if not len(i):
            return left, right
        before, after = i - self.begin[i], self.end[j] - j
        for k in range(int(max(before.max(), after.max())).bit_length() - 1, -1, -1):
            h, w = self.level(k), 1 << k
            fits = np.flatnonzero(right + w <= after)
            a, b = (i + right)[fits], (j + right)[fits]
            right[fits[h[a] == h[b]]] += w
            fits = np.flatnonzero(left + w <= before)
            a, b = (i - left)[fits] - w, (j - left)[fits] - w
            left[fits[h[a] == h[b]]] += w
        return left, right

    def same(self, i: np.ndarray, j: int, w: int) -> np.ndarray:
        """Whether the w words from each place i are those from place j."""
        k = w.bit_length() - 1
        h, rest = self.level(k), w - (1 << k)
        return (h[i] == h[j]) & (h[i + rest] == h[j + rest])


def _primitive(runs: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period): of one stretch the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    keep = np.ones(len(runs), dtype=bool)
    keep[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[keep]


def _direct(t: _Texts, q: int) -> np.ndarray:
    """Runs of period q by comparing every word with that q later."""
    h = t.levels[0]
    if len(h) <= q:
        return np.zeros((0, 3), np.int64)
    at = np.flatnonzero((h[:-q] == h[q:]) & (t.doc[:-q] == t.doc[q:]))
    breaks = np.flatnonzero(np.diff(at) != 1)
    lo, hi = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(at) - 1]))
    if not len(at):
        return np.zeros((0, 3), np.int64)
    begin, end = at[lo], at[hi] + 1 + q
    keep = end - begin >= 2 * q
    return np.stack([begin[keep], end[keep], np.full(int(keep.sum()), q)], axis=1)


def _synchronising(t: _Texts, k: int, runs: np.ndarray) -> np.ndarray:
    """Chosen places of scale 2**k in documents that can hold a run of that scale."""
    w = 1 << k
    n = t.words_of(6 * w)
    ids = t.level(k)[:n].copy()
    ids[ids == _LAST] = 0
    dense = runs[(3 * runs[:, 2] <= w) & (runs[:, 1] - runs[:, 0] >= w) & (runs[:, 0] < n)]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, dense[:, 0], 1)
    np.add.at(edge, dense[:, 1] - w + 1, -1)
    ids[np.cumsum(edge[:-1]) > 0] = _LAST
    least = ids.copy()
    for s in range(k):
        least[:n - (1 << s)] = np.minimum(least[:n - (1 << s)], least[1 << s:])
    m = max(0, n - w)
    low = np.minimum(least[:m], ids[w:])
    inside = np.arange(m) + 2 * w <= t.end[:m]
    return np.flatnonzero(inside & (low != _LAST) & ((low == ids[:m]) | (low == ids[w:])))


def _pairs(t: _Texts, k: int, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of chosen places with one context, 3 to 6 times 2**k words apart."""
    w = 1 << k
    key = t.level(k + 1)[chosen] ^ mix((t.doc[chosen].astype(np.uint64) + np.uint64(1)) * _OWN)
    order = np.argsort(key)
    twice = key[order][1:] == key[order][:-1]
    shared = order[np.concatenate((twice, [False])) | np.concatenate(([False], twice))] if len(order) else order
    shared = shared[np.lexsort((chosen[shared], key[shared]))]
    place, key = chosen[shared], key[shared]
    for shift in itertools.count(1):
        far = place[shift:] - place[:-shift]
        near = (key[shift:] == key[:-shift]) & (far < 6 * w) & (t.doc[place[shift:]] == t.doc[place[:-shift]])
        if not near.any():
            return
        near &= far >= 3 * w
        yield place[:-shift][near], far[near]


def _touching(t: _Texts, k: int, runs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) that map a run of a small period on the next of that period."""
    w = 1 << k
    dense = runs[(3 * runs[:, 2] <= w) & (runs[:, 1] - runs[:, 0] >= 3 * w)]
    dense = dense[np.lexsort((dense[:, 0], dense[:, 2]))]
    if len(dense) < 2:
        return
    a, b = dense[:-1], dense[1:]
    meet = (a[:, 2] == b[:, 2]) & (a[:, 1] >= b[:, 0]) & (t.doc[a[:, 0]] == t.doc[b[:, 0]])
    for (b1, e1, p), (b2, e2, _) in zip(a[meet].tolist(), b[meet].tolist()):
        places = np.arange(e1 - 2 * p + 1, e1 - p + 1)
        alike = places[t.same(places, b2, p)]
        if not len(alike):
            continue
        shift = b2 - int(alike[0])
        low, high = 3 * w, min(6 * w - 1, e1 - b1, e2 - b2, (e2 - b1) // 2)
        q = np.arange(low + (shift - low) % p, high + 1, p)
        yield np.maximum(b1, b2 - q), q


def runs_of(hashes: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (document, start, length, period) of all runs of at least ``least`` words, by
    document, start and period; ``first`` as in ``tokens.Words``."""
    t = _Texts(hashes, first, least)
    runs = _primitive(np.concatenate([_direct(t, q) for q in range(1, SMALL)]))
    k = (SMALL // 3).bit_length() - 1
    while len(t.size) and t.size[0] >= 6 << k:
        found = [*_pairs(t, k, _synchronising(t, k, runs)), *_touching(t, k, runs)]
        if found:
            place, q = (np.concatenate(x) for x in zip(*found))
            left, right = t.extend(place, place + q)
            new = np.stack([place - left, place + q + right, q], axis=1)
            runs = _primitive(np.concatenate([runs, new[new[:, 1] - new[:, 0] >= 2 * q]]))
        k += 1
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    local = t.doc[runs[:, 0]]
    out = np.stack([t.docs[local], runs[:, 0] - t.first[local], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(text: bytes, runs: np.ndarray) -> str:
    kept = text.split()
    if len(runs):
        edge = np.zeros(len(kept) + 1, np.int64)
        np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
        np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
        kept = itertools.compress(kept, (np.cumsum(edge[:-1]) == 0).tolist())
    return b" ".join(kept).decode()


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_OUT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then
    period) and collapsed_text, the words without what a run repeats after its first period,
    joined by one space.

    Words are runs of non-white-space, unchanged, numbered from 0. All runs of at least
    ``least`` words are found, of whatever period. Documents are worked on where they are
    read; nothing is shuffled. A task holds some 2 MB of text at once, or one longer document,
    with about 16 bytes per word and power of two below the length of the longest.

    Null and blank texts have no words, no runs and an empty collapsed text. Repeated rows
    come out once each; a null doc_id stays null; other columns are left out. An empty table
    gives none. Where runs overlap, a word goes if any run drops it.
    """
    docs = same_names(docs, ("doc_id", "text")).select(F.col("doc_id").cast("long"), "text")
    arrow_batches(docs.sparkSession)

    def run(batches):
        for batch in pieces(batches):
            text = batch.column("text")
            w = words(text)
            found = runs_of(w.hash, w.first, least)
            ends = np.searchsorted(found[:, 0], np.arange(w.docs + 1))
            mine = [found[a:b] for a, b in zip(ends[:-1], ends[1:])]
            raw = [w.data[w.start[a]:w.end[b - 1]].tobytes() if b > a else b""
                   for a, b in zip(w.first[:-1], w.first[1:])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(w.first), pa.int64()),
                "runs": pa.array([[dict(zip(("start", "length", "period"), r[1:])) for r in m.tolist()] for m in mine], _RUN),
                "collapsed_text": pa.array([_collapsed(x, m) for x, m in zip(raw, mine)], pa.string())})

    return docs.mapInArrow(run, _OUT)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by the CRC-32 of doc_id, end in a
    repeated stretch. A null doc_id has no CRC-32, so its text stays as it is."""
    rows = same_names(docs, ("doc_id", "text"))
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    word = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rows = rows.withColumns({"_words": F.when(h % 10 == 0, word), "_g": F.floor(h / 10)})
    rows = rows.withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_a", F.col("_g") % F.nullif("_n", F.lit(0)))
    rows = rows.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    a, p = F.col("_a"), F.col("_p")
    made = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_n") - 1),
        lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def digest(result: DataFrame) -> DataFrame:
    """The longest run (ties: the first, then the smallest period) and hashes of the rest."""
    def rank(r: Column) -> Column:
        return F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))

    best = F.array_max(F.transform("runs", rank))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = result.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("_best.start"), F.col("_best.length"), -F.col("_best.period")
    return rows.select(
        "doc_id", "n_words", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
