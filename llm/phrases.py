"""Benchmark passages in a corpus, by a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .blocks import BLOCK_BYTES, cut, long_ids, rows, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted
from .common import ROW, arrow_batches, numbered, same_names, stored, without
from .substrings import covered
from .tokens import words

WINDOW = 10
PIECE_WORDS = 4_096         # words of an item that are sent as one row
QUERY_WORDS = 1_000_000     # words of items that are looked up in one pass (8 MB of hashes)

_INDEX = ("shard long, docs long, ids binary, first binary, n_terms long, terms binary, counts binary,"
          " n_words long, postings binary")


def index(docs: DataFrame) -> DataFrame:
    """Store the positional postings of every word of every document, sharded by document.

    One row per shard of a few MB of text: the sorted hashes of its distinct words, how
    often each occurs, and the word numbers where it does, as differences. Words are runs
    of letters, digits and non-ASCII characters of the text, A-Z lower-cased.
    """
    arrow_batches(docs.sparkSession)

    def build(batches):
        part = TaskContext.get().partitionId()
        for seq, block in enumerate(cut(batches, "text", BLOCK_BYTES)):
            w = words(block.column("text"), alnum=True, lower=True)
            order = np.argsort(w.hash, kind="stable")
            terms, begin = np.unique(w.hash[order], return_index=True)
            counts = np.diff(np.append(begin, len(order)))
            gaps = np.diff(order, prepend=0)
            gaps[begin] = order[begin]                       # a list starts with its first place
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([(part << 33) + seq], pa.int64()), "docs": pa.array([w.docs], pa.int64()),
                "ids": pa.array([squeeze(long_ids(block.column("doc_id")))], pa.binary()),
                "first": pa.array([squeeze(w.first)], pa.binary()),
                "n_terms": pa.array([len(terms)], pa.int64()),
                "terms": pa.array([squeeze_sorted(terms)], pa.binary()),
                "counts": pa.array([squeeze(counts)], pa.binary()),
                "n_words": pa.array([len(w)], pa.int64()), "postings": pa.array([squeeze(gaps)], pa.binary())})

    return stored(same_names(docs, ("doc_id", "text")).mapInArrow(build, _INDEX), "postings")


@dataclass
class Shard:
    """Postings of one shard: sorted keys (number of the term, place), and its documents."""

    terms: np.ndarray
    keys: np.ndarray    # term number << 32 | place
    begin: np.ndarray   # first posting of each term, and the total
    first: np.ndarray

    @classmethod
    def of(cls, docs, first, n_terms, terms, counts, n_words, postings) -> Shard:
        count = unsqueeze(counts, n_terms).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(count)))
        gaps = unsqueeze(postings, n_words).astype(np.int64)
        place = np.cumsum(gaps)
        if len(place):
            head = begin[:-1]
            place -= np.repeat(place[head] - gaps[head], count)
        term = np.repeat(np.arange(n_terms, dtype=np.int64), count)
        return cls(unsqueeze_sorted(terms, n_terms), term << 32 | place, begin, unsqueeze(first, docs + 1).astype(np.int64))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers of hashes, -1 for a word that the shard doesn't have."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def postings(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of some terms: (which of them, place)."""
        n = self.begin[term + 1] - self.begin[term]
        which = np.repeat(np.arange(len(term)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.begin[term][which]
        return which, self.keys[at] & 0xFFFFFFFF

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Does each term have a posting at this place?"""
        want = term << 32 | place
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return self.keys[at] == want

    def near(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does each term have a posting from low to high?"""
        at = np.searchsorted(self.keys, term << 32 | low)
        inside = np.minimum(at, len(self.keys) - 1)
        return (at < len(self.keys)) & (self.keys[inside] <= (term << 32 | high))


@dataclass
class Phrases:
    """Distinct windows of some items; ``order`` has the places of each window's words
    from the rarest to the commonest (-1 behind a short window)."""

    hashes: np.ndarray  # (windows, size)
    length: np.ndarray
    order: np.ndarray
    window: np.ndarray  # the window of each (window, item) pair
    item: np.ndarray

    def find(self, shard: Shard, within: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(window, first place) of every occurrence in a shard.

        Starts from the postings of the rarest word and keeps those whose places, moved by
        the offset between the words, are in the lists of the other words as well. With
        ``within``: (window, place of its rarest word) where all its words occur, in any
        order, at most so many words from there.
        """
        size = self.hashes.shape[1]
        lead = self.order[:, 0]
        term = shard.number(self.hashes[np.arange(len(lead)), lead]) if len(lead) else np.zeros(0, np.int64)
        live = np.flatnonzero(term >= 0)
        which, place = shard.postings(term[live])
        window = live[which]
        if not len(window):
            return window, place
        doc = np.searchsorted(shard.first, place, side="right") - 1
        if within is None:
            place = place - lead[window]
            keep = (place >= shard.first[doc]) & (place + self.length[window] <= shard.first[doc + 1])
            window, place = window[keep], place[keep]
        else:
            low = np.maximum(place - within, shard.first[doc])
            high = np.minimum(place + within, shard.first[doc + 1] - 1)
        for rank in range(1, size):
            slot = self.order[window, rank]
            check = slot >= 0
            if not check.any():
                break
            word = shard.number(self.hashes[window, np.maximum(slot, 0)])
            if within is None:
                found = (word >= 0) & shard.has(np.maximum(word, 0), place + np.maximum(slot, 0))
            else:
                found = (word >= 0) & shard.near(np.maximum(word, 0), low, high)
                low, high = low[found | ~check], high[found | ~check]
            window, place = window[found | ~check], place[found | ~check]
            if not len(window):
                break
        return window, place


def _pieces(size: int):
    """Items as rows of at most PIECE_WORDS + size - 1 word hashes."""
    def run(batches):
        for batch in batches:
            w = words(batch.column("text"), alnum=True, lower=True)
            ids = batch.column("item_id").cast(pa.string()).to_pylist()
            for d in range(w.docs):
                h = w.hash[w.first[d]:w.first[d + 1]]
                if ids[d] is None or not len(h):
                    continue
                starts = range(0, max(1, len(h) - size + 1), PIECE_WORDS)
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([ids[d]] * len(starts), pa.string()),
                    "n": pa.array([len(h[s:s + PIECE_WORDS + size - 1]) for s in starts], pa.int64()),
                    "hashes": pa.array([h[s:s + PIECE_WORDS + size - 1].tobytes() for s in starts], pa.binary())})
    return run


def _windows(pieces: list, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows as (hashes, length), and the (window, item) pairs."""
    table, length, item = [], [], []
    for name, data in pieces:
        h = np.frombuffer(data, np.uint64)
        n = max(1, len(h) - size + 1)
        rows_ = np.zeros((n, size), np.uint64)
        wide = min(size, len(h))
        rows_[:, :wide] = np.lib.stride_tricks.sliding_window_view(h, wide)[:n]
        table.append(rows_)
        length.append(np.full(n, wide))
        item += [name] * n
    table = np.concatenate([np.concatenate(table), np.concatenate(length)[:, None].astype(np.uint64)], axis=1)
    distinct, window = np.unique(table, axis=0, return_inverse=True)
    return distinct[:, :-1], distinct[:, -1].astype(np.int64), window.reshape(-1), np.array(item, dtype=object)


def _rarest_first(postings: DataFrame, hashes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order of the words of each window by how often the corpus has them, counted over all
    shards. Only terms and counts of the index are read."""
    sc = postings.sparkSession.sparkContext
    inside = np.arange(hashes.shape[1]) < length[:, None]
    wanted = sc.broadcast(np.unique(hashes[inside]))

    def count(batches) -> Iterator[pa.RecordBatch]:
        terms = wanted.value
        total = np.zeros(len(terms), np.int64)
        for n, data, counts in rows(batches, ("n_terms", "terms", "counts")):
            have = unsqueeze_sorted(data, n)
            if n:
                at = np.minimum(np.searchsorted(have, terms), n - 1)
                total += np.where(have[at] == terms, unsqueeze(counts, n).astype(np.int64)[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    summed = postings.select("n_terms", "terms", "counts").mapInArrow(count, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(wanted.value), np.int64)
    frequency[summed.column("term").to_numpy()] = summed.column("n").to_numpy()
    cost = np.where(inside, frequency[np.searchsorted(wanted.value, np.where(inside, hashes, wanted.value[0]))], 2**62)
    order = np.argsort(cost, axis=1, kind="stable")
    return np.where(np.take_along_axis(inside, order, axis=1), order, -1)


_HITS = "shard long, doc long, starts binary, lengths binary, items array<string>"


def _match(found: Phrases, within: int | None, sc):
    sent = sc.broadcast(found)

    def run(batches):
        phrases = sent.value
        by_window = np.argsort(phrases.window, kind="stable")
        edges = np.searchsorted(phrases.window[by_window], np.arange(len(phrases.length) + 1))
        names = ("shard", "docs", "first", "n_terms", "terms", "counts", "n_words", "postings")
        for number, *parts in rows(batches, names):
            shard = Shard.of(*parts)
            window, place = phrases.find(shard, within)
            doc = np.searchsorted(shard.first, place, side="right") - 1
            order = np.argsort(doc, kind="stable")
            window, place, doc = window[order], place[order], doc[order]
            starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else []
            out = []
            for a, b in zip(starts, [*starts[1:], len(doc)]):
                mine = np.unique(window[a:b])
                items = {phrases.item[by_window[j]] for v in mine for j in range(edges[v], edges[v + 1])}
                out.append((doc[a], (place[a:b] - shard.first[doc[a]]).tobytes(),
                            phrases.length[window[a:b]].tobytes(), sorted(items)))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([number] * len(out), pa.int64()), "doc": pa.array([o[0] for o in out], pa.int64()),
                "starts": pa.array([o[1] for o in out], pa.binary()),
                "lengths": pa.array([o[2] for o in out], pa.binary()),
                "items": pa.array([o[3] for o in out], pa.list_(pa.string()))})
    return run


def _documents(batches):
    """Per document: words, hit words, items, spans of hit words."""
    for docs, ids, first, hits in rows(batches, ("docs", "ids", "first", "hits")):
        id, edge = unsqueeze(ids, docs).astype(np.int64), unsqueeze(first, docs + 1).astype(np.int64)
        n = np.diff(edge)
        n_hit, items, near = np.zeros(docs, np.int64), [[] for _ in range(docs)], np.zeros(docs, np.int64)
        by_doc: dict[int, list] = {}
        for h in hits or []:
            by_doc.setdefault(h["doc"], []).append(h)
        for d, own in by_doc.items():
            starts = np.concatenate([np.frombuffer(h["starts"], np.int64) for h in own])
            lengths = np.concatenate([np.frombuffer(h["lengths"], np.int64) for h in own])
            mask = np.zeros(n[d], dtype=bool)
            for size in np.unique(lengths):
                mask |= covered(int(n[d]), starts[lengths == size], int(size))
            n_hit[d], near[d] = mask.sum(), len(starts)
            items[d] = sorted({i for h in own for i in h["items"]})
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(id, pa.int64(), mask=id == np.iinfo(np.int64).max), "n_words": pa.array(n, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()), "matches": pa.array(near, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string()))})


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, within: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, matches, items.

    A window is ``size`` consecutive words of an item; an item of fewer is one window. A
    document word inside any occurrence of a window is hit; ``items`` are the ids, as
    text, of the items with a window there, ``matches`` the number of occurrences. With
    ``within`` the words of a window match in any order, that near to its rarest one
    (a proximity match; ``n_hit`` then counts words from that one on).

    The postings of all documents are stored once. Windows are looked up shard by shard,
    at most QUERY_WORDS words of items per pass, so a larger benchmark means more passes
    over the index and not a larger broadcast. Only hits and document lengths move.

    Null or blank texts, of documents and items, have no words and match nothing. Items
    with a null id are left out. Repeated items and equal windows of several items count
    for each item. Repeated documents are judged each. An empty benchmark hits nothing.
    """
    postings = index(docs)
    sc = docs.sparkSession.sparkContext
    pieces = stored(same_names(benchmark, ("item_id", "text")).mapInArrow(
        _pieces(size), "item string, n long, hashes binary"), "items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    passes = -(-total // QUERY_WORDS)
    hits = None
    for k in range(passes):
        part = pieces.where(F.pmod(F.xxhash64("item", "hashes"), F.lit(passes)) == k)
        got = part.select("item", "hashes").toArrow()
        if not got.num_rows:
            continue
        hashes, length, window, item = _windows(
            list(zip(got.column("item").to_pylist(), got.column("hashes").to_pylist())), size)
        found = Phrases(hashes, length, _rarest_first(postings, hashes, length), window, item)
        rows_ = postings.drop("ids").mapInArrow(_match(found, within, sc), _HITS)
        hits = rows_ if hits is None else hits.unionByName(rows_)
    shards = postings.select("shard", "docs", "ids", "first")
    if hits is None:
        told = shards.withColumn("hits", F.lit(None).cast("array<struct<doc:long,starts:binary,lengths:binary,items:array<string>>>"))
    else:
        by_shard = hits.groupBy(F.col("shard").alias("_shard")).agg(
            F.collect_list(F.struct("doc", "starts", "lengths", "items")).alias("hits"))
        told = shards.join(by_shard, F.col("shard") == F.col("_shard"), "left")
    return told.select("docs", "ids", "first", "hits").mapInArrow(
        _documents, "doc_id long, n_words long, n_hit long, matches long, items array<string>")


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; all their columns as they were."""
    kept = numbered(docs, "phrases")
    result = decontaminate(kept.select(F.col(ROW).alias("doc_id"), "text"), benchmark, size)
    return without(kept, result.where("n_hit > 0").select("doc_id"))
