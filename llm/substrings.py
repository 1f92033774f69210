"""Repeated passages: rolling hashes of every window of words, counted over the corpus."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import (answers_by_block, blocks, bucket_bounds, bucket_count, decode, long_ids, rows, squeeze,
                     squeeze_sorted, unsqueeze, unsqueeze_sorted)
from .common import same_names
from .tokens import Words, window_hashes, words

WINDOW = 13


def _windows(block: pa.RecordBatch, size: int):
    """Words, window hashes and places of a block, its sorted distinct hashes, the smallest
    id of each, and the number of each window among them."""
    w = words(block.column("text"))
    ids = long_ids(block.column("doc_id"))
    h, at = window_hashes(w, size)
    doc = np.searchsorted(w.first, at, side="right") - 1
    own = ids[doc] if len(doc) else np.zeros(0, np.int64)
    distinct, place = np.unique(h, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, place, own)
    return w, at, own, distinct, place, least


def _send(size: int, buckets: int):
    def run(batches):
        for number, data in rows(batches, ("block", "data")):
            *_, distinct, _, least = _windows(decode(data), size)
            ends = bucket_bounds(distinct, buckets)
            for b in np.flatnonzero(np.diff(ends)):
                part = slice(ends[b], ends[b + 1])
                floor = int(least[part].min())
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([int(b)], pa.int64()), "block": pa.array([number], pa.int64()),
                    "n": pa.array([int(ends[b + 1] - ends[b])], pa.int64()), "floor": pa.array([floor], pa.int64()),
                    "hashes": pa.array([squeeze_sorted(distinct[part])], pa.binary()),
                    "ids": pa.array([squeeze((least[part] - floor).astype(np.uint64))], pa.binary())})
    return run


def _compare(key, table):
    """Of one bucket: a bit per hash and block, set if a smaller id has the hash elsewhere."""
    sent = table.to_pylist()
    counts = [r["n"] for r in sent]
    h = np.concatenate([unsqueeze_sorted(r["hashes"], r["n"]) for r in sent])
    i = np.concatenate([unsqueeze(r["ids"], r["n"]).astype(np.int64) + r["floor"] for r in sent])
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    run = np.concatenate(([True], sorted_h[1:] != sorted_h[:-1]))
    least = np.minimum.reduceat(i[order], np.flatnonzero(run))
    later = np.empty(len(h), dtype=bool)
    later[order] = i[order] > least[np.cumsum(run) - 1]
    ends = np.concatenate(([0], np.cumsum(counts)))
    out = [(r["block"], np.packbits(later[a:b]).tobytes())
           for r, a, b in zip(sent, ends[:-1], ends[1:]) if later[a:b].any()]
    return pa.table({
        "block": pa.array([b for b, _ in out], pa.int64()),
        "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()),
        "reply": pa.array([r for _, r in out], pa.binary())})


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def intervals(mask: np.ndarray) -> np.ndarray:
    """Maximal runs of true values as rows (first, behind last)."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def _document(w: Words, d: int, gone: np.ndarray) -> tuple[int, int, list, str]:
    first, last = w.first[d], w.first[d + 1]
    if first == last:
        return 0, 0, [], ""
    mine = gone[first:last]
    text = w.data[w.start[first]:w.end[last - 1]].tobytes().split()
    if not mine.any():
        return len(text), 0, [], b" ".join(text).decode()
    spans = [{"start": int(a), "end": int(b)} for a, b in intervals(mine)]
    return len(text), int(mine.sum()), spans, b" ".join(itertools.compress(text, (~mine).tolist())).decode()


_OUT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def _remove(size: int, buckets: int):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for data, replies in rows(batches, ("data", "replies")):
            block = decode(data)
            w, at, own, distinct, place, least = _windows(block, size)
            elsewhere = np.zeros(len(distinct), dtype=bool)
            ends = bucket_bounds(distinct, buckets)
            for r in replies or []:
                a, b = ends[r["bucket"]], ends[r["bucket"] + 1]
                elsewhere[a:b] = np.unpackbits(np.frombuffer(r["reply"], np.uint8), count=b - a)
            repeat = elsewhere[place] | (own > least[place])
            gone = covered(len(w), at[repeat], size)
            out = [_document(w, d, gone) for d in range(w.docs)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": block.column("doc_id").cast(pa.int64()),
                "n_words": pa.array([o[0] for o in out], pa.int64()),
                "n_removed": pa.array([o[1] for o in out], pa.int64()),
                "spans": pa.array([o[2] for o in out], spans), "kept_text": pa.array([o[3] for o in out], pa.string())})
    return run


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans of removed words, kept_text.

    Words are runs of non-white-space, unchanged. A word goes if it lies in a window of
    ``size`` words whose sequence also starts in a document with a smaller id; overlapping
    windows merge into maximal spans [start, end) of word numbers. Windows are judged on
    the input. ``kept_text`` joins the kept words by one space.

    Every window of every document takes part: a block sends each distinct window hash
    with the smallest id that has it to the hash's bucket, which answers one bit. A
    passage in a third of all documents is one entry per block. A wrong hit needs two
    different windows with one 64-bit hash: at 10**12 windows that is expected for a few
    hundred thousandths of a percent of them.

    Null and blank texts have no words; a document shorter than ``size`` loses none.
    Repeated rows with one id do not remove each other; a null id counts as the largest.
    """
    docs = same_names(docs, ("doc_id", "text"))
    packed = blocks(docs)
    buckets = bucket_count(packed)
    sent = packed.select("block", "data").mapInArrow(
        _send(size, buckets), "bucket long, block long, n long, floor long, hashes binary, ids binary")
    replies = sent.groupBy("bucket").applyInArrow(_compare, "block long, bucket long, reply binary")
    told = answers_by_block(packed.select("block", "data"), replies)
    return told.select("data", "replies").mapInArrow(_remove(size, buckets), _OUT)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
