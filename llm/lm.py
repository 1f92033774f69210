"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The probability of a word is that of its class given the two words before it, times that
of the word in its class. The class part is a maximum-entropy model on hashed features:
the previous word, the word before it (a skip feature) and both together. The word part
comes from exact counts over the whole training corpus with absolute discounting; what is
discounted is left to the unknown word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import (answers_by_block, blocks, bucket_bounds, bucket_count, decode, rows, squeeze, squeeze_sorted,
                     unsqueeze, unsqueeze_sorted)
from .common import partitions, stored
from .tokens import mix, words

OWN = 48            # commonest words, each a class of its own
ENDINGS = 79        # commonest word endings, each a class; all other words are one more
CLASSES = OWN + ENDINGS + 1
CONTEXT = 4_096     # commonest words that are features by themselves, at least; others by their ending
ROW_BITS = 13       # features are hashed to 2**ROW_BITS rows of CLASSES weights, at least
# Both follow the counted vocabulary up to a size that a task can hold (128 MB of weights).
WORDS_A_CONTEXT, MOST_CONTEXT = 512, 1 << 16
WORDS_A_ROW, MOST_ROW_BITS = 256, 18
ROUNDS = 2          # the training text is dealt over so many rounds of distributed updates
RATE = 0.5          # length of a first step
BATCH = 8_192       # contexts that are handled at once
NEAR = 1_024        # of them, those whose odds are computed while they are in the cache
SHARDS = 16         # pieces of the weights when they are averaged

END = np.uint64(0x5BD1E995F00DCAFE)  # stands for the hash of a text's end
_START = MOST_CONTEXT + (1 << 16)    # context before the first word


def held_out(id: Column) -> Column:
    """Is the row kept from training? One in five, by the id's checksum; a null id is not."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(5)) == 1


@dataclass
class Tokens:
    """Words and ends of the texts of a block: hash, ending and document of each."""

    hash: np.ndarray
    ending: np.ndarray
    doc: np.ndarray
    train: np.ndarray  # is its document in the training part?


def tokens(block: pa.RecordBatch) -> Tokens:
    w = words(block.column("text"), lower=True)
    docs = np.arange(w.docs)
    at = np.arange(len(w)) + w.doc()
    ends = w.first[1:] + docs
    h = np.empty(len(w) + w.docs, np.uint64)
    h[at], h[ends] = w.hash, END
    key = np.zeros(len(w), np.uint64)
    for k in range(3):
        place = w.end - 1 - k
        there = place >= w.start
        key |= np.where(there, w.data[np.maximum(place, 0)], 0).astype(np.uint64) << np.uint64(8 * k)
    ending = np.zeros(len(h), np.int64)
    ending[at] = (mix(key + np.uint64(1)) >> np.uint64(48)).astype(np.int64)
    doc = np.repeat(docs, np.diff(w.first) + 1)
    train = ~block.column("held_out").to_numpy(zero_copy_only=False)
    return Tokens(h, ending, doc, train[doc])


def _distinct(t: Tokens):
    """Sorted distinct hashes, where each occurs first, and the number of each token's."""
    return np.unique(t.hash, return_index=True, return_inverse=True)


def _send(buckets: int):
    def run(batches):
        for number, data in rows(batches, ("block", "data")):
            t = tokens(decode(data))
            distinct, at, place = _distinct(t)
            count = np.bincount(place[t.train], minlength=len(distinct))
            ending = t.ending[at]
            ends = bucket_bounds(distinct, buckets)
            for b in np.flatnonzero(np.diff(ends)):
                part = slice(ends[b], ends[b + 1])
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([int(b)], pa.int64()), "block": pa.array([number], pa.int64()),
                    "n": pa.array([int(ends[b + 1] - ends[b])], pa.int64()),
                    "hashes": pa.array([squeeze_sorted(distinct[part])], pa.binary()),
                    "counts": pa.array([squeeze(count[part])], pa.binary()),
                    "endings": pa.array([squeeze(ending[part])], pa.binary())})
    return run


@dataclass
class Sums:
    """Counts of a part of the vocabulary: by ending (tokens, types, types seen once and
    twice), and its commonest words."""

    table: np.ndarray   # (4, endings)
    word: np.ndarray
    count: np.ndarray
    ending: np.ndarray

    @classmethod
    def of(cls, hash: np.ndarray, total: np.ndarray, ending: np.ndarray) -> Sums:
        table = np.zeros((4, 1 << 16), np.int64)
        for k, x in enumerate((total > 0, total > 0, total == 1, total == 2)):
            table[k] = np.bincount(ending[x], weights=total[x] if k == 0 else None, minlength=1 << 16)
        most = np.lexsort((hash, -total))[:CONTEXT]
        most = most[total[most] > 0]
        return cls(table, hash[most], total[most], ending[most])

    def __add__(self, other: Sums) -> Sums:
        word, count, ending = (np.concatenate(x) for x in (
            (self.word, other.word), (self.count, other.count), (self.ending, other.ending)))
        most = np.lexsort((word, -count))[:MOST_CONTEXT]  # words are dealt by hash, so no bucket has them all
        return Sums(self.table + other.table, word[most], count[most], ending[most])

    def pack(self) -> bytes:
        words_ = np.stack([self.word.view(np.int64), self.count, self.ending])
        return zstandard.compress(self.table.tobytes() + np.ascontiguousarray(words_).tobytes(), 1)

    @classmethod
    def unpack(cls, data: bytes) -> Sums:
        x = np.frombuffer(zstandard.decompress(data), np.int64)
        word, count, ending = x[4 << 16:].reshape(3, -1)
        return cls(x[:4 << 16].reshape(4, -1), word.view(np.uint64), count, ending)


def _add(key, table):
    """Of one bucket: the count of each hash in the corpus, for every block that asked, and
    one row with its sums."""
    sent = table.to_pylist()
    h = np.concatenate([unsqueeze_sorted(r["hashes"], r["n"]) for r in sent])
    count = np.concatenate([unsqueeze(r["counts"], r["n"]) for r in sent]).astype(np.int64)
    ending = np.concatenate([unsqueeze(r["endings"], r["n"]) for r in sent]).astype(np.int64)
    distinct, at, place = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(place, weights=count, minlength=len(distinct)).astype(np.int64)
    edges = np.concatenate(([0], np.cumsum([r["n"] for r in sent])))
    reply = [squeeze(total[place[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
    bucket = key[0].as_py()
    return pa.table({
        "block": pa.array([r["block"] for r in sent] + [None], pa.int64()),
        "bucket": pa.array([bucket] * (len(sent) + 1), pa.int64()), "reply": pa.array(reply + [None], pa.binary()),
        "sums": pa.array([None] * len(sent) + [Sums.of(distinct, total, ending[at]).pack()], pa.binary())})


def _merge(key, table):
    total = None
    for data in table.column("sums"):
        part = Sums.unpack(data.as_py())
        total = part if total is None else total + part
    return pa.table({"sums": pa.array([total.pack()], pa.binary())})


def sums_by_row(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``row``, sorted, and the sum of the ``values`` (rows) of each.
    Neighbours are added in pairs, then pairs in pairs: few steps for long runs, and rows
    that are alone are not touched."""
    bits = len(row).bit_length()
    key = np.sort(row << bits | np.arange(len(row)))
    ordered, out = key >> bits, values[key & ((1 << bits) - 1)]
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    begin = np.flatnonzero(new)
    runs = np.diff(begin, append=len(ordered))
    rank = np.arange(len(ordered)) - np.repeat(begin, runs)
    left, step = np.repeat(runs, runs) - rank, 1
    at = np.flatnonzero((rank % 2 == 0) & (left > 1))
    while len(at):
        out[at] += out[at + step]
        step *= 2
        at = at[(rank[at] % (2 * step) == 0) & (left[at] > step)]
    return ordered[begin], out[begin]


@dataclass
class Model:
    n: int                  # training tokens
    v: int                  # distinct ones
    own: np.ndarray         # hashes of words with their own class, sorted
    own_class: np.ndarray
    class_of: np.ndarray    # class of each ending
    total: np.ndarray       # training tokens of each class
    types: np.ndarray
    discount: float
    common: np.ndarray      # hashes of words that are features, sorted
    weights: np.ndarray     # (rows, classes)
    bias: np.ndarray

    def classes(self, t: Tokens) -> np.ndarray:
        out = self.class_of[t.ending]
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, t.hash), len(self.own) - 1)
            out = np.where(self.own[at] == t.hash, self.own_class[at], out)
        return out

    def contexts(self, t: Tokens):
        """Distinct contexts (previous, one before) as rows of features, the tokens in the
        order of their contexts, and the number of each one's context in that order."""
        kind = MOST_CONTEXT + t.ending
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, t.hash), len(self.common) - 1)
            kind = np.where(self.common[at] == t.hash, at, kind)
        one, two = np.full(len(kind), _START), np.full(len(kind), _START)
        one[1:] = np.where(t.doc[1:] == t.doc[:-1], kind[:-1], _START)
        two[2:] = np.where(t.doc[2:] == t.doc[:-2], kind[:-2], _START)
        pair = one << 20 | two
        order = np.argsort(pair)
        pair = pair[order]
        new = np.ones(len(pair), dtype=bool)
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        place, pair = np.cumsum(new) - 1, pair[new]
        one, two = (pair >> 20).astype(np.uint64), (pair & 0xFFFFF).astype(np.uint64)
        down = np.uint64(64 - (len(self.weights).bit_length() - 1))
        features = np.stack([
            mix(one << np.uint64(2) | np.uint64(1)) >> down, mix(two << np.uint64(2) | np.uint64(2)) >> down,
            mix(pair.astype(np.uint64) << np.uint64(2) | np.uint64(3)) >> down], axis=1).astype(np.int64)
        return features, order, place

    def odds(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each context: numbers in proportion to the classes' probabilities, and their sum."""
        out, total = np.empty((len(features), CLASSES), np.float32), np.empty(len(features), np.float32)
        for at in range(0, len(features), NEAR):
            rows_, part = features[at:at + NEAR], out[at:at + NEAR]
            np.take(self.weights, rows_[:, 0], axis=0, out=part, mode="clip")
            part += self.weights[rows_[:, 1]]
            part += self.weights[rows_[:, 2]]
            part += self.bias
            part -= part.max(axis=1, keepdims=True)
            np.exp(part, out=part)
            part.sum(axis=1, out=total[at:at + NEAR])
        return out, total

    def learn(self, t: Tokens, seen: np.ndarray) -> None:
        """Gradient steps on the training tokens of a block, a batch of contexts at a time;
        the steps of a row shrink with the gradients it has seen (``seen``)."""
        t = Tokens(t.hash[t.train], t.ending[t.train], t.doc[t.train], t.train[t.train])  # whole documents
        features, order, place = self.contexts(t)
        cls = self.classes(t)[order]
        edges = np.searchsorted(place, np.arange(0, len(features) + BATCH, BATCH))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            part = features[k * BATCH:(k + 1) * BATCH]
            p, total = self.odds(part)
            at = place[a:b] - k * BATCH
            p *= (np.bincount(at, minlength=len(part)) / total).astype(np.float32)[:, None]
            np.subtract.at(p.reshape(-1), at * CLASSES + cls[a:b], np.float32(1))
            for j in range(3):
                row, slope = sums_by_row(p, part[:, j])
                seen[row] += np.einsum("ij,ij->i", slope, slope)
                slope *= (RATE / np.sqrt(seen[row] + np.float32(1e-6)))[:, None]
                self.weights[row] -= slope

    def score(self, t: Tokens, count: np.ndarray) -> np.ndarray:
        """log10 probability of each token, given how often training has it."""
        if not self.n:
            return np.zeros(len(t.hash))
        features, order, place = self.contexts(t)
        cls = self.classes(t)
        own = cls < OWN
        inside = np.where(own, 1.0, (count - self.discount) / np.maximum(self.total[cls], 1))
        left = np.where(self.total > 0, self.discount * self.types / np.maximum(self.total, 1), 1.0)
        left[:OWN] = np.where(self.total[:OWN] > 0, 0.0, 1.0)  # nothing is discounted from a single word
        left = left.astype(np.float32)
        edges = np.searchsorted(place, np.arange(0, len(features) + BATCH, BATCH))
        out = np.empty(len(place))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            p, total = self.odds(features[k * BATCH:(k + 1) * BATCH])
            mine, at = order[a:b], place[a:b] - k * BATCH
            out[mine] = np.where(count[mine] > 0, p[at, cls[mine]] * inside[mine], (p @ left)[at]) / total[at]
        return np.log10(np.maximum(out, 1e-300))


def _start(sums: DataFrame, buckets: int) -> Model:
    """Classes and counts from the sums of all buckets, merged in two steps; no weights yet.
    What comes to the driver is a row per group of buckets, each of bounded size."""
    groups = math.isqrt(buckets) + 1
    merged = sums.select("bucket", "sums").groupBy(F.pmod("bucket", F.lit(groups)).alias("group")).applyInArrow(
        _merge, "sums binary").toArrow()
    all_ = Sums.of(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for data in merged.column("sums").to_pylist():
        all_ = all_ + Sums.unpack(data)
    table, word, count, ending = all_.table.copy(), all_.word, all_.count, all_.ending
    n, v, ones, twos = (int(x) for x in table.sum(axis=1))
    total, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    m = min(OWN, len(word))
    total[:m], types[:m] = count[:m], 1
    np.subtract.at(table[0], ending[:m], count[:m])
    np.subtract.at(table[1], ending[:m], 1)
    class_of = np.full(1 << 16, CLASSES - 1)
    best = np.argsort(-table[0], kind="stable")[:ENDINGS]
    class_of[best] = OWN + np.arange(len(best))
    total += np.bincount(class_of, weights=table[0], minlength=CLASSES).astype(np.int64)
    types += np.bincount(class_of, weights=table[1], minlength=CLASSES).astype(np.int64)
    by_hash = np.argsort(word[:m])
    bias = np.log((total + 0.5) / (n + 0.5 * CLASSES)).astype(np.float32)
    bits = min(MOST_ROW_BITS, max(ROW_BITS, (v // WORDS_A_ROW).bit_length()))
    common = np.sort(word[:min(MOST_CONTEXT, max(CONTEXT, v // WORDS_A_CONTEXT))])
    return Model(n, v, word[:m][by_hash], by_hash, class_of, total, types,
                 min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5,
                 common, np.zeros((1 << bits, CLASSES), np.float32), bias)


def _pack_rows(weight: np.ndarray, sums: np.ndarray, kind: str) -> tuple[bytes, bytes]:
    """The rows with a weight: the weights of all rows, and the sums of those rows."""
    there = weight > 0
    return (zstandard.compress(weight.astype("<f4").tobytes(), 1),
            zstandard.compress(np.ascontiguousarray(sums[there]).astype(kind).tobytes(), 1))


def _add_rows(table: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Weights and weighted sums of the rows of a shard, over some tasks."""
    weight = sums = None
    for r in table.to_batches():
        for w, data in zip(r.column("weight"), r.column("sums")):
            w = np.frombuffer(zstandard.decompress(w.as_py()), "<f4")
            if sums is None:
                weight, sums = np.zeros(len(w)), np.zeros((len(w), CLASSES))
            part = np.frombuffer(zstandard.decompress(data.as_py()), kind).reshape(-1, CLASSES)
            # A task's own changes come as they are and get its weight here; sums are weighted already.
            sums[w > 0] += part * w[w > 0, None] if kind == "<f2" else part
            weight += w
    return weight, sums


def _round(packed: DataFrame, model: Model, k: int) -> np.ndarray:
    """One round of distributed updates: tasks take gradient steps on their blocks from the
    same weights. Each row's changes are averaged over the tasks that touched it, weighted
    by how many blocks those saw, in two steps, so that no group grows with their number."""
    spark = packed.sparkSession
    sent, size = spark.sparkContext.broadcast(model), len(model.weights)

    def run(batches):
        own, seen, n = None, np.zeros(size, np.float32), 0
        for (data,) in rows(batches, ("data",)):
            if own is None:
                own = Model(**{**sent.value.__dict__, "weights": sent.value.weights.copy()})
            own.learn(tokens(decode(data)), seen)
            n += 1
        if own is not None:
            change = (own.weights - sent.value.weights).reshape(SHARDS, -1, CLASSES)
            weight = np.where(seen > 0, n, 0).reshape(SHARDS, -1)
            for s in range(SHARDS):
                w, data = _pack_rows(weight[s], change[s], "<f2")
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([s], pa.int64()), "weight": pa.array([w], pa.binary()), "sums": pa.array([data], pa.binary())})

    def merge(key, table):
        w, data = _pack_rows(*_add_rows(table, "<f2"), "<f4")
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "weight": pa.array([w], pa.binary()),
                         "sums": pa.array([data], pa.binary())})

    def average(key, table):
        weight, sums = _add_rows(table, "<f4")
        change = sums / np.maximum(weight, 1)[:, None]
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "change": pa.array([change.astype("<f4").tobytes()], pa.binary())})

    part = packed.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == k).select("data")
    groups = math.isqrt(partitions(spark)) + 1
    kinds = "shard long, weight binary, sums binary"
    merged = part.mapInArrow(run, kinds).groupBy("shard", F.pmod(F.spark_partition_id(), F.lit(groups)).alias("part")).applyInArrow(
        merge, kinds)
    got = merged.groupBy("shard").applyInArrow(average, "shard long, change binary").toArrow()
    out = model.weights.reshape(SHARDS, -1).copy()
    for s, data in zip(got.column("shard").to_pylist(), got.column("change").to_pylist()):
        out[s] += np.frombuffer(data, "<f4")
    return out.reshape(model.weights.shape)


_OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(buckets: int, sent):
    def run(batches):
        for data, replies in rows(batches, ("data", "replies")):
            model, block = sent.value, decode(data)
            t = tokens(block)
            distinct, _, place = _distinct(t)
            ends = bucket_bounds(distinct, buckets)
            counts = np.zeros(len(distinct), np.int64)
            for r in replies or []:
                a, b = ends[r["bucket"]], ends[r["bucket"] + 1]
                counts[a:b] = unsqueeze(r["reply"], int(b - a)).astype(np.int64)
            count = counts[place]
            base = np.log10((count + 0.5) / (model.n + 0.5 * (model.v + 1)))
            n = block.num_rows
            yield pa.RecordBatch.from_pydict({
                "doc_id": block.column("doc_id").cast(pa.int64()), "held_out": block.column("held_out"),
                "n_tokens": pa.array(np.bincount(t.doc, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(t.doc[count > 0], minlength=n), pa.int64()),
                "train_tokens": pa.array(np.full(n, model.n), pa.int64()),
                "base_score": pa.array(np.bincount(t.doc, weights=base, minlength=n), pa.float64()),
                "score": pa.array(np.bincount(t.doc, weights=model.score(t, count), minlength=n), pa.float64())})
    return run


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the whole text and its end).

    Tokens are the words of the text, A-Z lower-cased, and one end. Counts cover every
    training document: each block of documents sends its distinct word hashes with counts
    to hash ranges and is told the corpus counts, so no word list of the corpus is ever in
    one place. Weights are trained on every training document, in ROUNDS rounds over
    disjoint parts; what a task returns is the change of the weights, of fixed size.

    The context model follows the counted vocabulary: a feature row per WORDS_A_ROW words
    and a word feature per WORDS_A_CONTEXT, within bounds that let a task hold the weights.

    Null and blank texts are an end alone. Rows with equal ids, also repeated ones, are
    separate texts; texts are read whole, however long; other columns are left out and an
    empty table gives no rows. A null id counts as a training document. Without training documents every known count is 0,
    base_score is 0 and so is score.
    """
    packed = blocks(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")))
    buckets = bucket_count(packed, hashes_per_byte=0.03)
    sent = packed.select("block", "data").mapInArrow(
        _send(buckets), "bucket long, block long, n long, hashes binary, counts binary, endings binary")
    told = stored(sent.groupBy("bucket").applyInArrow(
        _add, "block long, bucket long, reply binary, sums binary"), "counts")
    model = _start(told.where("block is null"), buckets)
    for k in range(ROUNDS if model.n else 0):
        model.weights = _round(packed, model, k)
    asked = answers_by_block(packed.select("block", "data"), told.where("block is not null").select("block", "bucket", "reply"))
    return asked.select("data", "replies").mapInArrow(
        _score(buckets, docs.sparkSession.sparkContext.broadcast(model)), _OUT)
