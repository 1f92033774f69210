"""Toxicity: a linear model over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .chars import ngrams
from .common import arrow_batches, maybe_member, member_bitmap, partitions, quota, same_names, stored
from .tokens import pieces

SIZES = (3, 4, 5)        # characters of an n-gram
BITS = 22                # n-grams are hashed to 2**BITS features
TRAIN_ROWS = 20_000      # labelled texts that the model is fitted on, about, at most
TRAIN_CHARS = 16 << 20   # and how much text they have, about, at most
SHARDS = 64              # pieces of the count vectors
PIECE = 1 << 20          # text whose n-grams are held at once; some 40 times as many bytes
FIT_PIECE = 1 << 18      # and in the fit, where the driver unpacks a piece at a time
SPREAD = 16              # partitions of the training texts, whose number is bounded
STEPS, HISTORY, RIDGE = 60, 5, 1.0
SMOOTH = 1.0             # texts that every feature is taken to have besides, dealt over the labels as all texts are


def held_out(id: Column) -> Column:
    """Is the row kept from training? One in five, by the id's checksum."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(5)) == 0


def present(texts: list[str | None], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the distinct features of each text among the ``wanted`` (a flag
    for each feature)."""
    parts, first = ngrams(texts, SIZES, BITS)
    short = np.uint32 if len(texts) <= 1 << (32 - BITS) else np.uint64  # sorted faster
    lengths = np.diff(np.append(first, len(parts[0][0])))
    doc = np.repeat(np.arange(len(texts), dtype=short) << short(BITS), lengths)
    keys = []
    for feature, inside in parts:
        there = wanted[feature]
        there &= inside
        keys.append(doc[there] | feature[there])
    key = np.concatenate(keys)
    key.sort()
    new = np.ones(len(key), dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    key = key[new].astype(np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def _count(batches):
    """Texts with each feature, by label, as compressed shards."""
    wanted, total = np.ones(1 << BITS, dtype=bool), np.zeros((2, 1 << BITS), np.uint32)
    for batch in pieces(batches, most=PIECE):
        label = batch.column("label").to_numpy(zero_copy_only=False)
        doc, feature = present(batch.column("text").to_pylist(), wanted)
        for y in (0, 1):
            found, texts = np.unique(feature[label[doc] == y], return_counts=True)
            total[y][found] += texts.astype(np.uint32)
    zip_ = zstandard.ZstdCompressor(level=1)
    for s in range(SHARDS):
        part = np.ascontiguousarray(total.reshape(2, SHARDS, -1)[:, s])
        if part.any():
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s], pa.int64()), "counts": pa.array([zip_.compress(part.tobytes())], pa.binary())})


def _total(table: pa.Table) -> np.ndarray:
    unzip = zstandard.ZstdDecompressor()
    total = np.zeros((2, (1 << BITS) // SHARDS), np.int64)
    for c in table.column("counts"):
        total += np.frombuffer(unzip.decompress(c.as_py()), np.uint32).reshape(2, -1)
    return total


def _merge(key, table):
    """Counts of one shard from some tasks."""
    packed = zstandard.compress(_total(table).astype(np.uint32).tobytes(), 1)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "counts": pa.array([packed], pa.binary())})


def _ratios(texts: tuple[int, int]):
    """Of one shard: the log-count ratio of every feature; zero where no text has it."""
    def run(key, table):
        total = _total(table)
        clean, toxic = (total[y] + SMOOTH * texts[y] / sum(texts) for y in (0, 1))
        ratio = np.log(toxic / texts[1]) - np.log(clean / texts[0])
        ratio[total.sum(axis=0) == 0] = 0
        return pa.table({"shard": key[0:1], "ratio": pa.array([ratio.astype("<f4").tobytes()], pa.binary())})
    return run


_MORE = 0xFFFF  # a gap of at least this much, and more to come


def _gaps(columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sorted column numbers of some texts as 16-bit gaps; ``counts`` says how many each has."""
    gap = np.diff(columns, prepend=0)
    starts = (np.cumsum(counts) - counts)[counts > 0]
    gap[starts] = columns[starts]
    more, rest = np.divmod(gap, _MORE)
    out = np.full(len(gap) + int(more.sum()), _MORE, "<u2")
    out[np.cumsum(more + 1) - 1] = rest
    return out


def _columns(gaps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    reach = np.cumsum(gaps, dtype=np.uint32)  # may wrap; the differences do not, as columns are far below 2**32
    more = gaps == _MORE
    if more.any():
        reach = reach[~more]
    starts = np.cumsum(counts) - counts
    before = np.where(starts > 0, reach[np.maximum(starts, 1) - 1], 0) if len(reach) else starts
    return reach - np.repeat(before.astype(np.uint32), counts)


@dataclass
class Model:
    """``weight`` of each ``feature`` times its log-count ratio, and a constant."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.feature] = self.weight
        return dense

    def scores(self, texts: list[str | None], table: np.ndarray) -> np.ndarray:
        doc, feature = present(texts, table != 0)
        logit = self.bias + np.bincount(doc, weights=table[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


Part = tuple[np.ndarray, np.ndarray, np.ndarray]  # labels, counts and columns (as gaps) of some texts


def _logistic(parts: list[Part], ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by limited-memory quasi-Newton steps. The values of a text's
    features are the ratios, so the driver holds two bytes per feature and text, and the
    columns of one part at a time."""
    k = len(ratio)

    def loss(x):
        total, slope, scaled = 0.0, np.append(RIDGE * x[:k], 0.0), ratio * x[:k]
        for y, counts, gaps in parts:
            column = _columns(gaps, counts)
            doc = np.repeat(np.arange(len(y)), counts)
            z = x[k] + np.bincount(doc, weights=scaled[column], minlength=len(y))
            gap = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
            slope[:k] += ratio * np.bincount(column, weights=gap[doc], minlength=k)
            slope[k] += gap.sum()
            total += np.sum(np.logaddexp(0, z) - y * z)
        return total + RIDGE / 2 * x[:k] @ x[:k], slope

    n, toxic = sum(len(y) for y, _, _ in parts), sum(float(y.sum()) for y, _, _ in parts)
    x = np.zeros(k + 1)
    x[k] = np.log((toxic + 0.5) / (n - toxic + 0.5))
    at, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, rest = -slope, []
        for s, y in reversed(past):
            a = s @ way / (s @ y)
            way = way - a * y
            rest.append(a)
        if past:
            s, y = past[-1]
            way = way * (s @ y) / (y @ y)
        else:
            way = way / max(1.0, float(np.abs(way).max()))
        for (s, y), a in zip(past, reversed(rest)):
            way = way + s * (a - y @ way / (s @ y))
        step, down = 1.0, slope @ way
        while step > 1e-8:
            there, new = loss(x + step * way)
            if there <= at + 1e-4 * step * down:
                break
            step /= 2
        else:
            break
        if (new - slope) @ (step * way) > 0:
            past = [*past[-(HISTORY - 1):], (step * way, new - slope)]
        x, slope = x + step * way, new
        if at - there < 1e-5 * max(1.0, there):
            break
        at = there
    return x[:k], float(x[k])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS) -> Model:
    """Count on all labelled texts outside the held-out fold, fit on about ``train_rows`` of
    them with about ``train_chars`` characters at most, chosen by a hash of their id; both
    labels have the same quota of each, so a rare one keeps all its texts.

    The log-count ratio of every feature that a labelled text has is counted in Spark, one
    text or more; the ridge on ratios weighs rare ones. Features are hashed to 2**BITS. The
    driver gets the ratios and which features the texts of the fit have (2 bytes each, some
    60 MB, from a stored table and a partition at a time); a feature that none of them has would get no weight. With labels of
    one class only, or none, every score is that class's share (0.5 without labels). Null
    labels and ids, and labels without a document, count nothing; of several labels of an id
    the largest counts; repeated documents count each. Long texts are read whole.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = same_names(docs, ("doc_id", "text"))
    known = stored(labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
                   .groupBy(F.col("doc_id").alias("_id")).agg(F.max((F.col("toxic").cast("int") != 0).cast("int")).alias("label")), "labels")
    own = F.col("doc_id") == F.col("_id")
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("_size"))
    seen = {r["label"]: r for r in sizes.join(known, own).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_size").alias("chars")).collect()}
    n = tuple(seen[y]["n"] if y in seen else 0 for y in (0, 1))
    if not all(n):
        share = 0.5 if not sum(n) else (0.0 if n[0] else 1.0)
        return Model(np.zeros(0, np.int64), np.zeros(0), {0.0: -20.0, 0.5: 0.0, 1.0: 20.0}[share])
    # The bitmap keeps most texts without a label out of a shuffle.
    texts = maybe_member(docs, member_bitmap(known.select(F.col("_id").alias("doc_id")), "doc_id"), "doc_id").where("_maybe")
    # One kind of join at every size, so that what is moved grows with the input.
    counts = texts.join(known.hint("merge"), own).select("text", "label").mapInArrow(_count, "shard long, counts binary")
    groups = math.isqrt(partitions(spark)) + 1
    counts = counts.groupBy("shard", F.pmod(F.spark_partition_id(), F.lit(groups)).alias("part")).applyInArrow(
        _merge, "shard long, counts binary")
    dense = np.zeros((SHARDS, (1 << BITS) // SHARDS), np.float32)
    for r in counts.groupBy("shard").applyInArrow(_ratios(n), "shard long, ratio binary").collect():
        dense[r["shard"]] = np.frombuffer(r["ratio"], "<f4")

    chars = [max(seen[y]["chars"], 1) for y in (0, 1)]
    most_rows, most_chars = quota(n, train_rows), quota(chars, train_chars)
    shares = [min(1.0, most_rows / n[y], most_chars / chars[y]) for y in (0, 1)]
    share = F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    sample = stored(known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) <= share * (1 << 30)), "sample")
    kept = maybe_member(docs, member_bitmap(sample.select(F.col("_id").alias("doc_id")), "doc_id"), "doc_id").where("_maybe")
    fitted = kept.join(sample, own).select("text", "label").repartition(
        SPREAD, F.xxhash64("text"), F.monotonically_increasing_id())

    def rows(batches):
        wanted = np.ones(1 << BITS, dtype=bool)
        for batch in pieces(batches, most=FIT_PIECE):
            doc, found = present(batch.column("text").to_pylist(), wanted)
            counts = np.bincount(doc, minlength=batch.num_rows)
            yield pa.RecordBatch.from_pydict({
                "labels": pa.array([batch.column("label").cast(pa.int8()).to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                "counts": pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                "gaps": pa.array([_gaps(found, counts).tobytes()], pa.binary())})

    packed = stored(fitted.mapInArrow(rows, "labels binary, counts binary, gaps binary"), "fit")
    parts, there = [], np.zeros(1 << BITS, dtype=bool)
    for r in packed.toLocalIterator():
        part = (np.frombuffer(r["labels"], np.int8).astype(float), np.frombuffer(r["counts"], "<u4").astype(np.int64),
                np.frombuffer(r["gaps"], "<u2"))
        there[_columns(*part[:0:-1])] = True
        parts.append(part)
    place = (np.cumsum(there, dtype=np.int32) - 1).astype(np.int32)
    for i, (y, counts, gaps) in enumerate(parts):  # one at a time, so that no part is held twice
        parts[i] = y, counts, _gaps(place[_columns(gaps, counts)], counts)
    del place
    feature = np.flatnonzero(there)
    ratio = dense.reshape(-1)[feature].astype(float)
    w, b = _logistic(parts, ratio)
    weight = np.zeros(1 << BITS, np.float32)
    weight[feature] = w * ratio
    counted = np.flatnonzero(dense.reshape(-1))
    return Model(counted, weight[counted], b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Whole texts are read,
    however long; a null or empty text has no n-grams of letters and scores the constant.
    Repeated rows are scored each, a null id stays null, an empty table gives no rows, and
    other columns are left out."""
    spark = docs.sparkSession
    arrow_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        table = own.table()
        for batch in pieces(batches, most=PIECE):
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "score": pa.array(own.scores(batch.column("text").to_pylist(), table), pa.float64())})

    scored = same_names(docs, ("doc_id", "text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model rejects; all their columns as they were."""
    model = train(docs, labels)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        table = own.table()
        for batch in pieces(batches, most=PIECE):
            yield batch.filter(pa.array(own.scores(batch.column("text").to_pylist(), table) < 0.5))

    return docs.mapInArrow(run, docs.schema)
