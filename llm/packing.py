"""Pack token sequences: first-fit decreasing in random groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, same_names, stored
from .encoding import Encoder
from .tokens import pieces as cut_batches

LENGTH = 1024
GROUP_PIECES = 20_000  # pieces that are packed together
END = 0


class Bins:
    """Capacities left in bins, as a tournament: the root knows the roomiest bin, and the
    first bin with enough room is found by one walk from the root."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put a piece into the first bin that takes it."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        room[at] -= size
        found = at - self.leaves
        while at > 1:
            at //= 2
            left, right = room[2 * at], room[2 * at + 1]
            room[at] = left if left >= right else right
        return found


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece; no piece may be larger than ``capacity``."""
    bins, used, out = Bins(capacity, max(1, len(sizes))), {}, [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = bins.place(sizes[i])
        out[i] = (b, used.get(b, 0))
        used[b] = out[i][1] + sizes[i]
    return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _encode(path: str, spaced: bool, end: int, length: int, keep: bool):
    tail = end.to_bytes(4, "little")

    def run(batches):
        encoder = Encoder.of(path, spaced)
        for batch in cut_batches(batches):
            out = []
            for doc, data in zip(batch.column("doc_id").to_pylist(), encoder(batch.column("text").to_pylist())):
                data += tail
                n = len(data) // 4
                for start in range(0, n, length):
                    part = data[4 * start:4 * (start + length)]
                    out.append((doc, start, len(part) // 4, zlib.crc32(part), n, part if keep else None))
            doc, start, size, crc, n, part = zip(*out)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()),
                "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(n, pa.int64()), **({"ids": pa.array(part, pa.binary())} if keep else {})})
    return run


def _fill(length: int):
    def run(key, table):
        place = first_fit_decreasing(table.column("length").to_pylist(), length)
        group = key[0].as_py()
        return pa.table({
            "row": table.column("row"), "sequence_id": pa.array([(group << 32 | b) << 1 | 1 for b, _ in place], pa.int64()),
            "offset": pa.array([o for _, o in place], pa.int64())})
    return run


def pack(docs: DataFrame, tokenizer: str, spaced: bool = True, end: int = END, length: int = LENGTH,
         group_pieces: int = GROUP_PIECES, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids``, if asked for).

    A document's ids are those of its text and ``end``. It is cut every ``length`` ids.
    Full pieces are sequences of their own. The last pieces of documents are dealt into
    random groups of about ``group_pieces`` and each group is packed by first-fit
    decreasing, so the number of groups grows with the input and a group stays small.
    Only (number, length) of the last pieces is shuffled, whatever the texts' sizes.

    Null text counts as empty: such a document is ``end`` alone. Repeated rows and equal or
    null ids are packed each. Empty input gives no rows. Very long texts are cut like others.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    schema = _PIECES + (", ids binary" if ids else "")
    encoded = stored(same_names(docs, ("doc_id", "text")).mapInArrow(
        _encode(tokenizer, spaced, end, length, ids), schema
    ).withColumn("row", F.monotonically_increasing_id()), "pieces")
    last = encoded.where(F.col("length") < length).select("row", "length")
    groups = max(1, -(-last.count() // group_pieces))
    placed = last.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")).applyInArrow(
        _fill(length), "row long, sequence_id long, offset long")
    full = F.shiftleft("row", 1)
    return encoded.join(placed.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("sequence_id", full).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), *(["ids"] if ids else []))
