"""Documents in blocks: rows that hold a few MB of whole documents, compressed.

Operators that look up every word or window of a corpus work block by block: each block
sends its sorted distinct 64-bit hashes to hash ranges ("buckets"), a bucket answers with
one value per hash sent, and the block reads the answers against the hashes that it makes
again. So what moves is a few bytes per distinct hash and block, no table of all hashes
is ever collected or broadcast, and a hot word or passage is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, partitions, stored

BLOCK_BYTES = 4 << 20       # text of a block; a longer document is a block of its own
BUCKET_HASHES = 2_000_000   # hashes that a bucket should hold; bounds its memory
SCHEMA = "block long, docs long, bytes long, words long, data binary"


def encode(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def decode(data: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(data).read_all().combine_chunks()
    batches = table.to_batches()
    return batches[0] if batches else pa.RecordBatch.from_pylist([], table.schema)


def cut(batches: Iterable[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text, or of one longer document."""
    held, size = [], 0

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        return table.to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(lengths[at:])
            n = int(np.searchsorted(ends, most - size, side="right"))
            if n == 0 and held:
                yield flush()
                held, size = [], 0
                continue
            n = max(n, 1)
            held.append(batch.slice(at, n))
            size += int(ends[n - 1])
            at += n
            if size >= most:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def blocks(docs: DataFrame, text: str = "text", most: int = BLOCK_BYTES) -> DataFrame:
    """Store ``docs`` as blocks (block, docs, bytes, words, data). The numbering of blocks
    is fixed by the stored table, so later reads agree on it. ``words`` is an upper bound:
    every word but the last is followed by a separator."""
    arrow_batches(docs.sparkSession)

    def pack(batches):
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(cut(batches, text, most)):
            size = int(pc.sum(pc.binary_length(batch.column(text))).as_py() or 0)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 33) + seq], pa.int64()), "docs": pa.array([batch.num_rows], pa.int64()),
                "bytes": pa.array([size], pa.int64()), "words": pa.array([size // 2 + batch.num_rows], pa.int64()),
                "data": pa.array([encode(batch)], pa.binary())})

    return stored(docs.mapInArrow(pack, SCHEMA), "blocks")


def bucket_count(packed: DataFrame, hashes_per_byte: float = 0.2, least: int = 1) -> int:
    """A power of two of buckets, so that each holds about BUCKET_HASHES hashes."""
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    want = max(size * hashes_per_byte / BUCKET_HASHES, least, min(partitions(packed.sparkSession), 1 << 16))
    return 1 << max(0, int(np.ceil(np.log2(max(want, 1)))))


def bucket_bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins and ends in sorted hashes: buckets are ranges of the top bits."""
    if buckets == 1:
        return np.array([0, len(hashes)])
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    edges = np.arange(1, buckets, dtype=np.uint64) << shift
    return np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, so that bytes which are all alike cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T)
    return b"".join(
        bytes([0]) + planes[i, :1].tobytes() if len(values) and (planes[i] == planes[i, 0]).all()
        else bytes([1]) + planes[i].tobytes()
        for i in range(8))


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    planes, at = np.empty((8, n), dtype=np.uint8), 0
    for i in range(8):
        kind, at = data[at], at + 1
        if kind:
            planes[i] = np.frombuffer(data, np.uint8, n, at)
            at += n
        elif n:
            planes[i] = data[at]
            at += 1
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def squeeze_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return squeeze(np.diff(hashes, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unsqueeze(data, n), dtype=np.uint64)


def answers_by_block(packed: DataFrame, replies: DataFrame) -> DataFrame:
    """Each block with its replies, an array of (bucket, reply); as many entries as buckets
    at most, and about as large as the block's distinct hashes."""
    told = replies.groupBy(F.col("block").alias("_block")).agg(
        F.collect_list(F.struct("bucket", "reply")).alias("replies"))
    return packed.join(told, F.col("block") == F.col("_block"), "left").drop("_block")


def long_ids(column: pa.Array) -> np.ndarray:
    """Ids as int64; a null id counts as the largest number."""
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def rows(batches: Iterable[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    """The rows of batches, one at a time, as Python values of some columns."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)
