"""Token ids in seekable binary files: independent zstandard frames, a trailing seek table
and a checksum per frame.

A file is a run of zstandard frames and then, in a skippable frame that plain readers pass
over, the seek table of the public "Zstandard Seekable Format": per frame its compressed
and plain sizes and the low 32 bits of the XXH64 of its content. The last data frame is
the document index: 64-bit ids and token counts. Documents lie in the order of the index,
each wholly inside one frame, so one is read by decompressing the index and one frame.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerguard.operators.skew import input_bytes
from ledgerguard.session import scratch

from .common import arrow_batches, partitions, same_names, stored
from .encoding import Encoder
from .tokens import pieces

FRAME_BYTES = 256 << 10   # ids of a frame; a longer document is a frame of its own
FILE_BYTES = 128 << 20    # input of a file, about
UNKNOWN = 1 << 60         # what Spark says of input that it can't size
END = 2
LEVEL = 3

#: Fixed values of the public format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

NO_ID = np.iinfo(np.int64).min  # written for a null id; sorts first, as nulls do


class Writer:
    """Writes one file, frame by frame."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.held: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int] = []
        self.counts: list[int] = []

    def _frame(self, data: bytes) -> None:
        packed = self.zip.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def add(self, id: int | None, data: bytes) -> None:
        if self.held and self.size + len(data) > self.frame_bytes:
            self._flush()
        self.held.append(data)
        self.size += len(data)
        self.ids.append(NO_ID if id is None else id)
        self.counts.append(len(data) // 4)

    def close(self) -> None:
        self._flush()
        self._frame(np.array(self.ids, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes())
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)


class Reader:
    """Reads one file that can seek; checks every frame that it decompresses."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_TABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        file.seek(size - 9 - 12 * n)
        table = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.plain, self.sums = table.T
        self.at = np.concatenate(([0], np.cumsum(self.packed)))
        self.begin = np.concatenate(([0], np.cumsum(self.plain[:-1])))  # of data frames, in plain bytes
        self.unzip = zstandard.ZstdDecompressor()
        index = np.frombuffer(self.frame(n - 1), "<i8").reshape(2, -1)
        self.ids, self.counts = index
        self.ends = np.cumsum(self.counts)
        self.frames_read = 0

    def frame(self, i: int) -> bytes:
        self.file.seek(int(self.at[i]))
        data = self.unzip.decompress(self.file.read(int(self.packed[i])), max_output_size=int(self.plain[i]))
        if len(data) != self.plain[i] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} is damaged")
        return data

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, int, bytes]]:
        """(number in the file, tokens before it, ids) of all documents, or of the wanted
        ids; only the frames that hold them are decompressed."""
        places = np.arange(len(self.ids))
        if wanted is not None:
            places = np.flatnonzero(np.isin(self.ids, np.fromiter(wanted, np.int64)))
        held, data = -1, b""
        for p in places.tolist():
            start = int(self.ends[p] - self.counts[p])
            frame = int(np.searchsorted(self.begin, 4 * start, side="right")) - 1
            if frame != held:
                held, data = frame, self.frame(frame)
                self.frames_read += 1
            low = 4 * start - int(self.begin[frame])
            yield p, start, data[low:low + 4 * int(self.counts[p])]


def _open(uri: str, write: bool = False):
    store, path = pa.fs.FileSystem.from_uri(uri)
    if not write:
        return store.open_input_file(path)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


_MANIFEST = "part long, path string, docs long, tokens long, first_id long, last_id long"


def _write(folder: str, path: str, spaced: bool, end: int, frame_bytes: int):
    tail = end.to_bytes(4, "little")

    def run(batches):
        encoder, writer, out = Encoder.of(path, spaced), None, None
        part = TaskContext.get().partitionId()
        target = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        for batch in pieces(batches):
            if writer is None:
                out = _open(target, write=True)
                writer = Writer(out, frame_bytes)
            for doc, data in zip(batch.column("doc_id").to_pylist(), encoder(batch.column("text").to_pylist())):
                writer.add(doc, data + tail)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "path": pa.array([target], pa.string()),
                "docs": pa.array([len(writer.ids)], pa.int64()), "tokens": pa.array([sum(writer.counts)], pa.int64()),
                "first_id": pa.array([writer.ids[0]], pa.int64()), "last_id": pa.array([writer.ids[-1]], pa.int64())})
    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, spaced: bool = False, end: int = END,
                 frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the ids of all documents in ascending order of id; gives the manifest (part,
    path, docs, tokens, first_id, last_id), one row per file.

    Documents are dealt to files by ranges of id. ``folder`` is a URI that all executors
    reach; by default one under the shared scratch folder. A file's name is unique to the
    attempt that wrote it and only files of committed attempts are in the stored manifest,
    so a task that runs again, or twice at once, does no harm.

    Null text counts as empty: ``end`` alone. Documents with equal ids lie side by side.
    Null ids come first. No rows give no files.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    folder = folder or scratch(spark, "token-files")
    size = input_bytes(docs)
    n = partitions(spark) if size >= UNKNOWN else max(partitions(spark), -(-size // FILE_BYTES))
    bare = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))  # rows without an id are dealt by text
    ranged = same_names(docs, ("doc_id", "text")).repartitionByRange(n, "doc_id", bare).sortWithinPartitions("doc_id")
    return stored(ranged.mapInArrow(_write(folder, tokenizer, spaced, end, frame_bytes), _MANIFEST), "manifest")


_DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, start, n, crc, data = zip(*rows)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([None if i == NO_ID else i for i in ids], pa.int64()), "start": pa.array(start, pa.int64()),
        "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
        **({"ids": pa.array(data, pa.binary())} if data[0] is not None else {})})


def _read(keep: bool):
    def run(batches):
        for batch in batches:
            for path, before, wanted in zip(*(batch.column(c).to_pylist() for c in ("path", "before", "wanted"))):
                with _open(path) as file:
                    reader, out = Reader(file), []
                    for p, start, data in reader.documents(wanted):
                        out.append((int(reader.ids[p]), before + start, len(data) // 4, zlib.crc32(data), data if keep else None))
                        if len(out) == 4096:
                            yield _row_batch(out)
                            out = []
                    if out:
                        yield _row_batch(out)
    return run


def read_tokens(manifest: DataFrame, wanted: DataFrame | None = None, ids: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (and ``ids``, if asked for). With ``wanted``, a frame of
    doc_id, only those, and only their frames are decompressed.

    The running start is summed over the manifest, a row per file."""
    order = Window.orderBy("part")
    files = manifest.withColumn("before", F.sum("tokens").over(order) - F.col("tokens"))
    if wanted is None:
        files = files.select("path", "before", F.lit(None).cast("array<long>").alias("wanted"))
    else:
        edges = [r[0] for r in manifest.orderBy("part").select("last_id").collect()]  # one number per file
        parts = [r[0] for r in manifest.orderBy("part").select("part").collect()]

        def locate(batches):
            for batch in batches:
                id = batch.column("doc_id").drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.searchsorted(np.array(edges, np.int64), id)
                keep = at < len(edges)
                yield pa.RecordBatch.from_pydict({
                    "_part": pa.array(np.array(parts, np.int64)[at[keep]], pa.int64()), "id": pa.array(id[keep], pa.int64())})

        by_file = wanted.select("doc_id").mapInArrow(locate, "_part long, id long").groupBy("_part").agg(
            F.collect_set("id").alias("wanted"))
        files = files.join(by_file, F.col("part") == F.col("_part")).select("path", "before", "wanted")
    spread = files.repartition(partitions(manifest.sparkSession), "path")
    return spread.mapInArrow(_read(ids), _DOCUMENT + (", ids binary" if ids else ""))
