"""Tables in hash buckets, for work that touches few keys of a long history.

A row lies in the bucket of its key's hash. A batch reads and writes only the buckets of the
keys that it holds, whatever else the table has gathered: by ``replace`` a bucket is written
anew as a whole, by ``append`` it gets another sorted run, and runs of one level are merged
into one of the next, so a bucket has few files after any number of batches.

What readers see is one manifest per batch, ``_manifests/<batch>.json``, which names the runs
of every bucket and is written last. A batch starts from the manifest before it, so a batch
that runs again after a failure repeats itself exactly.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKET = "bucket__"
FANOUT = 4           # runs of one level that are merged into one of the next, by default
KEPT = 3             # manifests that stay, for readers and for batches that run again


class Buckets:
    """A table under ``root`` with so many buckets by the hash of ``key``. Choose ``count`` so
    that a bucket of the grown table is some hundred MB; it can't change later. ``fanout``
    runs of a level become one of the next: more of them for wide rows, which cost more to
    write again than another file costs to open."""

    def __init__(
        self, spark: SparkSession, root: str, key: str, schema: T.StructType | str, count: int = 64, fanout: int = FANOUT,
    ):
        self.fanout = fanout
        self.spark, self.root, self.key, self.count = spark, root.rstrip("/"), key, count
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    # -- files ----------------------------------------------------------------------------

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._path(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def stored_bytes(self) -> int:
        """Size of all files, old runs that are still there included."""
        fs, path = self._path("runs")
        return fs.getContentSummary(path).getLength() if fs.exists(path) else 0

    # -- manifests ------------------------------------------------------------------------

    def batches(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_manifests") if n.endswith(".json"))

    def manifest(self, before: int | None = None) -> dict[int, list[list]]:
        """Bucket to its runs [level, folder], as of the newest batch, or of the last one
        before a batch."""
        known = [b for b in self.batches() if before is None or b < before]
        if not known:
            return {}
        fs, path = self._path("_manifests", f"{known[-1]}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(b): runs for b, runs in json.loads(text).items()}

    def _commit(self, batch: int, manifest: Mapping[int, list]) -> None:
        fs, draft = self._path("_manifests", f"{batch}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        _, path = self._path("_manifests", f"{batch}.json")
        if fs.exists(path):
            fs.delete(path, False)
        if not fs.rename(draft, path):
            raise RuntimeError(f"batch {batch} was not committed")
        self._drop_old()

    def _drop_old(self) -> None:
        """Manifests but the newest few go, with the runs that none of those names."""
        batches = self.batches()
        if len(batches) <= KEPT:
            return
        named = {folder for b in batches[-KEPT:] for runs in self.manifest(b + 1).values() for _, folder in runs}
        for name in self._names("runs"):
            if int(name.split("-")[0]) <= batches[-1]:
                for part in self._names("runs", name):
                    if part.startswith(BUCKET) and f"{name}/{part}" not in named:
                        fs, path = self._path("runs", name, part)
                        fs.delete(path, True)
                if not any(n.startswith(BUCKET) for n in self._names("runs", name)):
                    fs, path = self._path("runs", name)
                    fs.delete(path, True)
        for b in batches[:-KEPT]:
            fs, path = self._path("_manifests", f"{b}.json")
            fs.delete(path, False)

    # -- rows -----------------------------------------------------------------------------

    def bucket(self, key: Column | str) -> Column:
        key = F.col(key) if isinstance(key, str) else key
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.count)).cast("int")

    def of_keys(self, rows: DataFrame, key: str | None = None, known: Iterable[int] = ()) -> list[int]:
        """The buckets that the keys of these rows lie in: at most ``count`` numbers. ``known``
        are some that are certain to be among them; if these are all, no job looks."""
        if len(found := sorted(set(known))) == self.count:
            return found
        return sorted(r[0] for r in rows.select(self.bucket(key or self.key)).distinct().collect())

    def read(self, buckets: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """The rows of some buckets, or all; only their files are opened."""
        manifest = self.manifest(before)
        folders = [f"{self.root}/runs/{folder}" for b in (sorted(manifest) if buckets is None else buckets)
                   for _, folder in manifest.get(b, [])]
        return self._stored(folders)

    def _stored(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def find(
        self, keys: DataFrame, column: str | None = None, before: int | None = None, known: Iterable[int] = (),
    ) -> DataFrame:
        """The rows whose key is among the keys of a frame; ``known`` as in ``of_keys``."""
        if not self.manifest(before):
            return self._stored([])
        wanted = keys.select(F.col(column or self.key).alias("_wanted")).where(F.col("_wanted").isNotNull())
        rows = self.read(self.of_keys(wanted, "_wanted", known), before)
        return rows.join(wanted.distinct(), F.col(self.key) == F.col("_wanted"), "left_semi")

    def _write(self, rows: DataFrame, name: str) -> dict[int, str]:
        """Store rows as the run ``name``; the folder of each bucket that has any."""
        laid = rows.select(*self.schema.names).withColumn(BUCKET, self.bucket(self.key))
        laid.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key).write.mode("overwrite").partitionBy(
            BUCKET).parquet(f"{self.root}/runs/{name}")
        return {int(n.split("=")[1]): f"{name}/{n}" for n in self._names("runs", name) if n.startswith(f"{BUCKET}=")}

    def lay(self, rows: DataFrame, batch: int) -> dict[int, str]:
        """Store rows as a run that nobody sees before ``add``: the folder of each bucket."""
        return self._write(rows, f"{batch}-0")

    def laid(self, run: Mapping[int, str]) -> DataFrame:
        """The rows of such a run, to read before it is added."""
        return self._stored([f"{self.root}/runs/{folder}" for folder in run.values()])

    def append(self, rows: DataFrame, batch: int) -> list[int]:
        """Add rows; gives the buckets that got any."""
        run = self.lay(rows, batch)
        self.add(run, batch)
        return sorted(run)

    def add(self, run: Mapping[int, str], batch: int) -> None:
        """Take in a run. Where a bucket has ``fanout`` runs of a level, they become one of the next,
        so a row is rewritten once a level and a bucket has fewer than ``fanout`` runs of each."""
        manifest = self.manifest(batch)
        for b, folder in run.items():
            manifest[b] = [*manifest.get(b, []), [0, folder]]
        level = 0
        while full := [b for b, runs in manifest.items() if sum(at == level for at, _ in runs) >= self.fanout]:
            folders = [f"{self.root}/runs/{folder}" for b in full for at, folder in manifest[b] if at == level]
            merged = self._write(self.spark.read.schema(self.schema).parquet(*folders), f"{batch}-{level + 1}")
            for b in full:
                manifest[b] = [[level + 1, merged[b]], *[r for r in manifest[b] if r[0] != level]]
            level += 1
        self._commit(batch, manifest)

    def replace(self, rows: DataFrame, buckets: Sequence[int], batch: int) -> None:
        """These rows are all there is in these buckets from now on."""
        manifest = {b: runs for b, runs in self.manifest(batch).items() if b not in set(buckets)}
        for b, folder in self._write(rows, f"{batch}-0").items():
            manifest[b] = [[0, folder]]
        self._commit(batch, manifest)

    def upsert(self, rows: DataFrame, batch: int) -> None:
        """Rows take the place of all rows with their keys. Keys must not be null."""
        buckets = self.of_keys(rows)
        new = rows.select(F.col(self.key).alias("_new")).distinct()
        kept = self.read(buckets, batch).join(new, F.col(self.key) == F.col("_new"), "left_anti")
        self.replace(kept.unionByName(rows.select(*self.schema.names)), buckets, batch)
