"""Sinks: versioned layer tables, the partitioned fact, report tables, issue rows."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import kept_at


class LayerStore:
    """Tables as ``root/layer/table/v=<n>`` Parquet folders on any Hadoop file system.

    What readers see is one manifest, ``root/_runs/<n>.json``: the version of every table.
    A run writes new versions beside the old ones and its manifest last, in one rename, so
    readers move to all of its tables at once and a failed run changes nothing for them.
    No commit marker of a single folder is needed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._pending: dict[str, int] | None = None
        self._lock = threading.Lock()

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._path(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    # -- manifests ----------------------------------------------------------------------

    def runs(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_runs") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, run: int | None = None) -> dict[str, int]:
        """Table to version of a run, by default the newest."""
        runs = self.runs()
        if not runs:
            return {}
        fs, path = self._path("_runs", f"{runs[-1] if run is None else run}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, changed: dict[str, int]) -> None:
        run = max(self.runs(), default=0) + 1
        fs, draft = self._path("_runs", f"{run}.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({**self.manifest(), **changed}, sort_keys=True).encode()))
        out.close()
        if not fs.rename(draft, self._path("_runs", f"{run}.json")[1]):
            raise RuntimeError(f"another run committed as {run}")

    @contextmanager
    def run(self):
        """Tables replaced inside become visible to others together, at the end; if the
        block raises, they never do."""
        self._pending = {}
        try:
            yield self
            self._commit(self._pending)
        finally:
            self._pending = None

    # -- tables -------------------------------------------------------------------------

    def versions(self, layer: str, table: str) -> list[int]:
        """All versions that were begun, committed or not."""
        return sorted(int(n[2:]) for n in self._names(layer, table) if n.startswith("v="))

    def path(self, layer: str, table: str, version: int) -> str:
        return f"{self.root}/{layer}/{table}/v={version}"

    def has(self, layer: str, table: str) -> bool:
        return f"{layer}.{table}" in {**self.manifest(), **(self._pending or {})}

    def read(self, layer: str, table: str) -> DataFrame:
        """The committed table; inside a run, what the run has written."""
        name = f"{layer}.{table}"
        version = (self._pending or {}).get(name) or self.manifest().get(name)
        if version is None:
            raise FileNotFoundError(f"{name} has no committed version")
        return self.spark.read.parquet(self.path(layer, table, version))

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Full refresh: write the next version, then read it back (which cuts lineage).
        Outside a run it is committed by itself."""
        version = max(self.versions(layer, table), default=0) + 1
        target = self.path(layer, table, version)
        stored = kept_at(df, target, partition_by)
        with self._lock:
            if self._pending is None:
                self._commit({f"{layer}.{table}": version})
            else:
                self._pending[f"{layer}.{table}"] = version
        return stored

    def drop_old(self, keep: int = 2) -> None:
        """Delete versions that none of the ``keep`` newest runs names, and older manifests.
        For use between runs."""
        runs = self.runs()
        kept: dict[str, set[int]] = {}
        for run in runs[-keep:]:
            for name, version in self.manifest(run).items():
                kept.setdefault(name, set()).add(version)
        for name in {n for run in runs for n in self.manifest(run)}:
            layer, table = name.split(".", 1)
            for version in self.versions(layer, table):
                if version not in kept.get(name, set()):
                    fs, path = self._path(layer, table, f"v={version}")
                    fs.delete(path, True)
        for run in runs[:-keep]:
            fs, path = self._path("_runs", f"{run}.json")
            fs.delete(path, False)


QUARTER = "tx_quarter"


def quarter_of(day: Column) -> Column:
    """``2024q1``; sorts as the quarters do."""
    return F.concat(F.year(day).cast("string"), F.lit("q"), F.quarter(day).cast("string"))


def by_quarter(df: DataFrame, date_col: str) -> DataFrame:
    """Add the partition column and lay the rows out by it.

    The rebalance hint gathers a quarter into few files and, through AQE, splits a
    quarter that is far larger than the rest.
    """
    return df.withColumn(QUARTER, quarter_of(F.col(date_col))).hint("rebalance", QUARTER)


def write_fact(df: DataFrame, path: str, date_col: str, mode: str = "overwrite") -> None:
    """Write a fact partitioned by quarter."""
    by_quarter(df, date_col).write.mode(mode).partitionBy(QUARTER).parquet(path)


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist a report; the report is the frame itself."""
    report.write.mode("overwrite").format(fmt).save(path)


def raw_payload(df: DataFrame) -> Column:
    """The whole row as JSON, NULL fields included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def issue_rows(
    df: DataFrame, code: Column | str, details: Column | str, kind: str = "anomaly"
) -> DataFrame:
    """Rows of an issue table: identity, code, details, full source row.

    ``kind`` names the code columns: ``anomaly`` or ``reject``.
    """
    names = {
        "anomaly": ("anomaly_type", "anomaly_details"),
        "reject": ("reject_reason", "reject_details"),
    }[kind]
    code = F.lit(code) if isinstance(code, str) else code
    details = F.lit(details) if isinstance(details, str) else details
    source = [c for c in df.columns if not c.startswith("_") and c != "source_position"]
    return df.select(
        F.col("id").alias("staging_transaction_id"),
        F.col("reference").alias("transaction_reference"),
        "idempotency_key",
        code.alias(names[0]),
        details.alias(names[1]),
        raw_payload(df.select(*source)).alias("raw_payload"),
        F.current_timestamp().alias("created_at"),
    )


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones with the same key; the others stay."""
    return new.unionByName(old.join(new, key, "left_anti"))
