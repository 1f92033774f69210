"""The refresh by changes: a batch of new rows moves what it touches and nothing else.

A new transaction is routed against the parents that are known. It may also change old ones:
another payload under an old idempotency key makes all rows of the key anomalous, another row
of an old id shares its verdict, and a parent that arrives releases the rows that waited for
it. Which old rows these are comes from three small tables beside the rows, all in hash
buckets (``sources/buckets.py``), of which a batch opens those of its own keys:

* ``parents``: the known parent keys, tagged by table;
* ``keys``: idempotency key, home and payload of every transaction;
* ``waiting``: parent keys that a transaction named before they were known, with its home.

The home of a row is its id, as a number where it is one, so that all rows of one id in core
lie together. The wide rows are written once, as they come (``rows``); what changes is the
route of their ids (``routed``), a narrow table in the same buckets. The ids of all touched
homes are decided again by the same operators as in the full refresh, from the columns that
rules read, and their buckets of ``routed`` are replaced. A conflict never ends, so only the
keys of new rows are looked at for one. Wide rows are read again only for homes that enter or
leave core, whose buckets of ``core`` are replaced; which of them is the first of its key comes
from ids and keys. After any sequence of batches the tables equal those of a full refresh over
all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.clean import blank, clean_cast, present
from ..operators import core, routing
from ..operators.anomalies import PAYLOAD, conflict_keys
from ..operators.quarantine import named_parents, numeric_id, orphans_of
from ..operators.skew import input_bytes, lookup_join
from ..schemas import CONFLICT
from ..session import passing, size_shuffles, together
from ..sources.buckets import Buckets

ROUTED = "home string, id string, route string, reasons array<string>, rows bigint"
WIDE_RUNS = 16  # runs of the wide rows that are merged into one
UNPACKED = 8    # size of rows in a shuffle against that of their files


@dataclass(frozen=True)
class Arrivals:
    """New rows of a batch: staged transactions and accounts, and typed rows of parents that
    reached core. Any may be None."""

    transactions: DataFrame | None = None
    accounts: DataFrame | None = None
    core_accounts: DataFrame | None = None
    merchants: DataFrame | None = None
    agencies: DataFrame | None = None


def _home() -> Column:
    return F.coalesce(clean_cast("id", "bigint").cast("string"), F.col("id"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.where(present("idempotency_key"))


def _tagged(kind: str, id: Column) -> Column:
    """A parent key: staged accounts by their text, the others by their number."""
    return F.concat(F.lit(f"{kind}:"), id.cast("string"))


def _tags(named: DataFrame) -> DataFrame:
    """The parent keys that names need: DF[parent, ref, tag]. An account must be staged and in
    core; text that is no number names nothing that could arrive in core."""
    account, number = F.col("parent") == "account", numeric_id("ref")
    tags = F.array(
        F.when(account, _tagged("account", F.col("ref"))),
        F.when(account & number.isNotNull(), _tagged("core_account", number)),
        F.when(~account & number.isNotNull(), F.concat("parent", F.lit(":"), number.cast("string"))))
    return named.select("parent", "ref", F.explode(F.array_compact(tags)).alias("tag"))


def _by_parent(rows: DataFrame, keep, name: str) -> dict[str, DataFrame]:
    """Rows DF[parent, ...] stored apart for accounts and for the others, so that Spark knows
    the size of each."""
    account = F.col("parent") == "account"
    accounts, others = keep(rows.where(account), f"{name}-accounts"), keep(rows.where(~account), name)
    return {"account": accounts, "merchant": others, "agency": others}


class Ledger:
    """The routed ledger under ``root``; ``staged`` is the schema of the staged transactions."""

    def __init__(self, spark: SparkSession, root: str, staged: T.StructType, buckets: int = 64):
        self.spark, root = spark, root.rstrip("/")
        self.columns = staged.names
        text, texts = T.StringType(), T.ArrayType(T.StringType())
        rows = T.StructType([*staged.fields, T.StructField("route", text), T.StructField("reasons", texts)])
        typed = T.StructType([
            T.StructField("own_key", text), *core.core_from_route(spark.createDataFrame([], rows)).schema.fields])
        payload = ", ".join(f"{c} string" for c in PAYLOAD)
        own = T.StructType([T.StructField("home", text), *staged.fields])
        self.position = [c for c in ("source_position",) if c in staged.names]
        self.rows = Buckets(spark, f"{root}/rows", "home", own, buckets, WIDE_RUNS)
        self.routed = Buckets(spark, f"{root}/routed", "home", ROUTED, buckets)
        self.parents = Buckets(spark, f"{root}/parents", "parent", "parent string", buckets)
        self.keys = Buckets(spark, f"{root}/keys", "idempotency_key", f"idempotency_key string, home string, {payload}", buckets)
        self.waiting = Buckets(spark, f"{root}/waiting", "parent", "parent string, home string", buckets)
        self.core = Buckets(spark, f"{root}/core", "own_key", typed, buckets)

    def tables(self) -> tuple[DataFrame, DataFrame]:
        """All routed rows with their route and reasons, and core, as of the last whole batch."""
        done = max(self.core.batches(), default=-1) + 1
        routes = self.routed.read(before=done).select(F.col("id").alias("_routed"), "route", "reasons")
        rows = lookup_join(self.rows.read(before=done).drop("home"), routes, "id", "_routed", "left")
        routed = rows.select(  # a row without an id has no route of its own
            *self.columns, F.coalesce("route", F.lit("CORE")).alias("route"),
            F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"))
        return routed, self.core.read(before=done).drop("own_key")

    def apply(self, new: Arrivals, batch: int) -> DataFrame:
        """Take in a batch; gives the rows of each route among those decided anew, before
        and after: DF[route, rows_before, rows_after]. Batches are numbered from 0 and
        rising; one that failed is applied again under its number."""
        with passing(self.spark) as keep:
            return self._apply(new, batch, keep)

    def _apply(self, new: Arrivals, batch: int, keep) -> DataFrame:
        none = self.spark.createDataFrame([], self.rows.schema)
        tx = none if new.transactions is None else new.transactions.select(_home().alias("home"), *self.columns)
        size_shuffles(self.spark, UNPACKED * (input_bytes(tx) + self.rows.stored_bytes()))
        # The run of the wide rows is all that is stored of them: the other steps read it.
        run, arrived = together(lambda: self.rows.lay(tx, batch), lambda: keep(self._arrived(new), "arrived"))
        tx = self.rows.laid(run)

        def parents() -> DataFrame:
            fresh = keep(arrived.join(self.parents.find(arrived, before=batch), "parent", "left_anti"), "parents")
            self.parents.append(fresh, batch)
            return fresh

        keyed, parents_ = together(lambda: self.keys.append(_keyed(tx), batch), parents)

        # Homes that the batch may move: its own, those of its keys, those that waited.
        shared = keep(self.keys.find(_keyed(tx), before=batch + 1, known=keyed), "shared")
        homes = tx.where(blank("idempotency_key")).select("home").unionByName(shared.select("home")).unionByName(
            self.waiting.find(parents_, before=batch).select("home"))
        homes = keep(homes.where(F.col("home").isNotNull()), "homes")
        buckets = self.routed.of_keys(homes, known=run)
        narrow = ["home", *routing.NEEDED]
        old = self.rows.read(buckets, batch).select(*narrow).join(homes, "home", "left_semi")
        rows = keep(old.unionByName(tx.select(*narrow)), "rows")

        # A conflict never ends, so only keys of new rows can begin one; older ones are in the routes.
        lost, conflicts = together(
            lambda: self._lost(rows, tx, batch, keep), lambda: keep(conflict_keys(shared), "conflicts"))
        clashed = self.routed.read(buckets, batch).where(F.array_contains("reasons", CONFLICT)).select("id")
        decided = routing.decisions(
            rows, None, None, None, None, conflicts=conflicts, lost=lost, every=True, clashed=clashed)
        ids = decided.withColumnRenamed("decided_id", "id").withColumn("home", _home())
        routed = routing.routes(ids, "home", "id", "rows")
        # All ids of a touched home are decided anew, so an id that meets none of these stays.
        before = self.routed.read(buckets, batch).select(*[F.col(c).alias(f"_{c}") for c in self.routed.schema.names])
        both = routed.withColumn("touched", F.lit(True)).join(before, F.col("id") == F.col("_id"), "full")
        both = keep(both.select(
            *[F.when(F.col("touched"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in self.routed.schema.names],
            F.coalesce("touched", F.lit(False)).alias("touched"), F.col("_route").alias("was"), F.col("_rows").alias("rows_before")), "routed")
        routed = both.where("touched")
        together(
            lambda: self.routed.replace(both.where(F.col("home").isNotNull()).select(*self.routed.schema.names), buckets, batch),
            lambda: self.rows.add(run, batch))
        self._core(rows, routed, batch, keep)

        counts = [
            routed.where(F.col("was").isNotNull()).groupBy(F.col("was").alias("route")).agg(F.sum("rows_before").alias("rows_before")),
            routed.groupBy("route").agg(F.sum("rows").alias("rows_after"))]
        both = counts[0].join(counts[1], "route", "full").fillna(0, ["rows_before", "rows_after"])
        return self.spark.createDataFrame(both.collect(), both.schema)  # three rows at most

    def _arrived(self, new: Arrivals) -> DataFrame:
        parts = [df.select(_tagged(kind, F.col("id")).alias("parent")) for kind, df in (
            ("account", new.accounts), ("core_account", new.core_accounts), ("merchant", new.merchants),
            ("agency", new.agencies)) if df is not None]
        out = self.spark.createDataFrame([], self.parents.schema)
        for part in parts:
            out = out.unionByName(part)
        return out.where(F.col("parent").isNotNull()).distinct()

    def _lost(self, rows: DataFrame, tx: DataFrame, batch: int, keep) -> dict[str, DataFrame]:
        """The orphans that some rows name, from the index buckets of what they name. The parent
        keys that these need and that are not known are stored as waited for by the new rows."""
        named = keep(named_parents(rows).distinct(), "named")
        known = keep(self.parents.find(_tags(named), "tag", before=batch + 1), "known")

        def of(kind: str, type: str) -> DataFrame:
            id = F.expr(f"substring(parent, {len(kind) + 2})").cast(type)
            return known.where(F.col("parent").startswith(f"{kind}:")).select(id.alias("id"))

        lost = _by_parent(keep(orphans_of(
            named, of("account", "string"), of("core_account", "bigint"), of("merchant", "bigint"), of("agency", "bigint")),
            "orphans"), keep, "lost")
        self.waiting.append(self._unmet(tx, lost, known), batch)
        return lost

    def _unmet(self, tx: DataFrame, lost: dict[str, DataFrame], known: DataFrame) -> DataFrame:
        """The parent keys that new rows name and that are not known: DF[parent, home]. Only an
        orphan has such keys, so the names of the rows meet those alone."""
        parts = []
        for some in (("account",), ("merchant", "agency")):
            tags = _tags(lost[some[0]]).join(known.withColumnRenamed("parent", "tag"), "tag", "left_anti")
            named = named_parents(tx, "home", parents=some)
            parts.append(named.join(tags, ["parent", "ref"]).select(F.col("tag").alias("parent"), "home"))
        return parts[0].unionByName(parts[1])

    def _core(self, rows: DataFrame, routed: DataFrame, batch: int, keep) -> None:
        """Core holds the first row of an id and the first id of a key. Homes with rows that
        enter or leave core move it, and all homes that share a key with those compete; only
        touched keys are replaced. ``rows`` are all rows of the homes in ``routed``."""
        now, was = F.col("route") == "CORE", F.coalesce(F.col("was") == "CORE", F.lit(False))
        moved = routed.where(F.col("home").isNotNull() & ((now != was) | (now & (F.col("rows") != F.col("rows_before")))))
        moved = keep(moved.select("home"), "moved")
        touched = keep(rows.select("home", "id", "idempotency_key").join(moved, "home", "left_semi"), "touched")
        keys = keep(touched.withColumn("id", clean_cast("id", "bigint")).select(
            core.own_key().alias("own_key")).where(F.col("own_key").isNotNull()).distinct(), "own-keys")
        homes = keep(self.keys.find(_keyed(touched), before=batch + 1).select("home").unionByName(moved).where(
            F.col("home").isNotNull()), "core-homes")
        near = self.rows.of_keys(homes)  # of the routes as well, which lie in the same buckets
        ids = keep(self.routed.read(near, batch + 1).where("route = 'CORE'").select("home", "id", "rows").join(
            homes, "home", "left_semi"), "core-ids")
        unique = ids.groupBy("home").agg(F.sum("rows").alias("n")).where("n > 1").isEmpty()
        wide = self.rows.read(near, batch + 1).drop("home")
        if unique:  # the first of a key is found from the keys alone, and only its row is read as a whole
            named = wide.select("id", "idempotency_key", *self.position).join(ids.select("id"), "id", "left_semi")
            first = keep(core.first_of_keys(named).join(keys, "own_key", "left_semi").select("id"), "core-first")
            fresh = core.core_transactions(wide.join(first, "id", "left_semi"), unique_ids=True, drop_repeats=False)
        else:
            fresh = core.core_transactions(wide.join(ids.select("id"), "id", "left_semi"))
        fresh = fresh.withColumn("own_key", core.own_key())
        if not unique:
            fresh = fresh.join(keys, "own_key", "left_semi")
        buckets = self.core.of_keys(keys)
        old = self.core.read(buckets, batch)
        gone = keep(old.select("own_key").join(keys, "own_key", "left_semi"), "gone")
        stay = old.join(gone, "own_key", "left_anti")
        self.core.replace(stay.unionByName(fresh.select(*self.core.schema.names)), buckets, batch)
