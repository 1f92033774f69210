"""Three-way routing with strict priority: ANOMALY over QUARANTINE over CORE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..schemas import ANOMALIES, CONFLICT, QUARANTINE
from .anomalies import anomaly_tests, conflict_keys
from .quarantine import STAGED_REASONS, blank_holds, known_accounts, known_ids, orphan_hits, with_holds
from .skew import flag, lookup_join

NEEDED = (
    "id", "idempotency_key", "transaction_type", "amount", "status", "source_account_id",
    "destination_account_id", "merchant_id", "agency_id", "balance_before", "balance_after",
)
ANOMALY_CODES = (*ANOMALIES, CONFLICT)
QUARANTINE_CODES = tuple(QUARANTINE)


ALL_CODES = (*ANOMALY_CODES, *QUARANTINE_CODES)


def _bit(code: str) -> int:
    return 1 << ALL_CODES.index(code)


def _has(codes) -> Column:
    """Does the bit set of a transaction hold one of the codes?"""
    return F.col("bits").bitwiseAND(sum(_bit(c) for c in codes)) != 0


def _codes(codes) -> Column:
    return F.array_compact(F.array(*[F.when(_has([c]), F.lit(c)) for c in codes]))


def decisions(
    tx: DataFrame, accounts: DataFrame, core_accounts: DataFrame, merchants: DataFrame,
    agencies: DataFrame, text_compare: bool = False, conflicts: DataFrame | None = None, lost: DataFrame | None = None,
    every: bool = False, clashed: DataFrame | None = None,
) -> DataFrame:
    """Transactions that do not reach core: DF[decided_id, anomalies, quarantine]. With ``every``
    also those that do, and rows without an id as one, with their number: DF[..., rows].
    ``clashed`` are ids that are known to have a conflicting key: DF[id].

    Works on the eleven columns that rules read. Row flags come from row predicates, the
    conflicting keys and one lookup per parent. They travel as one small bit set and
    collapse per id, because an id that is anomalous in one row is so in all of them.
    ``conflicts`` are the conflicting keys and ``lost`` the orphans, if they are known; ids and
    references then meet those few instead of all parents, and the rows themselves stay where
    they are.
    """
    narrow = tx.select(*NEEDED)
    conflicts = conflict_keys(narrow) if conflicts is None else conflicts
    tests = {code: flag(test) for code, test in anomaly_tests(text_compare).items()}
    if lost is None:
        flagged = lookup_join(narrow, conflicts, "idempotency_key", "conflict_key", "left")
        flagged = with_holds(
            flagged, known_accounts(accounts, core_accounts), known_ids(merchants), known_ids(agencies))
        tests[CONFLICT] = F.col("conflict_key").isNotNull()
        tests |= {code: F.col(code) for code in QUARANTINE_CODES}
    else:
        flagged = narrow
        tests |= {code: flag(test) for code, test in blank_holds().items()}
    bits = sum((F.when(t, _bit(c)).otherwise(0) for c, t in tests.items()), F.lit(0))
    rows = flagged.select("id", bits.alias("bits"), F.lit(1).cast("bigint").alias("rows"))
    if not every:
        rows = rows.where(F.col("id").isNotNull()).where("bits <> 0")
    if lost is not None:
        named = narrow.where(F.col("id").isNotNull())
        clash = lookup_join(named.select("id", "idempotency_key"), conflicts, "idempotency_key", "conflict_key", "left_semi")
        of_code = F.coalesce(*[F.when(F.col("code") == c, _bit(c)) for c in STAGED_REASONS], F.lit(0))
        hits = orphan_hits(named, lost).select(
            "id", (of_code + F.when(F.col("core"), _bit("missing_core_reference")).otherwise(0)).alias("bits"))
        more = clash.select("id", F.lit(_bit(CONFLICT)).alias("bits")).unionByName(hits).where("bits <> 0")
        if clashed is not None:
            more = more.unionByName(clashed.select("id", F.lit(_bit(CONFLICT)).alias("bits")))
        rows = rows.unionByName(more.withColumn("rows", F.lit(0).cast("bigint")))
    by_id = rows.groupBy("id").agg(
        F.bit_or(F.when(F.col("id").isNotNull(), F.col("bits")).otherwise(0)).alias("bits"), F.sum("rows").alias("rows"))
    if clashed is not None:
        by_id = by_id.where("rows > 0")
    return by_id.select(
        F.col("id").alias("decided_id"),
        _codes(ANOMALY_CODES).alias("anomalies"),
        F.when(_has(ANOMALY_CODES), F.array().cast("array<string>"))
        .when(_has(STAGED_REASONS), _codes(STAGED_REASONS))
        .otherwise(_codes(QUARANTINE_CODES)).alias("quarantine"),
        *(["rows"] if every else []),
    )


def route(
    tx: DataFrame, accounts: DataFrame, core_accounts: DataFrame, merchants: DataFrame,
    agencies: DataFrame, text_compare: bool = False, decided: DataFrame | None = None,
) -> DataFrame:
    """Every staged row with its one route and all its reasons.

    The decisions hold only ids outside core, so the join back is small whenever most
    rows are good; AQE then broadcasts it instead of shuffling the wide rows.
    """
    if decided is None:
        decided = decisions(tx, accounts, core_accounts, merchants, agencies, text_compare)
    return routes(lookup_join(tx, decided, "id", "decided_id", "left"), *tx.columns)


def routes(joined: DataFrame, *columns: str) -> DataFrame:
    """Route and reasons of rows that have met their decision, or have none."""
    none = F.array().cast("array<string>")
    anomalies = F.coalesce(F.col("anomalies"), none)
    held = F.coalesce(F.col("quarantine"), none)
    return joined.select(
        *columns,
        F.when(F.size(anomalies) > 0, "ANOMALY")
        .when(F.size(held) > 0, "QUARANTINE")
        .otherwise("CORE").alias("route"),
        F.concat(anomalies, held).alias("reasons"),
    )


def routing_summary(routed: DataFrame, route: str = "route") -> DataFrame:
    """Rows and share per route. The window runs over the three grouped rows."""
    counts = routed.groupBy(F.col(route).alias("layer")).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "layer", "rows",
        F.round(F.col("rows").cast("double") * 100 / total.cast("double"), 2).alias("pct"))
