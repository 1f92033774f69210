"""The full refresh: raw files to staging, then anomalies, quarantine, core and reports.

Every step stores its table and the next ones read it back, so a lost executor costs a
read and no plan grows long. The tables of a run are committed together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anomalies, core, quarantine, routing
from ..operators.constraints import constraint_report, raise_violations
from ..operators.skew import input_bytes
from ..operators.validation import layer_shares, table_summary
from ..schemas import LOOKUP_ROWS, STAGING
from ..session import size_shuffles, together
from ..sources.csv import malformed_rows, read_raw
from ..sources.layers import QUARTER, LayerStore, by_quarter

LOOKUPS = ("wilayas", "tx_types", "categories")


def stage(spark: SparkSession, store: LayerStore, paths: Mapping[str, str], multi_line: bool = False,
          strict: bool = False) -> None:
    """Load the raw files: ``paths`` maps staging table names to CSV paths. Rows with a cell
    too many or too few go to ``staging.malformed_rows`` as they stand; ``strict`` stops."""
    with store.run():
        faults = None
        for table, path in paths.items():
            rows = read_raw(spark, path, table, position=table not in LOOKUPS, multi_line=multi_line, strict=strict)
            store.replace(rows, "staging", table)
            part = malformed_rows(spark, path, table, multi_line).withColumn("table", F.lit(table))
            faults = part if faults is None else faults.unionByName(part)
        if faults is not None:
            store.replace(faults, "staging", "malformed_rows")


def refresh(
    spark: SparkSession, store: LayerStore, lookup_rows: Mapping[str, int] | None = LOOKUP_ROWS,
    text_compare: bool = False, strict: bool = False, drop_repeats: bool = True,
) -> DataFrame:
    """Rebuild every layer behind staging; gives the row counts of all tables.

    The transactions are read four times: for the conflicting keys, for the references that
    resolve nowhere, for the narrow decision of every id, which meets only those two, and for
    the wide rows, which are stored with their route. The
    issue tables and core are written from that table, each from its own part. All tables
    become visible together when the run ends; a failed run changes nothing.

    ``lookup_rows`` are the sizes that the lookups must have, or None. ``strict`` lets a
    malformed cell or a violated constraint stop the run.
    """
    staged = {t: store.read("staging", t) for t in STAGING}
    size_shuffles(spark, sum(input_bytes(df) for df in staged.values()))
    with store.run():
        return _refresh(spark, store, staged, lookup_rows, text_compare, strict, drop_repeats)


def _refresh(spark, store, staged, lookup_rows, text_compare, strict, drop_repeats) -> DataFrame:
    tx = staged["transactions"]

    def load(table):
        return store.replace(core.load_lookup(staged[table], table), "reference", table)

    def holders():
        users = store.replace(core.core_users(staged["users"], strict), "core", "users")
        return users, store.replace(core.core_accounts(staged["accounts"], users, strict), "core", "accounts")

    *loaded, (users, accounts), merchants, agencies, conflicting = together(
        *[lambda t=t: load(t) for t in LOOKUPS],
        holders,
        lambda: store.replace(core.core_merchants(staged["merchants"], strict), "core", "merchants"),
        lambda: store.replace(core.core_agencies(staged["agencies"], strict), "core", "agencies"),
        lambda: store.replace(anomalies.conflict_keys(tx), "routing", "conflict_keys"))
    lookups = dict(zip(LOOKUPS, loaded))
    for table in LOOKUPS if lookup_rows else ():
        core.assert_count(lookups[table], lookup_rows[table], f"reference.{table}")

    dims = (staged["accounts"], accounts, merchants, agencies)
    lost = store.replace(quarantine.orphans(tx, *dims), "routing", "orphans")
    decided = store.replace(
        routing.decisions(tx, *dims, text_compare, conflicting, lost), "routing", "decisions")
    routed = store.replace(
        routing.route(tx, *dims, text_compare, decided), "routing", "transactions", partition_by=["route"])
    part = {r: routed.where(F.col("route") == r).drop("route") for r in ("ANOMALY", "QUARANTINE", "CORE")}
    # Rows without an id have no route of their own; rules look at them all the same.
    suspects = routed.where((F.col("route") == "ANOMALY") | F.col("id").isNull()).drop("route", "reasons")
    rows = core.core_from_route(
        routed, strict=strict, drop_repeats=drop_repeats, unique_ids=not core.has_repeats(part["CORE"]))
    everything = core.core_from_route(routed, strict=strict, drop_repeats=False)

    def catalogue():
        old = store.read("quarantine", "quarantine_reasons") if store.has("quarantine", "quarantine_reasons") else None
        return store.replace(quarantine.reason_catalogue(spark, old), "quarantine", "quarantine_reasons")

    flagged, conflicts, held, reasons, transactions, _ = together(
        lambda: store.replace(
            anomalies.transaction_anomalies(suspects, text_compare=text_compare), "anomalies", "transaction_anomalies"),
        lambda: store.replace(
            anomalies.idempotency_conflicts(suspects, conflicting), "anomalies", "idempotency_conflicts"),
        lambda: store.replace(
            quarantine.quarantine_of(part["QUARANTINE"], lost), "quarantine", "quarantine_transactions"),
        catalogue,
        lambda: store.replace(
            by_quarter(rows, "transaction_date"), "core", "transactions", partition_by=[QUARTER]),
        lambda: store.replace(core.repeated_transactions(everything), "reports", "repeated_transactions"))

    tables = {"users": users, "accounts": accounts, "merchants": merchants, "agencies": agencies,
              "transactions": transactions}
    report = store.replace(
        constraint_report(tables, lookups, {t: staged[t] for t in tables}), "reports", "constraints")
    if strict:
        raise_violations(report)

    counted = {
        **{f"staging.{t}": df for t, df in staged.items()},
        **{f"reference.{t}": df for t, df in lookups.items()},
        **{f"core.{t}": df for t, df in tables.items()},
        "anomalies.transaction_anomalies": flagged,
        "anomalies.idempotency_conflicts": conflicts,
        "quarantine.quarantine_transactions": held,
        "quarantine.quarantine_reasons": reasons,
    }
    return table_summary(counted, {
        "quarantine.quarantine_reasons": "> 0 expected",
        **{f"reference.{t}": f"= {n} expected" for t, n in (lookup_rows or {}).items()},
    })


def shares(store: LayerStore) -> DataFrame:
    """Rows of each layer and their share of the staged transactions."""
    return layer_shares({
        "Raw staging": store.read("staging", "transactions"),
        "Idempotency conflicts": store.read("anomalies", "idempotency_conflicts"),
        "Transaction anomalies": store.read("anomalies", "transaction_anomalies"),
        "Quarantine": store.read("quarantine", "quarantine_transactions"),
        "CORE (trusted)": store.read("core", "transactions"),
    }, "Raw staging")
