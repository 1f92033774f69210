"""Broken invariants and conflicting idempotency keys in staged transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import conflict_group_id, present
from ..schemas import ANOMALIES
from ..sources.layers import issue_rows, raw_payload
from .skew import explode_hits, flag, lookup_join

PAYLOAD = ("amount", "status", "source_account_id", "destination_account_id")


def _number(column: str) -> Column:
    """Wide enough that no amount overflows; malformed text is NULL and breaks no rule."""
    return F.trim(F.col(column)).try_cast("decimal(38,6)")


def _at_most(column: str, strictly: bool) -> Column:
    """Not above zero, or below it. The sign comes from a cheap double; only rows that
    look broken pay for the exact reading, which also refuses what is not a number."""
    sign = F.trim(F.col(column)).try_cast("double")
    return (sign < 0 if strictly else sign <= 0) & _number(column).isNotNull()


def anomaly_tests(text_compare: bool = False) -> dict[str, Column]:
    """The row rules by code. Balances compare as numbers, or as text on request, where
    ``5`` and ``5.00`` differ. Equal text is an equal number, so the exact comparison
    runs only where failed rows show different text."""
    moved = F.col("balance_after") != F.col("balance_before")
    if not text_compare:
        moved = moved & (_number("balance_after") != _number("balance_before"))
    return {
        "invalid_failed_balance": (F.col("status") == "FAILED") & moved,
        "invalid_amount": _at_most("amount", strictly=False),
        "negative_balance": _at_most("balance_after", strictly=True),
    }


def transaction_anomalies(
    tx: DataFrame, codes=tuple(ANOMALIES), text_compare: bool = False
) -> DataFrame:
    """One issue row per (transaction, broken rule), all rules in one scan."""
    tests = anomaly_tests(text_compare)
    hits = explode_hits(tx, [(c, tests[c]) for c in codes], "_code")
    details = F.element_at(F.create_map(*[F.lit(x) for kv in ANOMALIES.items() for x in kv]), F.col("_code"))
    return issue_rows(hits, F.col("_code"), details)


def invalid_failed_balance(tx: DataFrame, text_compare: bool = False) -> DataFrame:
    return transaction_anomalies(tx, ("invalid_failed_balance",), text_compare)


def invalid_amount(tx: DataFrame) -> DataFrame:
    return transaction_anomalies(tx, ("invalid_amount",))


def negative_balance(tx: DataFrame) -> DataFrame:
    return transaction_anomalies(tx, ("negative_balance",))


# -- idempotency conflicts ----------------------------------------------------------------

def conflict_keys(tx: DataFrame, key: str = "idempotency_key", payload=PAYLOAD) -> DataFrame:
    """Keys whose rows disagree in a payload column; NULL is not a value, '' is.

    Two distinct values exist exactly when the least differs from the greatest, so one
    pre-aggregated group-by decides it, without the row copies of several distinct counts.
    """
    spans = [(F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")) for i, c in enumerate(payload)]
    differ = F.lit(False)
    for i in range(len(payload)):
        differ = differ | flag(F.col(f"_lo{i}") != F.col(f"_hi{i}"))
    return (
        tx.where(present(F.col(key).cast("string")))
        .groupBy(F.col(key).alias("conflict_key"))
        .agg(*[a for span in spans for a in span])
        .where(differ)
        .select("conflict_key")
    )


def conflict_rows(
    tx: DataFrame, key: str = "idempotency_key", payload=PAYLOAD, keys: DataFrame | None = None
) -> DataFrame:
    """Every source row of every conflicting key, not only the later ones. ``keys`` are the
    conflicting ones, if they are known."""
    keys = conflict_keys(tx, key, payload) if keys is None else keys
    return lookup_join(tx, keys, key, "conflict_key", "left_semi")


def conflict_groups(tx: DataFrame, key: str = "idempotency_key", payload=PAYLOAD) -> DataFrame:
    """Per conflicting key: its rows and the distinct values of each payload column.

    Only rows of conflicting keys reach the distinct counts. Those rows first collapse to
    one per payload variant, so the counts work on variants.
    """
    variants = conflict_rows(tx.select(key, *payload), key, payload).groupBy(key, *payload).agg(
        F.count(F.lit(1)).alias("n"))
    return variants.groupBy(key).agg(
        F.sum("n").alias("duplicate_count"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in payload],
    )


def idempotency_conflicts(tx: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Issue rows of all members of conflicting groups, with the group id."""
    rows = conflict_rows(tx, keys=keys)
    return rows.select(
        conflict_group_id("idempotency_key").alias("conflict_group_id"),
        "idempotency_key",
        F.col("id").alias("staging_transaction_id"),
        F.col("reference").alias("transaction_reference"),
        "amount",
        "status",
        raw_payload(rows).alias("raw_payload"),
        F.current_timestamp().alias("created_at"),
    )
