"""Anomaly detection."""


from ...operators import anomalies as op
from .. import bindings as b
from ..oracle import sql
from ..registry import query


def _issues(df):
    return df.drop("raw_payload", "created_at")


ISSUE = ("id AS staging_transaction_id, reference AS transaction_reference, idempotency_key, "
         "code AS anomaly_type, CASE code WHEN 'invalid_failed_balance' THEN 'FAILED transaction changed balance' "
         "WHEN 'invalid_amount' THEN 'Amount must be greater than zero' "
         "ELSE 'Balance after transaction is negative' END AS anomaly_details")


@query("a1_invalid_failed_balance", sql(f"SELECT {ISSUE} FROM anomalies WHERE code = 'invalid_failed_balance'"))
def a1(spark, sf):
    return _issues(op.invalid_failed_balance(b.staged_transactions(spark, sf)))


@query("a2_invalid_amount", sql(f"SELECT {ISSUE} FROM anomalies WHERE code = 'invalid_amount'"))
def a2(spark, sf):
    return _issues(op.invalid_amount(b.staged_transactions(spark, sf)))


@query("a3_negative_balance", sql(f"SELECT {ISSUE} FROM anomalies WHERE code = 'negative_balance'"))
def a3(spark, sf):
    return _issues(op.negative_balance(b.staged_transactions(spark, sf)))


@query("a4_transaction_anomalies", sql(f"SELECT {ISSUE} FROM anomalies"))
def a4(spark, sf):
    return _issues(op.transaction_anomalies(b.staged_transactions(spark, sf)))


@query("a5_conflict_groups", sql("""
SELECT idempotency_key, COUNT(*) AS duplicate_count,
       COUNT(DISTINCT amount) AS distinct_amounts, COUNT(DISTINCT status) AS distinct_statuses,
       COUNT(DISTINCT source_account_id) AS distinct_source_accounts,
       COUNT(DISTINCT destination_account_id) AS distinct_destination_accounts
FROM items GROUP BY idempotency_key
HAVING COUNT(*) > 1 AND (COUNT(DISTINCT amount) > 1 OR COUNT(DISTINCT status) > 1
    OR COUNT(DISTINCT source_account_id) > 1 OR COUNT(DISTINCT destination_account_id) > 1)
"""))
def a5(spark, sf):
    return op.conflict_groups(b.items_as_text(spark, sf)).withColumnsRenamed({
        "distinct_amount": "distinct_amounts",
        "distinct_status": "distinct_statuses",
        "distinct_source_account_id": "distinct_source_accounts",
        "distinct_destination_account_id": "distinct_destination_accounts",
    })


CONFLICT_ROWS = """
SELECT 'idem_' || idempotency_key AS conflict_group_id, idempotency_key, id AS staging_transaction_id,
       reference AS transaction_reference, amount, status FROM {0}
WHERE idempotency_key IN (
  SELECT idempotency_key FROM {0} GROUP BY idempotency_key
  HAVING COUNT(*) > 1 AND (COUNT(DISTINCT amount) > 1 OR COUNT(DISTINCT status) > 1
    OR COUNT(DISTINCT source_account_id) > 1 OR COUNT(DISTINCT destination_account_id) > 1))
"""


@query("a6_idempotency_conflicts", sql(CONFLICT_ROWS.format("ledger")))
def a6(spark, sf):
    return _issues(op.idempotency_conflicts(b.staged_transactions(spark, sf)))


@query("a6_idempotency_conflicts_lineitem", sql(CONFLICT_ROWS.format("items")))
def a6_items(spark, sf):
    return _issues(op.idempotency_conflicts(b.items_as_text(spark, sf)))


@query("a1_invalid_failed_balance_text", sql("""
SELECT id AS staging_transaction_id, reference AS transaction_reference, idempotency_key
FROM ledger WHERE status = 'FAILED' AND balance_after <> balance_before
"""))
def a1_text(spark, sf):
    rows = op.invalid_failed_balance(b.staged_transactions(spark, sf), text_compare=True)
    return rows.select("staging_transaction_id", "transaction_reference", "idempotency_key")
