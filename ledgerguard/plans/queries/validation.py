"""Validation queries."""

from pyspark.sql import functions as F

from ...operators import anomalies as an
from ...operators import core as core_op
from ...operators import quarantine as op_q
from ...operators import validation as op
from ...session import written
from .. import bindings as b
from ..oracle import sql
from ..registry import ORACLE, query
from .quarantine import anomaly_tables, routed
from .reporting import MOVED


def core_rows(spark, sf):
    return core_op.core_from_route(routed(spark, sf))


def issue_tables(spark, sf):
    """The three issue tables, stored once, as the checks expect them."""
    tx = b.staged_transactions(spark, sf)
    anomalies, conflicts = [written(t.drop("raw_payload"), "issues") for t in anomaly_tables(tx)]
    held = op_q.quarantine(
        tx, [anomalies, conflicts], b.staged_accounts(spark, sf), b.accounts(spark, sf),
        b.merchants(spark, sf), b.agencies(spark, sf))
    return anomalies, conflicts, written(held.drop("raw_payload"), "issues")


def stored_core(spark, sf, *issues):
    """Core transactions from the stored issue tables."""
    return core_op.core_transactions(b.staged_transactions(spark, sf), *issues)


def _counts(pairs, name, rows):
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS {name}, COUNT(*) AS {rows} FROM {source}" for label, source in pairs)


LAYERS = [("staging.transactions", "ledger"), ("staging.users", "staged_users"), ("staging.accounts", "staged_accounts"),
          ("staging.merchants", "staged_merchants"), ("staging.agencies", "staged_agencies"),
          ("core.transactions", "core"), ("core.users", "users"), ("core.accounts", "accounts"),
          ("core.merchants", "merchants"), ("core.agencies", "agencies")]


def layers(spark, sf):
    return {
        "staging.transactions": b.staged_transactions(spark, sf), "staging.users": b.staged_users(spark, sf),
        "staging.accounts": b.staged_accounts(spark, sf), "staging.merchants": b.staged_merchants(spark, sf),
        "staging.agencies": b.staged_agencies(spark, sf), "core.transactions": core_rows(spark, sf),
        "core.users": b.users(spark, sf), "core.accounts": b.accounts(spark, sf),
        "core.merchants": b.merchants(spark, sf), "core.agencies": b.agencies(spark, sf),
    }


@query("v1_row_counts", sql(_counts(LAYERS, "layer", "rows")))
def v1(spark, sf):
    return op.row_counts(layers(spark, sf)).orderBy("layer")


@query("v2_core_duplicate_keys", sql("""
SELECT idempotency_key, COUNT(*) AS occurrences FROM core GROUP BY idempotency_key HAVING COUNT(*) > 1
"""))
def v2(spark, sf):
    return op.core_duplicate_keys(core_rows(spark, sf))


@query("v3_core_failed_moves", sql(MOVED.format("core")))
def v3(spark, sf):
    return op.core_failed_moves(core_rows(spark, sf))


@query("v3_core_failed_moves_unrouted", sql(MOVED.format("payments")))
def v3_unrouted(spark, sf):
    """The same report over a core that was loaded without routing, where failed payments moved money."""
    return op.core_failed_moves(core_op.core_transactions(b.staged_transactions(spark, sf), drop_repeats=False))


@query("v4_non_positive_amounts", "SELECT COUNT(*) AS bad_rows FROM customer WHERE c_acctbal <= 0")
def v4(spark, sf):
    return op.non_positive_amounts(b.table(spark, sf, "customer"), "c_acctbal")


@query("v5_negative_balances", sql("""
SELECT COUNT(*) AS bad_rows FROM payments WHERE balance_before < 0 OR balance_after < 0
"""))
def v5(spark, sf):
    return op.negative_balances(b.payments(spark, sf))


@query("v6_status_distribution", sql("""
SELECT status, COUNT(*) AS count,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS pct FROM payments GROUP BY status
"""))
def v6(spark, sf):
    return op.status_distribution(b.payments(spark, sf))


@query("v7_routing_summary", sql("""
WITH n AS (SELECT CAST(COUNT(*) AS DOUBLE) AS total FROM ledger)
SELECT 'Raw staging' AS layer, COUNT(*) AS rows, ROUND(COUNT(*) * 100 / total, 2) AS pct FROM ledger, n GROUP BY total
UNION ALL SELECT 'Idempotency conflicts', COUNT(*), ROUND(COUNT(*) * 100 / total, 2) FROM conflicts, n GROUP BY total
UNION ALL SELECT 'Transaction anomalies', COUNT(*), ROUND(COUNT(*) * 100 / total, 2) FROM anomalies, n GROUP BY total
UNION ALL SELECT 'Quarantine', COUNT(*), ROUND(COUNT(*) * 100 / total, 2) FROM holds, n GROUP BY total
UNION ALL SELECT 'CORE (trusted)', COUNT(*), ROUND(COUNT(*) * 100 / total, 2) FROM core, n GROUP BY total
"""))
def v7(spark, sf):
    anomalies, conflicts, holds = issue_tables(spark, sf)
    return op.layer_shares({
        "Raw staging": b.staged_transactions(spark, sf), "Idempotency conflicts": conflicts,
        "Transaction anomalies": anomalies, "Quarantine": holds,
        "CORE (trusted)": stored_core(spark, sf, anomalies, conflicts, holds),
    }, "Raw staging")


@query("v8_global_counts", sql("""
SELECT (SELECT COUNT(*) FROM ledger) AS staging_transactions, (SELECT COUNT(*) FROM anomalies) AS transaction_anomalies,
       (SELECT COUNT(*) FROM conflicts) AS idempotency_conflicts, (SELECT COUNT(*) FROM holds) AS quarantine_transactions,
       (SELECT COUNT(*) FROM core) AS core_ready_transactions
"""))
def v8(spark, sf):
    anomalies, conflicts, holds = issue_tables(spark, sf)
    return op.global_counts({
        "staging_transactions": b.staged_transactions(spark, sf), "transaction_anomalies": anomalies,
        "idempotency_conflicts": conflicts, "quarantine_transactions": holds,
        "core_ready_transactions": stored_core(spark, sf, anomalies, conflicts, holds)})


@query("v9_issue_counts", sql("""
SELECT code, COUNT(*) AS total FROM anomalies GROUP BY code UNION ALL SELECT code, COUNT(*) FROM holds GROUP BY code
"""))
def v9(spark, sf):
    anomalies, _, holds = issue_tables(spark, sf)
    anomalies = op.issue_counts(anomalies, "anomaly_type")
    holds = op.issue_counts(holds, "reject_reason")
    return anomalies.withColumnRenamed("anomaly_type", "code").unionByName(
        holds.withColumnRenamed("reject_reason", "code"))


@query("v10_overlaps", sql("""
SELECT 'anomalies' AS issue_table, (SELECT COUNT(*) FROM anomalies a JOIN holds q ON a.id = q.id) AS overlap
UNION ALL SELECT 'conflicts', (SELECT COUNT(*) FROM conflicts c JOIN holds q ON c.id = q.id)
UNION ALL SELECT 'both', (SELECT COUNT(*) FROM anomalies a JOIN conflicts c ON a.id = c.id)
"""))
def v10(spark, sf):
    anomalies, conflicts, holds = issue_tables(spark, sf)
    parts = [("anomalies", anomalies, holds), ("conflicts", conflicts, holds), ("both", anomalies, conflicts)]
    out = None
    for name, left, right in parts:
        part = op.overlap(left, right).select(F.lit(name).alias("issue_table"), "overlap")
        out = part if out is None else out.unionByName(part)
    return out


@query("v11_repeated_issues", sql("""
SELECT 'anomalies' AS issue_table, id AS staging_transaction_id, COUNT(*) AS duplicate_count
FROM anomalies GROUP BY id HAVING COUNT(*) > 1
UNION ALL SELECT 'quarantine', id, COUNT(*) FROM holds GROUP BY id HAVING COUNT(*) > 1
"""))
def v11(spark, sf):
    anomalies, _, holds = issue_tables(spark, sf)
    a, q = op.repeated_issues(anomalies), op.repeated_issues(holds)
    return a.withColumn("issue_table", F.lit("anomalies")).unionByName(
        q.withColumn("issue_table", F.lit("quarantine")))


def _missed(rule, broken):
    """Rows that break a rule and have no issue row of it, counted as a difference of sets."""
    return (f"SELECT '{rule}' AS rule, COUNT(*) AS missing FROM (SELECT id FROM ledger WHERE {broken} "
            f"EXCEPT SELECT id FROM anomalies WHERE code = '{rule}')")


@query("v12_unclassified", sql("\nUNION ALL\n".join([
    _missed("negative_balance", "starts_with(balance_after, '-')"),
    _missed("invalid_failed_balance",
            "CAST(balance_before AS DOUBLE) - CAST(balance_after AS DOUBLE) NOT BETWEEN 0 AND 0 AND status = 'FAILED'"),
    _missed("invalid_amount", "NOT CAST(amount AS DOUBLE) > 0"),
])))
def v12(spark, sf):
    tx = b.staged_transactions(spark, sf)
    issues = an.transaction_anomalies(tx)
    out = None
    for code, test in an.anomaly_tests().items():
        part = op.unclassified(tx, test, issues, "anomaly_type", code, "missing").select(
            F.lit(code).alias("rule"), "missing")
        out = part if out is None else out.unionByName(part)
    return out


@query("v12_unclassified_partial", sql("""
SELECT COUNT(*) AS missing FROM ledger WHERE CAST(balance_after AS DOUBLE) < 0 AND status <> 'SUCCESS'
"""))
def v12_partial(spark, sf):
    """Against issues of successful rows only, so that rows are missing."""
    tx = b.staged_transactions(spark, sf)
    issues = an.transaction_anomalies(tx.where("status = 'SUCCESS'"))
    return op.unclassified(
        tx, an.anomaly_tests()["negative_balance"], issues, "anomaly_type", "negative_balance", "missing")


@query("v13_unquarantined", sql("""
SELECT 'missing_source_account' AS reason, (SELECT COUNT(*) FROM candidates t
  WHERE (t.source_account_id = '' OR t.source_account_id NOT IN (SELECT id FROM staged_accounts))
  AND t.id NOT IN (SELECT id FROM holds WHERE code = 'missing_source_account')) AS missing
UNION ALL SELECT 'missing_destination_account', (SELECT COUNT(*) FROM candidates t
  WHERE (t.destination_account_id = '' OR t.destination_account_id NOT IN (SELECT id FROM staged_accounts))
  AND t.id NOT IN (SELECT id FROM holds WHERE code = 'missing_destination_account'))
"""))
def v13(spark, sf):
    tx, accounts = b.staged_transactions(spark, sf), b.staged_accounts(spark, sf)
    anomalies, conflicts, holds = issue_tables(spark, sf)
    out = None
    for column, reason in (("source_account_id", "missing_source_account"),
                           ("destination_account_id", "missing_destination_account")):
        part = op.unquarantined(tx, accounts, column, reason, holds, [anomalies, conflicts], "missing").select(
            F.lit(reason).alias("reason"), "missing")
        out = part if out is None else out.unionByName(part)
    return out


@query("v14_sample_issues", sql("""
SELECT t.id, t.amount, a.code AS anomaly_type FROM ledger t JOIN anomalies a ON a.id = t.id
WHERE CAST(t.amount AS DOUBLE) <= 0 ORDER BY t.id, a.code LIMIT 10
"""))
def v14(spark, sf):
    tx = b.staged_transactions(spark, sf)
    return op.sample_issues(tx, an.anomaly_tests()["invalid_amount"], an.transaction_anomalies(tx))


@query("v15_core_overlaps", sql("""
SELECT 'anomalies' AS issue_table, (SELECT COUNT(*) FROM core c JOIN anomalies a ON a.id = CAST(c.id AS VARCHAR)) AS rows
UNION ALL SELECT 'conflicts', (SELECT COUNT(*) FROM core c JOIN conflicts a ON a.id = CAST(c.id AS VARCHAR))
UNION ALL SELECT 'quarantine', (SELECT COUNT(*) FROM core c JOIN holds a ON a.id = CAST(c.id AS VARCHAR))
"""))
def v15(spark, sf):
    anomalies, conflicts, holds = issue_tables(spark, sf)
    core = written(stored_core(spark, sf, anomalies, conflicts, holds).select("id"), "core")
    return op.core_overlaps(core, {"anomalies": anomalies, "conflicts": conflicts, "quarantine": holds})


@query("v16_conservation", sql("""
SELECT (SELECT COUNT(*) FROM ledger) - (SELECT COUNT(*) FROM (SELECT id FROM anomalies UNION SELECT id FROM conflicts
        UNION SELECT id FROM holds)) AS expected_core_ready, (SELECT COUNT(*) FROM core) AS actual_core_ready
"""))
def v16(spark, sf):
    """From the routed rows, which are stored once and read for their few columns."""
    rows = written(routed(spark, sf), "routed")
    out = rows.where(F.col("route") != "CORE").select(F.col("id").alias(op.ID))
    return op.conservation(rows, core_op.core_from_route(rows), out)


@query("v16_conservation_of_issues", ORACLE["v16_conservation"])
def v16_issues(spark, sf):
    """The same balance from the three issue tables."""
    issues = issue_tables(spark, sf)
    return op.conservation(b.staged_transactions(spark, sf), stored_core(spark, sf, *issues), *issues)


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("v17_expected_counts", _counts([(t, t) for t in TABLES], "table_name", "actual_rows").replace(
    " FROM", ", CAST({} AS BIGINT) AS expected_rows FROM").format(5, 25, *["NULL"] * 6))
def v17(spark, sf):
    return op.expected_counts({t: b.table(spark, sf, t) for t in TABLES}, {"region": 5, "nation": 25})


@query("v18_all_loaded", "SELECT " + ", ".join(f"(SELECT COUNT(*) FROM {t}) > 0 AS {t}_loaded" for t in TABLES))
def v18(spark, sf):
    return op.all_loaded({t: b.table(spark, sf, t) for t in TABLES})


@query("v19_repeated_values", sql("""
SELECT 'duplicate_phone_users' AS check_name, COUNT(*) AS duplicate_keys
FROM (SELECT phone FROM staged_users WHERE phone <> '' GROUP BY phone HAVING COUNT(*) > 1)
UNION ALL SELECT 'duplicate_idempotency_keys', COUNT(*)
FROM (SELECT idempotency_key FROM ledger WHERE idempotency_key <> '' GROUP BY idempotency_key HAVING COUNT(*) > 1)
"""))
def v19(spark, sf):
    users = op.repeated_value_count(b.staged_users(spark, sf), "phone", "duplicate_phone_users", "duplicate_keys")
    return users.unionByName(op.repeated_value_count(
        b.staged_transactions(spark, sf), "idempotency_key", "duplicate_idempotency_keys", "duplicate_keys"))


@query("v20_worker_stats", """
SELECT user_id, COUNT(*) AS rows_inserted, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_insert,
       strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_insert,
       CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS DOUBLE) / 1e6 AS duration_seconds
FROM events GROUP BY user_id
""")
def v20(spark, sf):
    return op.worker_stats(b.table(spark, sf, "events"), "user_id", "ts")


@query("v21_table_summary", sql(
    "SELECT table_name, row_count, CASE table_name WHEN 'region' THEN '= 5 expected' WHEN 'nation' THEN '= 25 expected' "
    "WHEN 'core.users' THEN '> 0 expected' ELSE '' END AS expected FROM ("
    + _counts([(t, t) for t in TABLES] + [("core.users", "users"), ("core.accounts", "accounts")], "table_name", "row_count")
    + ") counts"))
def v21(spark, sf):
    tables = {t: b.table(spark, sf, t) for t in TABLES}
    tables |= {"core.users": b.users(spark, sf), "core.accounts": b.accounts(spark, sf)}
    return op.table_summary(tables, {
        "region": "= 5 expected", "nation": "= 25 expected", "core.users": "> 0 expected"})


@query("v22_violation_counts", sql("""
SELECT COUNT(*) FILTER (WHERE amount <= 0) AS bad_amount, COUNT(*) FILTER (WHERE balance_after < 0) AS bad_balance FROM payments
"""))
def v22(spark, sf):
    return op.violation_counts(b.payments(spark, sf), {
        "bad_amount": F.col("amount") <= 0, "bad_balance": F.col("balance_after") < 0})


@query("v23_bad_prefixes", sql("""
SELECT 'before' AS state, COUNT(*) AS still_broken FROM merchants WHERE name LIKE 'undefined %'
UNION ALL SELECT 'after', COUNT(*) FROM merchants
WHERE (CASE WHEN name LIKE 'undefined %' THEN replace(name, 'undefined ', '') ELSE name END) LIKE 'undefined %'
"""))
def v23(spark, sf):
    raw = b.merchants(spark, sf)
    repaired = core_op.core_merchants(b.staged_merchants(spark, sf))
    return op.still_bad_prefix(raw).select(F.lit("before").alias("state"), "still_broken").unionByName(
        op.still_bad_prefix(repaired).select(F.lit("after").alias("state"), "still_broken"))


@query("v24_integrity_counts", sql("""
WITH totals AS (
    SELECT COUNT(DISTINCT idempotency_key) FILTER (WHERE uses > 1) AS repeated,
           COUNT(CASE WHEN status = 'FAILED' AND balance_after - balance_before <> 0 THEN id END) AS moved,
           COUNT(CASE WHEN NOT amount > 0 THEN id END) AS amounts,
           COUNT(CASE WHEN balance_after < 0 THEN id END) AS overdrawn
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY idempotency_key) AS uses FROM payments))
SELECT unnest(['A: duplicate idempotency', 'B: FAILED with balance change', 'C: negative amount',
               'D: negative balance_after']) AS check_name,
       unnest([repeated, moved, amounts, overdrawn]) AS bad_rows
FROM totals
"""))
def v24(spark, sf):
    return op.integrity_counts(b.payments(spark, sf))
