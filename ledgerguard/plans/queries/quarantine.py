"""Quarantine and routing."""

from pyspark.sql import functions as F

from ...operators import anomalies as an
from ...operators import quarantine as op
from ...operators import routing
from .. import bindings as b
from ..oracle import sql
from ..registry import query

HELD = "id AS staging_transaction_id, reference AS transaction_reference, idempotency_key"


def _held(df):
    return df.select("staging_transaction_id", "transaction_reference", "idempotency_key", "reject_reason")


def routed(spark, sf):
    return routing.route(
        b.staged_transactions(spark, sf), b.staged_accounts(spark, sf), b.accounts(spark, sf),
        b.merchants(spark, sf), b.agencies(spark, sf))


def anomaly_tables(tx):
    return [an.transaction_anomalies(tx), an.idempotency_conflicts(tx)]


def held(spark, sf):
    tx = b.staged_transactions(spark, sf)
    return op.quarantine(
        tx, anomaly_tables(tx), b.staged_accounts(spark, sf), b.accounts(spark, sf),
        b.merchants(spark, sf), b.agencies(spark, sf))


@query("k1_missing_source_account", sql(f"""
SELECT {HELD}, 'missing_source_account' AS reject_reason FROM ledger
WHERE source_account_id = '' OR source_account_id NOT IN (SELECT id FROM staged_accounts)
"""))
def k1(spark, sf):
    return _held(op.missing_source_account(b.staged_transactions(spark, sf), b.staged_accounts(spark, sf)))


@query("k2_missing_destination_account", sql(f"""
SELECT {HELD}, 'missing_destination_account' AS reject_reason FROM ledger
WHERE destination_account_id = '' OR destination_account_id NOT IN (SELECT id FROM staged_accounts)
"""))
def k2(spark, sf):
    return _held(op.missing_destination_account(b.staged_transactions(spark, sf), b.staged_accounts(spark, sf)))


@query("k3_missing_merchant", sql(f"""
SELECT {HELD}, 'missing_merchant' AS reject_reason FROM ledger
WHERE transaction_type = 'PAY' AND merchant_id = ''
"""))
def k3(spark, sf):
    return _held(op.missing_merchant(b.staged_transactions(spark, sf)))


@query("k4_missing_core_reference", sql(f"SELECT {HELD}, code AS reject_reason FROM dangling"))
def k4(spark, sf):
    return _held(op.missing_core_reference(
        b.staged_transactions(spark, sf), b.accounts(spark, sf), b.merchants(spark, sf), b.agencies(spark, sf)))


@query("k4_missing_core_reference_lineitem", sql(f"""
SELECT {HELD}, 'missing_core_reference' AS reject_reason FROM items
WHERE CAST(source_account_id AS BIGINT) NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)
   OR CAST(destination_account_id AS BIGINT) NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
"""))
def k4_items(spark, sf):
    items = b.items_as_text(spark, sf).select(
        "*", F.lit("").alias("merchant_id"), F.col("destination_account_id").alias("agency_id"))
    parts = b.table(spark, sf, "part").where("p_size > 2").select(F.col("p_partkey").alias("id"))
    suppliers = b.table(spark, sf, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("id"))
    items = items.withColumn("destination_account_id", F.lit(None).cast("string"))  # four parents, two used
    return _held(op.missing_core_reference(items, parts, parts, suppliers))


@query("k5_priority_exclusion", sql(f"""
SELECT {HELD}, code AS reject_reason FROM dangling d
WHERE d.id IN (SELECT id FROM candidates)
"""))
def k5(spark, sf):
    tx = b.staged_transactions(spark, sf)
    issues = op.missing_core_reference(tx, b.accounts(spark, sf), b.merchants(spark, sf), b.agencies(spark, sf))
    return _held(op.exclude(issues, *anomaly_tables(tx)))


@query("k5_quarantine_rows", sql(f"SELECT {HELD}, code AS reject_reason FROM holds"))
def k5_all(spark, sf):
    return _held(held(spark, sf))


@query("k6_reason_catalogue", sql("""
SELECT code AS reason_code, CASE code
    WHEN 'missing_source_account' THEN 'Source account is missing or cannot be resolved'
    WHEN 'missing_destination_account' THEN 'Destination account is missing or cannot be resolved'
    WHEN 'missing_merchant' THEN 'PAY transaction requires a merchant_id'
    ELSE 'Transaction references a parent record that does not exist in core tables' END AS description,
    (SELECT COUNT(*) FROM holds h WHERE h.code = c.code) AS total
FROM (VALUES ('missing_source_account'), ('missing_destination_account'), ('missing_merchant'),
             ('missing_core_reference')) c(code)
"""))
def k6(spark, sf):
    """Written over an older catalogue, with the rows that each code has."""
    totals = held(spark, sf).groupBy(F.col("reject_reason").alias("reason_code")).agg(F.count(F.lit(1)).alias("total"))
    old = op.reason_catalogue(spark).limit(2).withColumn("description", F.lit("outdated"))
    return op.reason_catalogue(spark, old).join(totals, "reason_code", "left").withColumn(
        "total", F.coalesce("total", F.lit(0)))


@query("k7_missing_required", sql("""
SELECT ledger.id AS staging_transaction_id, 'missing_merchant' AS reject_reason FROM ledger JOIN tx_types y
  ON y.code = transaction_type WHERE requires_merchant AND merchant_id = ''
UNION ALL
SELECT ledger.id, 'missing_destination_account' FROM ledger JOIN tx_types y
  ON y.code = transaction_type WHERE requires_destination AND destination_account_id = ''
UNION ALL
SELECT ledger.id, 'missing_agency' FROM ledger JOIN tx_types y
  ON y.code = transaction_type WHERE requires_agency AND agency_id = ''
"""))
def k7(spark, sf):
    rows = op.missing_required(b.staged_transactions(spark, sf), b.tx_types(spark, sf))
    return rows.select("staging_transaction_id", "reject_reason")


@query("k8_route", sql("""
WITH codes AS (SELECT id, code FROM anomalies UNION SELECT id, 'idempotency_conflict' FROM conflicts
               UNION SELECT id, code FROM holds)
SELECT t.id, t.route, COALESCE(string_agg(c.code, '|' ORDER BY c.code), '') AS reasons
FROM routed t LEFT JOIN codes c ON c.id = t.id GROUP BY t.id, t.route
"""))
def k8(spark, sf):
    return routed(spark, sf).select("id", "route", F.array_sort("reasons").alias("reasons"))


@query("k9_routing_summary", sql("""
SELECT route AS layer, COUNT(*) AS rows,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS pct
FROM routed GROUP BY route
"""))
def k9(spark, sf):
    return routing.routing_summary(routed(spark, sf))
