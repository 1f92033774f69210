"""SQL side of the bindings: the same ledger tables as common table expressions.

Used only to check results; the operators never read this module.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["ledger"] = """
SELECT CAST(k AS VARCHAR) AS id,
       'TX' || CAST(CASE WHEN k % 500 = 3 THEN k - 1 ELSE k END AS VARCHAR) AS reference,
       'k' || CAST(CASE WHEN k % 10 = 1 THEN k - 1 ELSE k END AS VARCHAR) AS idempotency_key,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'PAY' WHEN '2' THEN 'TRF'
            WHEN '3' THEN 'WIT' WHEN '4' THEN 'BIL' ELSE 'DEP' END AS transaction_type,
       CASE WHEN k % 97 = 0 THEN '-' ELSE '' END || CAST(price AS VARCHAR) AS amount,
       CASE WHEN k % 20 = 0 THEN '' WHEN k % 701 = 7 THEN '-1.00'
            ELSE CAST(k % 5 AS VARCHAR) || '.00' END AS fee,
       CASE WHEN k % 97 = 0 THEN '-' ELSE '' END || CAST(price AS VARCHAR) AS total_amount,
       CASE WHEN k % 20 = 0 THEN '' WHEN k % 703 = 9 THEN 'EUR' ELSE 'MRU' END AS currency,
       CASE WHEN k % 37 = 0 THEN '' WHEN k % 31 = 0 THEN CAST(o_custkey + 100000000 AS VARCHAR)
            ELSE CAST(o_custkey AS VARCHAR) END AS source_account_id,
       CASE WHEN k % 41 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS destination_account_id,
       CASE WHEN k % 43 = 0 THEN '' ELSE CAST(k % 7 AS VARCHAR) END AS merchant_id,
       CASE WHEN k % 601 = 5 THEN 'abc' WHEN k % 4 <> 0 THEN '' ELSE CAST(k % 10 AS VARCHAR) END AS agency_id,
       CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'FAILED' ELSE 'PENDING' END AS status,
       CASE WHEN o_orderstatus = 'F' AND k % 2 = 0 THEN 'INSUFFICIENT_FUNDS' ELSE '' END AS failure_reason,
       '600000.00' AS balance_before,
       CASE WHEN k % 89 = 0 THEN '-1.00'
            WHEN o_orderstatus = 'O' THEN CAST(CAST(600000 AS DECIMAL(14,2)) - price AS VARCHAR)
            WHEN k % 53 = 0 THEN '599999.00' ELSE '600000.00' END AS balance_after,
       'N' || CAST(k % 5 AS VARCHAR) AS node_id,
       'N' || CAST((k * 3) % 5 AS VARCHAR) AS processing_node,
       CAST(k AS VARCHAR) AS sequence_number,
       CASE WHEN k % 2 = 0 THEN 'APP' ELSE 'USSD' END AS channel,
       day AS transaction_date,
       clock AS transaction_time,
       day || 'T' || clock || '.000Z' AS created_at,
       CASE WHEN k % 3 = 1 THEN '' WHEN k % 101 = 0 THEN day || 'T00:00:00.000Z'
            ELSE day || 'T23:59:59.000Z' END AS completed_at
FROM (SELECT *, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(14,2)) AS price,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
             lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS clock FROM orders)
"""

VIEWS["staged_users"] = """
SELECT CAST(k AS VARCHAR) AS id,
       CASE WHEN c_acctbal < 0 THEN 'XX' || lpad(CAST(k AS VARCHAR), 8, '0')
            ELSE lpad(CAST(k AS VARCHAR), 10, '0') END AS nni,
       '+222' || lpad(CAST(CASE WHEN k % 25 = 1 THEN k - 1 ELSE k END AS VARCHAR), 8, '0') AS phone,
       c_name AS full_name,
       CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       '1990-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') AS birth_date,
       CASE WHEN k % 5 < 3 THEN '' ELSE 'u' || CAST(k AS VARCHAR) || '@example.org' END AS email,
       CAST(c_nationkey AS VARCHAR) AS wilaya_id,
       CASE WHEN k % 30 = 2 THEN 'elsewhere' ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS wilaya_name,
       CASE WHEN k % 10 = 9 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status,
       '2020-02-01' AS registration_date,
       '2020-02-01T08:00:00.000Z' AS created_at,
       '' AS updated_at
FROM (SELECT *, c_custkey AS k FROM customer)
"""

VIEWS["staged_accounts"] = """
SELECT CAST(k AS VARCHAR) AS id, CAST(k AS VARCHAR) AS user_id,
       'ACC' || lpad(CAST(k AS VARCHAR), 9, '0') AS account_number,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'CORPORATE' ELSE 'WALLET' END AS account_type,
       CASE WHEN k % 9 = 0 THEN '' ELSE 'MRU' END AS currency,
       CAST(balance AS VARCHAR) AS balance,
       CAST(CAST(balance + CAST(k % 7 * 1000 AS DECIMAL(14,2)) AS DECIMAL(15,2)) AS VARCHAR) AS available_balance,
       '50000.00' AS daily_limit, '500000.00' AS monthly_limit,
       CASE WHEN k % 4 = 3 THEN 'FROZEN' ELSE 'ACTIVE' END AS status,
       CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'yes' END AS is_primary,
       '2020-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') AS opened_date,
       '' AS last_activity, '2020-01-01T00:00:00.000Z' AS created_at, '' AS updated_at
FROM (SELECT *, c_custkey AS k, CAST(c_acctbal AS DECIMAL(14,2)) AS balance FROM customer)
"""

VIEWS["staged_merchants"] = """
SELECT CAST(k AS VARCHAR) AS id,
       CASE WHEN k % 50 = 13 THEN '' ELSE 'MRC' || lpad(CAST(k AS VARCHAR), 9, '0') END AS code,
       CASE WHEN k % 2 = 0 THEN 'undefined ' ELSE '' END || p_name AS name,
       p_type AS category_code, CAST(p_size % 25 AS VARCHAR) AS wilaya_id,
       CASE WHEN k % 11 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
       '2021-06-06T15:25:48.000Z' AS created_at
FROM (SELECT *, p_partkey AS k FROM part)
"""

VIEWS["staged_agencies"] = """
SELECT CAST(k AS VARCHAR) AS id,
       CASE WHEN k % 20 = 13 THEN '' ELSE 'AG' || lpad(CAST(k AS VARCHAR), 6, '0') END AS code,
       s_name AS name, CAST(s_nationkey AS VARCHAR) AS wilaya_id,
       CASE WHEN k % 9 = 0 THEN '' ELSE CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS VARCHAR) END AS float_balance,
       CASE k % 3 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' ELSE 'GOLD' END AS tier,
       'LIC-' || lpad(CAST(k AS VARCHAR), 6, '0') AS license_number,
       'ACTIVE' AS status, '2020-06-24T08:28:57.000Z' AS created_at
FROM (SELECT *, s_suppkey AS k FROM supplier)
"""

VIEWS["wilayas"] = """
SELECT n_nationkey AS id, 'W' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code,
       n_name AS name, r_name AS capital, n_nationkey * 1000 AS population
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["tx_types"] = """
SELECT CAST(MIN(CAST(id AS BIGINT)) AS INTEGER) AS id, transaction_type AS code,
       lower(transaction_type) AS label,
       transaction_type = 'TRF' AS requires_destination,
       transaction_type = 'PAY' AS requires_merchant,
       transaction_type IN ('DEP', 'WIT') AS requires_agency,
       CASE WHEN transaction_type = 'DEP' THEN TRUE END AS is_credit
FROM ledger GROUP BY transaction_type
"""

VIEWS["categories"] = """
SELECT CAST(MIN(p_partkey) AS INTEGER) AS id, p_type AS code,
       CAST(MIN(p_partkey) + 500 AS VARCHAR) AS mcc, lower(p_type) AS label,
       MIN(CAST(p_retailprice AS DECIMAL(14,2))) AS avg_min,
       MAX(CAST(p_retailprice AS DECIMAL(14,2))) AS avg_max
FROM part GROUP BY p_type
"""

VIEWS["users"] = r"""
SELECT CAST(id AS BIGINT) AS id, nni, phone, full_name, gender, CAST(birth_date AS DATE) AS birth_date,
       NULLIF(email, '') AS email, CAST(wilaya_id AS INTEGER) AS wilaya_id, status
FROM staged_users
WHERE regexp_full_match(nni, '[0-9]{10}') AND regexp_full_match(phone, '\+222[0-9]{8}')
"""

VIEWS["accounts"] = """
SELECT CAST(a.id AS BIGINT) AS id, CAST(a.user_id AS BIGINT) AS user_id, a.account_number, a.account_type,
       CAST(a.balance AS DECIMAL(14,2)) AS balance,
       CAST(a.available_balance AS DECIMAL(14,2)) AS available_balance,
       COALESCE(NULLIF(a.currency, ''), 'MRU') AS currency,
       CAST(a.daily_limit AS DECIMAL(14,2)) AS daily_limit,
       CAST(a.monthly_limit AS DECIMAL(14,2)) AS monthly_limit,
       a.status, a.is_primary = 'true' AS is_primary, CAST(a.opened_date AS DATE) AS opened_date
FROM staged_accounts a WHERE a.user_id IN (SELECT CAST(id AS VARCHAR) FROM users)
"""

VIEWS["merchants"] = """
SELECT CAST(id AS BIGINT) AS id, code, name, category_code, CAST(wilaya_id AS INTEGER) AS wilaya_id, status
FROM staged_merchants WHERE code <> ''
"""

VIEWS["agencies"] = """
SELECT CAST(id AS BIGINT) AS id, code, name, CAST(wilaya_id AS INTEGER) AS wilaya_id,
       CAST(NULLIF(float_balance, '') AS DECIMAL(14,2)) AS float_balance, tier, license_number, status
FROM staged_agencies WHERE code <> ''
"""

VIEWS["payments"] = """
SELECT CAST(id AS BIGINT) AS id, reference, idempotency_key, transaction_type,
       CAST(amount AS DECIMAL(14,2)) AS amount,
       COALESCE(CAST(NULLIF(fee, '') AS DECIMAL(14,2)), 0) AS fee,
       COALESCE(NULLIF(currency, ''), 'MRU') AS currency,
       CAST(NULLIF(source_account_id, '') AS BIGINT) AS source_account_id,
       CAST(NULLIF(destination_account_id, '') AS BIGINT) AS destination_account_id,
       CAST(NULLIF(merchant_id, '') AS BIGINT) AS merchant_id,
       CASE WHEN regexp_full_match(agency_id, '[0-9]+') THEN TRY_CAST(agency_id AS BIGINT) END AS agency_id,
       status, NULLIF(failure_reason, '') AS failure_reason,
       CAST(balance_before AS DECIMAL(14,2)) AS balance_before,
       CAST(balance_after AS DECIMAL(14,2)) AS balance_after,
       CAST(transaction_date AS DATE) AS transaction_date, transaction_time,
       CAST(replace(replace(created_at, 'T', ' '), 'Z', '') AS TIMESTAMP) AS created_at,
       CAST(replace(replace(NULLIF(completed_at, ''), 'T', ' '), 'Z', '') AS TIMESTAMP) AS completed_at
FROM ledger
"""

VIEWS["purchases"] = """
SELECT id, 'LI' || CAST(id AS VARCHAR) AS reference,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS idempotency_key,
       amount, fee, l_partkey AS merchant_id, l_suppkey AS agency_id, status,
       CAST(2000000 AS DECIMAL(14,2)) AS balance_before,
       CAST(CASE WHEN status = 'SUCCESS' THEN 2000000 - amount - fee
                 + CASE l_linenumber WHEN 7 THEN 5 WHEN 6 THEN 1 ELSE 0 END
            WHEN l_linenumber = 3 THEN 1999997 ELSE 2000000 END AS DECIMAL(14,2)) AS balance_after,
       CAST(l_shipdate AS DATE) AS transaction_date
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS id,
             CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, CAST(l_quantity AS DECIMAL(14,2)) AS fee,
             CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'N' THEN 'FAILED' ELSE 'PENDING' END AS status
      FROM lineitem)
"""

VIEWS["activity"] = """
SELECT event_id AS id, CAST(user_id AS VARCHAR) || '-' || CAST(event_id // 3 AS VARCHAR) AS idempotency_key,
       user_id AS source_account_id, CAST(value AS DECIMAL(14,2)) AS amount,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       ts AS created_at, CAST(ts AS DATE) AS transaction_date
FROM events
"""

VIEWS["items"] = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
       || '-' || CAST(l_suppkey AS VARCHAR) AS id,
       'LI' || CAST(l_orderkey AS VARCHAR) AS reference,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS idempotency_key,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS amount, l_returnflag AS status,
       CAST(l_partkey AS VARCHAR) AS source_account_id, CAST(l_suppkey AS VARCHAR) AS destination_account_id
FROM lineitem
"""

# -- routing, rule by rule ---------------------------------------------------------------------

VIEWS["anomalies"] = """
SELECT id, reference, idempotency_key, 'invalid_failed_balance' AS code FROM ledger
WHERE status = 'FAILED' AND CAST(balance_after AS DECIMAL(14,2)) <> CAST(balance_before AS DECIMAL(14,2))
UNION ALL
SELECT id, reference, idempotency_key, 'invalid_amount' FROM ledger WHERE CAST(amount AS DECIMAL(14,2)) <= 0
UNION ALL
SELECT id, reference, idempotency_key, 'negative_balance' FROM ledger WHERE CAST(balance_after AS DECIMAL(14,2)) < 0
"""

VIEWS["conflicts"] = """
SELECT * FROM ledger WHERE idempotency_key IN (
  SELECT idempotency_key FROM ledger GROUP BY idempotency_key
  HAVING COUNT(*) > 1 AND (COUNT(DISTINCT amount) > 1 OR COUNT(DISTINCT status) > 1
      OR COUNT(DISTINCT source_account_id) > 1 OR COUNT(DISTINCT destination_account_id) > 1))
"""

VIEWS["candidates"] = """
SELECT * FROM ledger t WHERE NOT EXISTS (SELECT 1 FROM anomalies a WHERE a.id = t.id)
  AND NOT EXISTS (SELECT 1 FROM conflicts c WHERE c.id = t.id)
"""

VIEWS["staged_holds"] = """
SELECT id, reference, idempotency_key, 'missing_source_account' AS code FROM candidates
WHERE source_account_id = '' OR source_account_id NOT IN (SELECT id FROM staged_accounts)
UNION ALL
SELECT id, reference, idempotency_key, 'missing_destination_account' FROM candidates
WHERE destination_account_id = '' OR destination_account_id NOT IN (SELECT id FROM staged_accounts)
UNION ALL
SELECT id, reference, idempotency_key, 'missing_merchant' FROM candidates
WHERE transaction_type = 'PAY' AND merchant_id = ''
"""

VIEWS["dangling"] = """
SELECT id, reference, idempotency_key, 'missing_core_reference' AS code FROM ledger
WHERE (regexp_full_match(source_account_id, '[0-9]+')
       AND CAST(NULLIF(source_account_id, '') AS BIGINT) NOT IN (SELECT id FROM accounts))
   OR (regexp_full_match(destination_account_id, '[0-9]+')
       AND CAST(NULLIF(destination_account_id, '') AS BIGINT) NOT IN (SELECT id FROM accounts))
   OR (regexp_full_match(merchant_id, '[0-9]+')
       AND CAST(NULLIF(merchant_id, '') AS BIGINT) NOT IN (SELECT id FROM merchants))
   OR (regexp_full_match(agency_id, '[0-9]+')
       AND TRY_CAST(agency_id AS BIGINT) NOT IN (SELECT id FROM agencies))
"""

VIEWS["holds"] = """
SELECT * FROM staged_holds
UNION ALL
SELECT d.* FROM dangling d WHERE d.id IN (SELECT id FROM candidates)
  AND d.id NOT IN (SELECT id FROM staged_holds)
"""

VIEWS["routed"] = """
SELECT t.*, CASE WHEN t.id IN (SELECT id FROM anomalies) OR t.id IN (SELECT id FROM conflicts) THEN 'ANOMALY'
                 WHEN t.id IN (SELECT id FROM holds) THEN 'QUARANTINE' ELSE 'CORE' END AS route
FROM ledger t
"""

VIEWS["core"] = """
SELECT * FROM payments WHERE CAST(id AS VARCHAR) IN (SELECT id FROM routed WHERE route = 'CORE')
"""


def sql(query: str) -> str:
    """The query with the views that it needs in front."""
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in VIEWS:
            if name not in order and name != own and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(VIEWS[name], name)
                order.append(name)

    need(query)
    if not order:
        return query.strip()
    heads = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    body = query.strip()
    return f"WITH {heads}\n" + (", " + body[5:] if body.upper().startswith("WITH ") else body)


def top_values(source: str, value: str, keep: int = 10) -> str:
    """The smallest distinct values of a query as one text."""
    return (f"COALESCE((SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {value} AS v "
            f"FROM ({source}) s0 WHERE {value} IS NOT NULL ORDER BY v LIMIT {keep}) s1), '')")
