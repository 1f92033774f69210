"""Core load, lookups and the constraint report."""

from pyspark.sql import functions as F

from ...operators import core as op, quarantine, validation
from ...operators.constraints import constraint_report, table_report
from ...session import written
from .. import bindings as b
from ..oracle import sql
from ..registry import query
from .quarantine import anomaly_tables, held, routed


@query("c1_core_users", sql("""
SELECT id, nni, phone, full_name, gender, CAST(birth_date AS VARCHAR) AS birth_date, email, wilaya_id, status FROM users
"""))
def c1(spark, sf):
    return b.users(spark, sf).drop("registration_date", "created_at", "updated_at")


@query("c2_core_accounts", sql("""
SELECT id, user_id, account_number, account_type, CAST(balance AS DOUBLE) AS balance,
       CAST(available_balance AS DOUBLE) AS available_balance, currency, CAST(daily_limit AS DOUBLE) AS daily_limit,
       status, is_primary, CAST(opened_date AS VARCHAR) AS opened_date FROM accounts
"""))
def c2(spark, sf):
    return b.accounts(spark, sf).drop("monthly_limit", "last_activity", "created_at", "updated_at")


@query("c3_core_merchants", sql("""
SELECT id, code, name, category_code, wilaya_id, status, '2021-06-06 15:25:48' AS created_at,
       '2021-06-06 15:25:48' AS updated_at FROM merchants
"""))
def c3(spark, sf):
    return b.merchants(spark, sf)


@query("c3_core_merchants_repaired", sql("""
SELECT id, CASE WHEN name LIKE 'undefined %' THEN replace(name, 'undefined ', '') ELSE name END AS name FROM merchants
"""))
def c3_repaired(spark, sf):
    return op.core_merchants(b.staged_merchants(spark, sf)).select("id", "name")


@query("c4_core_agencies", sql("""
SELECT id, code, name, wilaya_id, CAST(float_balance AS DOUBLE) AS float_balance, tier, license_number, status FROM agencies
"""))
def c4(spark, sf):
    return b.agencies(spark, sf).drop("created_at", "updated_at")


@query("c5_load_lookups", sql("""
SELECT 'wilayas' AS lookup, CAST(id AS BIGINT) AS id, code, name AS label FROM wilayas
UNION ALL SELECT 'tx_types', CAST(id AS BIGINT), code, label FROM tx_types
UNION ALL SELECT 'categories', CAST(id AS BIGINT), code, mcc || ' ' || label FROM categories
"""))
def c5(spark, sf):
    def part(name, df, label):
        return df.select(F.lit(name).alias("lookup"), "id", "code", label.alias("label"))
    return (
        part("wilayas", b.wilayas(spark, sf), F.col("name"))
        .unionByName(part("tx_types", b.tx_types(spark, sf), F.col("label")))
        .unionByName(part("categories", b.categories(spark, sf), F.concat_ws(" ", "mcc", "label")))
    )


@query("c6_assert_counts", """
SELECT n_regionkey AS region, COUNT(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def c6(spark, sf):
    nation = op.assert_count(b.table(spark, sf, "nation"), 25, "nation")
    region = op.assert_count(b.table(spark, sf, "region"), 5, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(
        F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("nations"))


CORE_COLUMNS = """id, reference, idempotency_key, transaction_type, CAST(amount AS DOUBLE) AS amount,
       CAST(fee AS DOUBLE) AS fee, currency, source_account_id, destination_account_id, merchant_id, status,
       failure_reason, CAST(balance_after AS DOUBLE) AS balance_after,
       CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_time,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at"""
SHOWN = ["id", "reference", "idempotency_key", "transaction_type", "amount", "fee", "currency", "source_account_id",
         "destination_account_id", "merchant_id", "status", "failure_reason", "balance_after", "transaction_date",
         "transaction_time", "created_at"]


@query("c7_core_transactions", sql(f"SELECT {CORE_COLUMNS} FROM core"))
def c7(spark, sf):
    tx = b.staged_transactions(spark, sf)
    return op.core_transactions(tx, *anomaly_tables(tx), held(spark, sf)).select(*SHOWN)


@query("c7_core_from_route", sql(f"SELECT {CORE_COLUMNS} FROM core"))
def c7_route(spark, sf):
    return op.core_from_route(routed(spark, sf)).select(*SHOWN)


def repeats_ledger(spark, sf):
    """The ledger with exact repeats, and its issue rows."""
    tx = b.staged_with_repeats(spark, sf)
    accounts = b.accounts(spark, sf)
    dims = (b.staged_accounts(spark, sf), accounts, b.merchants(spark, sf), b.agencies(spark, sf))
    issues = [*anomaly_tables(tx)]
    return tx, (*issues, quarantine.quarantine(tx, issues, *dims))


@query("c7_core_keeps_first", sql(f"SELECT {CORE_COLUMNS} FROM core"))
def c7_first(spark, sf):
    tx, issues = repeats_ledger(spark, sf)
    return op.core_transactions(tx, *issues).select(*SHOWN)


@query("c7_repeats_reported", sql("""
SELECT CAST(id + 500000000 AS VARCHAR) AS staging_transaction_id, idempotency_key, id AS first_id
FROM core WHERE id % 50 = 22
"""))
def c7_repeats(spark, sf):
    tx, issues = repeats_ledger(spark, sf)
    return op.repeated_transactions(op.core_transactions(tx, *issues, drop_repeats=False))


@query("v2_core_duplicate_keys_with_repeats", sql("""
SELECT idempotency_key, 2 AS occurrences FROM core WHERE id % 50 = 22
"""))
def v2_repeats(spark, sf):
    tx, issues = repeats_ledger(spark, sf)
    return validation.core_duplicate_keys(op.core_transactions(tx, *issues, drop_repeats=False))


@query("v16_conservation_with_repeats", sql("""
SELECT COUNT(*) AS expected_core_ready, COUNT(*) AS actual_core_ready FROM core
"""))
def v16_repeats(spark, sf):
    tx, issues = repeats_ledger(spark, sf)
    reached = written(op.core_transactions(tx, *issues, drop_repeats=False), "reached")
    return validation.conservation(
        tx, op.core_transactions(tx, *issues), *issues, op.repeated_transactions(reached))


def _count(table, rule, test, sample="CAST(id AS VARCHAR)", source="core"):
    return (f"SELECT '{table}' AS table, '{rule}' AS constraint, "
            f"(SELECT COUNT(*) FROM {source} WHERE {test}) AS violations, "
            f"COALESCE((SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {sample} AS v FROM {source} "
            f"WHERE {test} ORDER BY v LIMIT 10)), '') AS samples")


def _unique(table, column, source="core"):
    keys = f"SELECT CAST({column} AS VARCHAR) AS v, COUNT(*) - 1 AS n FROM {source} GROUP BY {column} HAVING COUNT(*) > 1"
    return (f"SELECT '{table}', 'unique:{column}', CAST(COALESCE((SELECT SUM(n) FROM ({keys})), 0) AS BIGINT), "
            f"COALESCE((SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT v FROM ({keys}) ORDER BY v LIMIT 10)), '')")


REQUIRED = ["id", "reference", "idempotency_key", "transaction_type", "amount", "fee", "currency",
            "source_account_id", "status", "balance_before", "balance_after"]
TX_RULES = [_count("transactions", f"not_null:{c}", f"{c} IS NULL") for c in REQUIRED] + [
    _count("transactions", "check:amount_positive", "amount <= 0"),
    _count("transactions", "check:fee_non_negative", "fee < 0"),
    _count("transactions", "check:balance_before_non_negative", "balance_before < 0"),
    _count("transactions", "check:balance_after_non_negative", "balance_after < 0"),
    _count("transactions", "check:currency", "currency <> 'MRU'"),
    _count("transactions", "check:status", "status NOT IN ('SUCCESS', 'FAILED', 'PENDING')"),
    _count("transactions", "check:failed_balance_unchanged", "status = 'FAILED' AND balance_after <> balance_before"),
    _count("transactions", "check:completed_after_created", "completed_at < created_at"),
    _unique("transactions", "id"), _unique("transactions", "reference"), _unique("transactions", "idempotency_key"),
    _count("transactions", "foreign_key:transaction_type", "transaction_type NOT IN (SELECT code FROM tx_types)", "transaction_type"),
    _count("transactions", "foreign_key:source_account_id", "source_account_id NOT IN (SELECT id FROM accounts)", "source_account_id"),
    _count("transactions", "foreign_key:destination_account_id", "destination_account_id NOT IN (SELECT id FROM accounts)", "destination_account_id"),
    _count("transactions", "foreign_key:merchant_id", "merchant_id NOT IN (SELECT id FROM merchants)", "merchant_id"),
    _count("transactions", "foreign_key:agency_id", "agency_id NOT IN (SELECT id FROM agencies)", "agency_id"),
]


@query("c8_constraints_transactions", sql("\nUNION ALL\n".join(TX_RULES)))
def c8(spark, sf):
    parents = {"accounts": b.accounts(spark, sf), "merchants": b.merchants(spark, sf),
               "agencies": b.agencies(spark, sf), "tx_types": b.tx_types(spark, sf)}
    return table_report("transactions", written(op.core_from_route(routed(spark, sf)), "core"), parents)


DIMENSION_RULES = [
    _count("users", f"not_null:{c}", f"{c} IS NULL", source="users") for c in ("id", "nni", "phone", "wilaya_id")
] + [
    _count("users", "check:nni_format", "NOT regexp_full_match(nni, '[0-9]{10}')", source="users"),
    _count("users", "check:phone_format", r"NOT regexp_full_match(phone, '\+222[0-9]{8}')", source="users"),
    _unique("users", "id", "users"), _unique("users", "nni", "users"),
    _count("users", "foreign_key:wilaya_id", "wilaya_id NOT IN (SELECT id FROM wilayas)", source="users"),
] + [
    _count("agencies", f"not_null:{c}", f"{c} IS NULL", source="agencies") for c in ("id", "code", "wilaya_id")
] + [
    _count("agencies", "check:float_balance_non_negative", "float_balance < 0", source="agencies"),
    _unique("agencies", "id", "agencies"), _unique("agencies", "code", "agencies"),
    _count("agencies", "foreign_key:wilaya_id", "wilaya_id NOT IN (SELECT id FROM wilayas)", source="agencies"),
] + [
    _count("merchants", f"not_null:{c}", f"{c} IS NULL", source="merchants") for c in ("id", "code", "category_code", "wilaya_id")
] + [
    _unique("merchants", "id", "merchants"), _unique("merchants", "code", "merchants"),
    _count("merchants", "foreign_key:category_code", "category_code NOT IN (SELECT code FROM categories)", source="merchants"),
    _count("merchants", "foreign_key:wilaya_id", "wilaya_id NOT IN (SELECT id FROM wilayas)", source="merchants"),
]


@query("c8_constraints_dimensions", sql("\nUNION ALL\n".join(DIMENSION_RULES)))
def c8_dimensions(spark, sf):
    tables = {"users": b.users(spark, sf), "agencies": b.agencies(spark, sf), "merchants": b.merchants(spark, sf)}
    return constraint_report(tables, {"wilayas": b.wilayas(spark, sf), "categories": b.categories(spark, sf)})


# What each staged cell must be readable as, in the checking engine's own types.
READABLE = {
    **dict.fromkeys(["id", "source_account_id", "destination_account_id", "merchant_id", "agency_id", "sequence_number"], "BIGINT"),
    **dict.fromkeys(["amount", "fee", "total_amount", "balance_before", "balance_after"], "DECIMAL(14,2)"),
    "transaction_date": "DATE", "transaction_time": "TIME", "created_at": "TIMESTAMP", "completed_at": "TIMESTAMP"}


def _unreadable(column, dtype):
    return f"trim({column}) <> '' AND TRY_CAST(replace(replace({column}, 'T', ' '), 'Z', '') AS {dtype}) IS NULL"


@query("c8_cast_failures", sql("\nUNION ALL\n".join(
    _count("transactions", f"cast:{c}", _unreadable(c, t), "id", "ledger") for c, t in READABLE.items())))
def c8_casts(spark, sf):
    raw = b.staged_transactions(spark, sf)
    report = table_report("transactions", op.cast_transactions(raw), {}, raw)
    return report.where(F.col("constraint").startswith("cast:"))
