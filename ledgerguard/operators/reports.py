"""The twenty reporting queries over core tables.

Reports that group by a parent (merchant, agency, account) aggregate the transactions by
the foreign key first and join the parent afterwards: the shuffle then carries one row
per key and task, a parent that owns a third of the sales is no hot spot, and the join
sees each key once. Reports for one user or reference filter first and are one plan, built
without a job; AQE sees how few rows are left. A ledger that is asked for single users and
references often keeps a served copy, where these reports read a few row groups
(``sources/serving.py``).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import discrepancy, hour_of, month_of, week_of
from ..sources.layers import QUARTER, quarter_of


def _succeeded(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("status") == "SUCCESS")


def _average(total: Column, n: Column) -> Column:
    return total.cast("double") / n.cast("double")


def _own_accounts(accounts: DataFrame, user_id: int) -> DataFrame:
    return accounts.where(F.col("user_id") == user_id).select(
        F.col("id").alias("sa_id"), F.col("account_number").alias("source_account"))


def _of_user(tx: DataFrame, accounts: DataFrame, user_id: int) -> DataFrame:
    return tx.join(_own_accounts(accounts, user_id), F.col("source_account_id") == F.col("sa_id"))


def _with_destination(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    da = accounts.select(F.col("id").alias("da_id"), F.col("account_number").alias("destination_account"))
    return rows.join(da, F.col("destination_account_id") == F.col("da_id"), "left")


# -- one user ---------------------------------------------------------------------------

def user_history(tx: DataFrame, accounts: DataFrame, user_id: int) -> DataFrame:
    rows = _with_destination(_of_user(tx, accounts, user_id), accounts)
    return rows.orderBy(F.desc_nulls_first("created_at"), "id").select(
        "id", "reference", "transaction_type", "amount", "fee", "currency", "status",
        "balance_before", "balance_after", "transaction_date", "created_at", "source_account",
        "destination_account")


def user_history_between(
    tx: DataFrame, accounts: DataFrame, user_id: int, start: str, end: str
) -> DataFrame:
    """Both ends included. A fact laid out by quarter is read for those quarters only."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    ranged = tx.where(F.col("transaction_date").between(first, last))
    if QUARTER in tx.columns:
        ranged = ranged.where(F.col(QUARTER).between(quarter_of(first), quarter_of(last)))
    return _of_user(ranged, accounts, user_id).orderBy(
        F.desc_nulls_first("transaction_date"), "id"
    ).select("id", "reference", "transaction_type", "amount", "status", "transaction_date", "created_at")


def user_failures(tx: DataFrame, accounts: DataFrame, user_id: int) -> DataFrame:
    return _of_user(tx.where(F.col("status") == "FAILED"), accounts, user_id).orderBy(
        F.desc_nulls_first("created_at"), "id"
    ).select("id", "reference", "status", "failure_reason", "amount", "transaction_date")


def by_reference(tx: DataFrame, accounts: DataFrame, users: DataFrame, reference: str) -> DataFrame:
    """All columns of the transaction with the names of its accounts and user."""
    found = tx.where(F.col("reference") == reference)
    sa = accounts.select(
        F.col("id").alias("sa_id"), "user_id", F.col("account_number").alias("source_account"))
    owner = users.select(F.col("id").alias("owner_id"), F.col("full_name").alias("source_user"))
    rows = (
        sa.join(found, F.col("source_account_id") == F.col("sa_id"))
        .join(owner, F.col("user_id") == F.col("owner_id"))
    )
    return _with_destination(rows, accounts).select(
        *tx.columns, "source_account", "source_user", "destination_account")


# -- accounts ---------------------------------------------------------------------------

def _with_owner(accounts: DataFrame, users: DataFrame, wilayas: DataFrame, *extra: str) -> DataFrame:
    owner = users.select(F.col("id").alias("owner_id"), "full_name", "wilaya_id", *extra)
    region = wilayas.select(F.col("id").alias("region_id"), F.col("name").alias("wilaya"))
    return accounts.join(owner, F.col("user_id") == F.col("owner_id")).join(
        region, F.col("wilaya_id") == F.col("region_id"), "left")


def user_accounts(
    accounts: DataFrame, users: DataFrame, wilayas: DataFrame, user_id: int
) -> DataFrame:
    own = accounts.where(F.col("user_id") == user_id)
    owner = users.where(F.col("id") == user_id)
    return _with_owner(own, owner, wilayas, "phone").select(
        "id", "account_number", "account_type", "balance", "available_balance", "currency",
        "daily_limit", "monthly_limit", "status", "is_primary", "opened_date", "last_activity",
        "full_name", "phone", "wilaya")


def top_accounts(
    accounts: DataFrame, users: DataFrame, wilayas: DataFrame, limit: int = 20
) -> DataFrame:
    """Largest active balances. Account number breaks ties."""
    active = accounts.where(F.col("status") == "ACTIVE")
    return (
        _with_owner(active, users, wilayas)
        .orderBy(F.desc_nulls_first("balance"), "account_number")
        .limit(limit)
        .select("account_number", "account_type", "balance", "currency", "full_name", "wilaya")
    )


def low_balance(accounts: DataFrame, share: float = 0.10) -> DataFrame:
    ratio = F.try_divide(F.col("balance"), F.col("available_balance"))
    return (
        accounts.where((F.col("available_balance") > 0)
                       & (F.col("balance") < F.lit(Decimal(str(share))) * F.col("available_balance")))
        .orderBy(ratio, "id")
        .select("id", "account_number", "balance", "available_balance", "user_id")
    )


def monthly_spend(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per account and month; account numbers are unique, so the account id groups them."""
    spend = (
        _succeeded(tx)
        .groupBy("source_account_id", month_of("transaction_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_spent"),
             F.count("amount").alias("n"))
    )
    names = accounts.select(F.col("id").alias("sa_id"), "account_number")
    return (
        spend.join(names, F.col("source_account_id") == F.col("sa_id"))
        .orderBy("account_number", F.desc_nulls_first("month"))
        .select("account_number", "month", "tx_count", "total_spent",
                _average(F.col("total_spent"), F.col("n")).alias("avg_amount"))
    )


# -- merchants and agencies --------------------------------------------------------------

def _sales(tx: DataFrame, key: str) -> DataFrame:
    """Successful sales per parent: DF[parent_id, tx_count, total_volume, n]."""
    return (
        _succeeded(tx).where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("parent_id"))
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_volume"),
             F.count("amount").alias("n"))
    )


def _sum_again() -> list[Column]:
    return [F.sum("tx_count").alias("tx_count"), F.sum("total_volume").alias("total_volume"),
            F.sum("n").alias("n")]


def top_merchants(
    tx: DataFrame, merchants: DataFrame, categories: DataFrame, wilayas: DataFrame, limit: int = 20
) -> DataFrame:
    m = merchants.select("id", F.col("code"), "name", "category_code", "wilaya_id")
    c = categories.select(F.col("code").alias("c_code"), F.col("label").alias("category"))
    w = wilayas.select(F.col("id").alias("w_id"), F.col("name").alias("wilaya"))
    return (
        _sales(tx, "merchant_id").join(m, F.col("parent_id") == F.col("id"))
        .join(c, F.col("category_code") == F.col("c_code"))
        .join(w, F.col("wilaya_id") == F.col("w_id"))
        .groupBy("code", "name", "category", "wilaya").agg(*_sum_again())
        .orderBy(F.desc_nulls_first("total_volume"), "code")
        .limit(limit)
        .select("code", "name", "category", "wilaya", "tx_count", "total_volume",
                _average(F.col("total_volume"), F.col("n")).alias("avg_amount"))
    )


def merchants_by_category(tx: DataFrame, merchants: DataFrame, categories: DataFrame) -> DataFrame:
    """Grouped by code and label: labels may be empty, and then they would all fall together."""
    m = merchants.select("id", "category_code")
    c = categories.select(F.col("code").alias("category_code"), F.col("label").alias("category"))
    return (
        _sales(tx, "merchant_id").join(m, F.col("parent_id") == F.col("id"))
        .join(c, "category_code")
        .groupBy("category_code", "category")
        .agg(F.count_distinct("id").alias("merchant_count"), *_sum_again())
        .orderBy(F.desc_nulls_first("total_volume"), "category_code")
        .select("category_code", "category", "merchant_count", "tx_count", "total_volume",
                _average(F.col("total_volume"), F.col("n")).alias("avg_tx_amount"))
    )


def merchants_by_region(tx: DataFrame, merchants: DataFrame, wilayas: DataFrame) -> DataFrame:
    """Regions without sales stay, with a NULL volume, last."""
    m = merchants.select("id", "wilaya_id")
    w = wilayas.select(F.col("id").alias("w_id"), F.col("name").alias("wilaya"))
    return (
        m.join(_sales(tx, "merchant_id"), F.col("parent_id") == F.col("id"), "left")
        .join(w, F.col("wilaya_id") == F.col("w_id"))
        .groupBy("wilaya")
        .agg(F.count_distinct("id").alias("merchant_count"),
             F.coalesce(F.sum("tx_count"), F.lit(0).cast("bigint")).alias("total_transactions"),
             F.sum("total_volume").alias("total_volume"))
        .orderBy(F.desc_nulls_last("total_volume"), "wilaya")
    )


def inactive_merchants(tx: DataFrame, merchants: DataFrame, wilayas: DataFrame) -> DataFrame:
    """Merchants without any transaction; the used ids collapse before they meet them."""
    used = tx.where(F.col("merchant_id").isNotNull()).select(F.col("merchant_id").alias("used")).distinct()
    w = wilayas.select(F.col("id").alias("w_id"), F.col("name").alias("wilaya"))
    return (
        merchants.join(used, F.col("id") == F.col("used"), "left_anti")
        .join(w, F.col("wilaya_id") == F.col("w_id"))
        .select("id", "code", "name", "status", "wilaya")
    )


def agency_performance(tx: DataFrame, agencies: DataFrame, wilayas: DataFrame) -> DataFrame:
    a = agencies.select("id", "code", "name", "tier", "wilaya_id", "float_balance")
    w = wilayas.select(F.col("id").alias("w_id"), F.col("name").alias("wilaya"))
    keys = ["code", "name", "tier", "wilaya", "float_balance"]
    return (
        _sales(tx, "agency_id").join(a, F.col("parent_id") == F.col("id"))
        .join(w, F.col("wilaya_id") == F.col("w_id"))
        .groupBy(*keys).agg(*_sum_again())
        .orderBy(F.desc_nulls_first("total_volume"), "code")
        .select("code", "name", "tier", "wilaya", "tx_count", "total_volume", "float_balance")
    )


# -- time ---------------------------------------------------------------------------------

def daily_totals(tx: DataFrame) -> DataFrame:
    ok = F.col("status") == "SUCCESS"
    amount = F.when(ok, F.col("amount"))
    return (
        tx.groupBy("transaction_date")
        .agg(F.count(F.lit(1)).alias("total_tx"),
             F.count_if(ok).alias("success_count"),
             F.count_if(F.col("status") == "FAILED").alias("failed_count"),
             F.count_if(F.col("status") == "PENDING").alias("pending_count"),
             F.sum(amount).alias("total_volume"),
             _average(F.sum(amount), F.nullif(F.count(amount), F.lit(0))).alias("avg_amount"))
        .orderBy(F.desc_nulls_first("transaction_date"))
    )


def daily_by_type(tx: DataFrame) -> DataFrame:
    return (
        _succeeded(tx)
        .groupBy("transaction_date", F.col("transaction_type").alias("tx_type"))
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("volume"))
        .orderBy(F.desc_nulls_first("transaction_date"), F.desc_nulls_first("volume"), "tx_type")
    )


def weekly_summary(tx: DataFrame) -> DataFrame:
    """Count, volume and distinct active accounts per week.

    Rows collapse to (week, account) first, so the distinct count is a count of rows and
    no row is copied for it.
    """
    per_account = (
        _succeeded(tx)
        .groupBy(week_of("transaction_date").alias("week_start"), "source_account_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("volume"))
    )
    return (
        per_account.groupBy("week_start")
        .agg(F.sum("n").alias("total_tx"), F.sum("volume").alias("total_volume"),
             F.count("source_account_id").alias("active_accounts"))
        .orderBy(F.desc_nulls_first("week_start"))
    )


def hourly_distribution(tx: DataFrame, hour: Column | None = None) -> DataFrame:
    """By the hour of ``transaction_time`` text, or of another expression."""
    hour = hour_of("transaction_time") if hour is None else hour
    return (
        _succeeded(tx).groupBy(hour.cast("bigint").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("volume"))
        .orderBy(F.asc_nulls_last("hour_of_day"))
    )


# -- business rules -------------------------------------------------------------------------

def balance_violations(
    tx: DataFrame, tolerance: float = 1, types: Sequence[str] | None = None
) -> DataFrame:
    """Successful rows whose closing balance is off by more than the tolerance."""
    rows = _succeeded(tx)
    if types is not None:
        rows = rows.where(F.col("transaction_type").isin(list(types)))
    off = discrepancy("balance_before", "amount", "fee", "balance_after")
    return (
        rows.select(
            "id", "reference", "amount", "fee", "balance_before", "balance_after",
            (F.col("balance_before") - F.col("amount") - F.col("fee")).alias("expected_balance_after"),
            off.alias("discrepancy"))
        .where(F.col("discrepancy") > tolerance)
        .orderBy(F.desc_nulls_first("discrepancy"), "id")
    )


def duplicate_keys(tx: DataFrame, key: str = "idempotency_key") -> DataFrame:
    return (
        tx.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .orderBy(F.desc("occurrences"), key)
    )


def failed_balance_moves(tx: DataFrame) -> DataFrame:
    delta = F.col("balance_after") - F.col("balance_before")
    return (
        tx.where((F.col("status") == "FAILED") & (F.col("balance_after") != F.col("balance_before")))
        .select("id", "reference", "status", "balance_before", "balance_after", delta.alias("balance_delta"))
        .orderBy(F.desc_nulls_first(F.abs("balance_delta")), "id")
    )
