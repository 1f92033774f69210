"""A served copy of the transactions, laid out for questions about one user or reference.

The copy carries the names that point reports show (account numbers, owner), so that they
need no join, and is clustered by owner inside a quarter. A question about a user skips all
row groups but a few by their least and greatest owner; one about a reference or an id skips
them by Bloom filters. That stands in for the indexes of a database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.skew import lookup_join
from .layers import QUARTER, quarter_of

OWNER = "source_user_id"
FILTERED = ("reference", "id")       # columns with Bloom filters
ROWS_A_FILE = 2_000_000              # bounds files, whatever a quarter holds
GROUP_BYTES = 16 << 20               # of a row group: what a question reads at least


def served(tx: DataFrame, accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions with the numbers of their accounts and the owner of the source account.
    Accounts or owners that are not found leave nulls; no row goes."""
    names = users.select(F.col("id").alias("_owner"), F.col("full_name").alias("source_user"), F.lit(True).alias("owner_known"))
    source = lookup_join(accounts.select(
        F.col("id").alias("_source"), F.col("user_id").alias(OWNER), F.col("account_number").alias("source_account")),
        names, OWNER, "_owner").drop("_owner")
    target = accounts.select(F.col("id").alias("_target"), F.col("account_number").alias("destination_account"))
    rows = lookup_join(tx, source, "source_account_id", "_source").drop("_source")
    return lookup_join(rows, target, "destination_account_id", "_target").drop("_target")


def write_served(rows: DataFrame, path: str, date_col: str = "transaction_date", group_bytes: int = GROUP_BYTES) -> None:
    """Store a served copy: by quarter, in ranges of owners, sorted by owner. An owner with
    a large share of a quarter fills several ranges, because the id is part of their order."""
    laid = rows.withColumn(QUARTER, quarter_of(F.col(date_col))).repartitionByRange(QUARTER, OWNER, "id")
    out = laid.sortWithinPartitions(QUARTER, OWNER, "id").write.mode("overwrite").partitionBy(QUARTER)
    out = out.option("parquet.block.size", group_bytes).option("maxRecordsPerFile", ROWS_A_FILE)
    for column in FILTERED:
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
    out.parquet(path)


def read_served(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _days(start: str, end: str) -> Column:
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return F.col("transaction_date").between(first, last) & F.col(QUARTER).between(quarter_of(first), quarter_of(last))


def history(rows: DataFrame, user_id: int, start: str | None = None, end: str | None = None) -> DataFrame:
    """All transactions of one user, newest first; within days if both are given, and then
    only those quarters are opened."""
    own = rows.where(F.col(OWNER) == user_id)
    if start is not None and end is not None:
        own = own.where(_days(start, end))
    return own.orderBy(F.desc_nulls_first("created_at"), "id").drop(QUARTER, OWNER, "source_user", "owner_known")


def failures(rows: DataFrame, user_id: int) -> DataFrame:
    """Failed transactions of one user, newest first."""
    return history(rows.where(F.col("status") == "FAILED"), user_id).select(
        "id", "reference", "status", "failure_reason", "amount", "transaction_date")


def of_reference(rows: DataFrame, reference: str) -> DataFrame:
    """Transactions of one reference whose owner is known, with all names."""
    return rows.where((F.col("reference") == reference) & F.col("owner_known")).drop(QUARTER, OWNER, "owner_known")
