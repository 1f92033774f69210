"""Validation of layers and issue tables: counts, overlaps, completeness, conservation.

Frames of issues have ``staging_transaction_id``; they may be stored tables or plans.
Nothing here joins issues to issues row by row: both sides collapse per id first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.clean import blank, elapsed_seconds, empty_to_null, label_by, present
from ..schemas import BAD_PREFIX
from .quarantine import known_ids, with_match
from .reports import duplicate_keys, failed_balance_moves
from .skew import flag, lookup_join

ID = "staging_transaction_id"


# -- counts -----------------------------------------------------------------------------

def row_counts(tables: Mapping[str, DataFrame], name: str = "layer", rows: str = "rows") -> DataFrame:
    """One row per table; an empty table counts zero. Every count is its own small
    aggregate, which Parquet answers from footers."""
    out = None
    for table, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias(rows)).select(F.lit(table).alias(name), rows)
        out = part if out is None else out.unionByName(part)
    return out


def side_by_side(counts: DataFrame, names: Sequence[str], name: str, value: str) -> DataFrame:
    """A few (name, value) rows as one row with a column per name."""
    return counts.agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def global_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return side_by_side(row_counts(tables, "t", "n"), list(tables), "t", "n")


def expected_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    counts = row_counts(tables, "table_name", "actual_rows")
    labels = {t: str(n) for t, n in expected.items()}
    return counts.withColumn(
        "expected_rows", empty_to_null(label_by("table_name", labels)).cast("bigint"))


def all_loaded(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One boolean per table: has a row. Reads one row of each."""
    firsts = row_counts({t: df.limit(1) for t, df in tables.items()}, "t", "n")
    row = side_by_side(firsts, list(tables), "t", "n")
    return row.select(*[(F.col(t) > 0).alias(f"{t}_loaded") for t in tables])


def table_summary(tables: Mapping[str, DataFrame], labels: Mapping[str, str]) -> DataFrame:
    """Exact row counts, largest first, each with the label of what was expected."""
    return (
        row_counts(tables, "table_name", "row_count")
        .withColumn("expected", label_by("table_name", labels))
        .orderBy(F.desc("row_count"), "table_name")
    )


def status_distribution(tx: DataFrame) -> DataFrame:
    """Rows and share per status; the total runs over the grouped rows only."""
    counts = tx.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "status", "count",
        F.round(F.col("count").cast("double") * 100 / total.cast("double"), 2).alias("pct"),
    ).orderBy(F.desc("count"), "status")


def layer_shares(tables: Mapping[str, DataFrame], base: str) -> DataFrame:
    """Rows per layer and their share of one layer, from the real counts."""
    counts = row_counts(tables)
    total = F.max(F.when(F.col("layer") == base, F.col("rows"))).over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "layer", "rows",
        F.round(F.col("rows").cast("double") * 100 / total.cast("double"), 2).alias("pct"))


def bad_rows(df: DataFrame, test: Column, name: str = "bad_rows") -> DataFrame:
    return df.agg(F.count_if(flag(test)).alias(name))


def non_positive_amounts(tx: DataFrame, amount: str = "amount") -> DataFrame:
    return bad_rows(tx, F.col(amount) <= 0)


def negative_balances(tx: DataFrame, *balances: str) -> DataFrame:
    test = F.lit(False)
    for c in balances or ("balance_before", "balance_after"):
        test = test | flag(F.col(c) < 0)
    return bad_rows(tx, test)


def violation_counts(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts in one row and one scan."""
    return df.agg(*[F.count_if(flag(t)).alias(n) for n, t in tests.items()])


def repeated_value_count(df: DataFrame, column: str, check_name: str, as_name: str) -> DataFrame:
    """How many non-empty values occur more than once."""
    repeated = (
        df.where(present(column)).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return repeated.agg(F.count(F.lit(1)).alias(as_name)).select(F.lit(check_name).alias("check_name"), as_name)


def worker_stats(df: DataFrame, worker: str, at: str) -> DataFrame:
    """Rows, first, last and seconds between them, per worker."""
    return (
        df.groupBy(worker)
        .agg(F.count(F.lit(1)).alias("rows_inserted"), F.min(at).alias("first_insert"),
             F.max(at).alias("last_insert"))
        .withColumn("duration_seconds", elapsed_seconds("first_insert", "last_insert"))
        .orderBy(worker)
    )


def still_bad_prefix(df: DataFrame, name: str = "name", bad: str = BAD_PREFIX) -> DataFrame:
    return bad_rows(df, F.col(name).startswith(bad), "still_broken")


def integrity_counts(tx: DataFrame) -> DataFrame:
    """Four counts that must be zero, stacked: two scans in all, one of them pre-aggregated."""
    moved = (F.col("status") == "FAILED") & (F.col("balance_after") != F.col("balance_before"))
    tests = {
        "B: FAILED with balance change": moved,
        "C: negative amount": F.col("amount") <= 0,
        "D: negative balance_after": F.col("balance_after") < 0,
    }
    by_row = violation_counts(tx, tests).unpivot([], [F.col(f"`{n}`") for n in tests], "check_name", "bad_rows")
    keys = duplicate_keys(tx).agg(F.count(F.lit(1)).alias("bad_rows"))
    return keys.select(F.lit("A: duplicate idempotency").alias("check_name"), "bad_rows").unionByName(by_row)


# Two checks are the reports of the same name, run on core.
core_duplicate_keys = duplicate_keys
core_failed_moves = failed_balance_moves


# -- issue tables -----------------------------------------------------------------------

def issue_counts(issues: DataFrame, code: str) -> DataFrame:
    return issues.groupBy(code).agg(F.count(F.lit(1)).alias("total")).orderBy(code)


def _per_id(df: DataFrame, id: str, n: str) -> DataFrame:
    return df.where(F.col(id).isNotNull()).groupBy(F.col(id).cast("string").alias("id")).agg(
        F.count(F.lit(1)).alias(n))


def overlap(left: DataFrame, right: DataFrame, name: str = "overlap", left_id: str = ID, right_id: str = ID) -> DataFrame:
    """Pairs of rows with the same id, counted as a product of per-id counts."""
    pairs = _per_id(left, left_id, "l").join(_per_id(right, right_id, "r"), "id")
    return pairs.agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0).cast("bigint")).alias(name))


def repeated_issues(issues: DataFrame) -> DataFrame:
    """Transactions with several rows in one issue table."""
    return (
        issues.groupBy(ID).agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where("duplicate_count > 1")
        .orderBy(F.desc("duplicate_count"), ID)
    )


def unclassified(
    tx: DataFrame, test: Column, issues: DataFrame, code_column: str, code: str, name: str
) -> DataFrame:
    """Rows that break a rule and have no issue row with its code; must be zero."""
    seen = issues.where((F.col(code_column) == code) & F.col(ID).isNotNull()).select(
        F.col(ID).alias("_seen")).distinct()
    left = lookup_join(tx.where(flag(test)).select("id"), seen, "id", "_seen", "left_anti")
    return left.agg(F.count(F.lit(1)).alias(name))


def unquarantined(
    tx: DataFrame, accounts: DataFrame, column: str, reason: str, quarantine: DataFrame,
    anomalies: Sequence[DataFrame], name: str,
) -> DataFrame:
    """Rows with an unresolved account, not anomalous and not quarantined for it; must be zero."""
    rows = with_match(tx.select("id", column), column, known_ids(accounts), "acc", False).where(
        blank(column) | F.col("acc_hit").isNull()).select("id")
    seen = quarantine.where(F.col("reject_reason") == reason).select(F.col(ID).alias("_seen"))
    for frame in anomalies:
        seen = seen.unionByName(frame.select(F.col(ID).alias("_seen")))
    seen = seen.where(F.col("_seen").isNotNull()).distinct()
    return lookup_join(rows, seen, "id", "_seen", "left_anti").agg(F.count(F.lit(1)).alias(name))


def sample_issues(tx: DataFrame, test: Column, issues: DataFrame, limit: int = 10) -> DataFrame:
    """The first few broken rows by id, next to their issue."""
    found = issues.select(F.col(ID).alias("_seen"), "anomaly_type")
    return (
        tx.where(flag(test)).select("id", "amount")
        .join(found, F.col("id") == F.col("_seen"))
        .orderBy("id", "anomaly_type")
        .limit(limit)
        .select("id", "amount", "anomaly_type")
    )


def core_overlaps(core: DataFrame, issues: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of core in each issue table; all must be zero."""
    out = None
    for name, frame in issues.items():
        part = overlap(core, frame, "rows", left_id="id").select(F.lit(name).alias("issue_table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def conservation(tx: DataFrame, core: DataFrame, *issues: DataFrame) -> DataFrame:
    """Staged rows less the distinct excluded ids against the rows of core."""
    excluded = None
    for frame in issues:
        part = frame.select(F.col(ID).alias("id"))
        excluded = part if excluded is None else excluded.unionByName(part)
    tables = {"staged": tx, "excluded": excluded.distinct(), "core": core}
    row = global_counts(tables)
    return row.select(
        (F.col("staged") - F.col("excluded")).alias("expected_core_ready"),
        F.col("core").alias("actual_core_ready"))
