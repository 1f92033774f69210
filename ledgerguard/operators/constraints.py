"""The constraint report: what core promises, counted instead of enforced."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import cast_failed
from ..schemas import CONSTRAINTS, CORE_TYPES, TableRules
from .skew import rule_hits, sole_rows, tally


class ConstraintError(AssertionError):
    """A strict report found a violation."""


def _row_hits(df: DataFrame, rules: TableRules, sample: str) -> DataFrame:
    """NOT NULL and CHECK of one table in one scan. As in SQL, a CHECK that is NULL holds."""
    show = F.col(sample).cast("string")
    tests = [(f"not_null:{c}", F.col(c).isNull(), show) for c in rules.required if c in df.columns]
    tests += [(f"check:{n}", ~F.expr(e), show) for n, e in rules.checks.items()]
    return rule_hits(df, tests).withColumn("n", F.lit(1).cast("bigint"))


def _key_hits(df: DataFrame, rules: TableRules, parents: Mapping[str, DataFrame]) -> DataFrame:
    """UNIQUE and FOREIGN KEY of one table.

    Each row gives one (rule, value) per key column. Values are counted before anything
    is joined, so a hot key collapses on the map side and meets its parent once. All
    parents form one side of one anti join, tagged by table. The two kinds of rules read
    the table by themselves, each with its own columns.
    """
    cells = [(f"unique:{c}", c, "") for c in rules.unique]
    cells += [(f"foreign_key:{c}", c, f"{parent}.{key}")
              for c, (parent, key) in _checked_parents(df, rules, parents).items()]
    values = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.lit(p).alias("parent"), F.col(c).cast("string").alias("sample"))
            for r, c, p in cells])).alias("cell"))
        .select("cell.*")
        .where(F.col("sample").isNotNull())
        .groupBy("rule", "parent", "sample")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    repeats = values.where((F.col("parent") == "") & (F.col("n") > 1)).select(
        "rule", "sample", (F.col("n") - 1).alias("n"))
    known = None
    for parent, key in sorted(set(_checked_parents(df, rules, parents).values())):
        part = parents[parent].select(
            F.lit(f"{parent}.{key}").alias("parent"), F.col(key).cast("string").alias("sample"))
        known = part if known is None else known.unionByName(part)
    if known is None:
        return repeats
    orphans = values.where(F.col("parent") != "").join(known, ["parent", "sample"], "left_anti")
    return repeats.unionByName(orphans.select("rule", "sample", "n"))


def _checked_parents(df, rules: TableRules, parents) -> dict[str, tuple[str, str]]:
    return {c: p for c, p in rules.parents.items() if c in df.columns and p[0] in parents}


def _cast_columns(raw: DataFrame, types: Mapping[str, str]) -> list[str]:
    return [c for c, t in types.items() if t not in ("string", "boolean") and c in raw.columns]


def cast_hits(raw: DataFrame, types: Mapping[str, str], sample: str = "id") -> DataFrame:
    """Text cells of staging that do not convert to their core type."""
    tests = [(f"cast:{c}", cast_failed(c, types[c]), F.col(sample)) for c in _cast_columns(raw, types)]
    return rule_hits(raw, tests).withColumn("n", F.lit(1).cast("bigint"))


def table_report(
    table: str, df: DataFrame, parents: Mapping[str, DataFrame], raw: DataFrame | None = None,
    rules: TableRules | None = None, sample: str = "id",
) -> DataFrame:
    """DF[table, constraint, violations, samples] of one table, kept constraints included.

    ``parents`` maps table names to typed frames; foreign keys to a parent that is not
    given are left out. ``raw`` adds the cast failures of its staging table. The table is
    read several times, so give a stored one rather than a long plan.
    """
    rules = rules or CONSTRAINTS[table]
    types = CORE_TYPES.get(table, {})
    hits = _row_hits(df, rules, sample).unionByName(_key_hits(df, rules, parents))
    names = [f"not_null:{c}" for c in rules.required if c in df.columns]
    names += [f"check:{n}" for n in rules.checks]
    names += [f"unique:{c}" for c in rules.unique]
    names += [f"foreign_key:{c}" for c in _checked_parents(df, rules, parents)]
    if raw is not None:
        hits = hits.unionByName(cast_hits(raw, types))
        names += [f"cast:{c}" for c in _cast_columns(raw, types)]
    report = tally(hits, ["rule"], "sample", "n", sole_rows(names, df.sparkSession))
    return report.select(
        F.lit(table).alias("table"), F.col("rule").alias("constraint"),
        F.col("count").alias("violations"), "samples")


def constraint_report(
    tables: Mapping[str, DataFrame], lookups: Mapping[str, DataFrame] | None = None,
    raw: Mapping[str, DataFrame] | None = None, strict: bool = False,
) -> DataFrame:
    """The report over several core tables; ``strict`` raises if anything is violated."""
    parents = {**(lookups or {}), **tables}
    report = None
    for table, df in tables.items():
        part = table_report(table, df, parents, (raw or {}).get(table))
        report = part if report is None else report.unionByName(part)
    if strict:
        raise_violations(report)
    return report


def raise_violations(report: DataFrame) -> None:
    """Stop on the first violation of a report, which should be a stored one."""
    first = report.where("violations > 0").limit(1).collect()
    if first:
        raise ConstraintError(f"{first[0]['table']}: {first[0]['constraint']} "
                              f"violated {first[0]['violations']} times")
