"""Format, reference, pair and orphan checks; each gives (rule, count, samples).

Row checks over one frame share a single scan. Checks against a parent count the
values first and look up each distinct value once, so no join ever sees a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import NNI, PHONE, squeeze, to_number, to_time
from .skew import rule_hits, sole_rows, tally


@dataclass(frozen=True)
class Check:
    """A named test that is true for a broken row, and what to show of that row."""

    rule: str
    test: Column
    sample: Column


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in one scan: DF[rule, count, samples]; a kept rule reports zero."""
    hits = rule_hits(df, [(c.rule, c.test, c.sample) for c in checks])
    rules = sole_rows([c.rule for c in checks], df.sparkSession)
    return tally(hits, ["rule"], "sample", rules=rules)


def _text(column: str) -> Column:
    """Trimmed text; empty becomes NULL, which no check counts."""
    return F.nullif(squeeze(F.col(column).cast("string")), F.lit(""))


def regex_check(column: str, pattern: str, rule: str) -> Check:
    v = _text(column)
    return Check(rule, v.isNotNull() & ~v.rlike(pattern), v)


def phone_check(column: str = "phone") -> Check:
    return regex_check(column, PHONE, "phone must match +222XXXXXXXX")


def nni_check(column: str = "nni") -> Check:
    return regex_check(column, NNI, "nni must be 10 digits")


def positive_check(column: str, rule: str) -> Check:
    """Above zero; text that is not a number breaks it."""
    v = _text(column)
    return Check(rule, v.isNotNull() & F.coalesce(to_number(v) <= 0, F.lit(True)), v)


def non_negative_check(column: str, rule: str) -> Check:
    v = _text(column)
    return Check(rule, v.isNotNull() & F.coalesce(to_number(v) < 0, F.lit(True)), v)


def date_check(column: str, rule: str) -> Check:
    v = _text(column)
    return Check(rule, v.isNotNull() & to_time(v).isNull(), v)


def enum_check(column: str, values: Sequence[str], rule: str) -> Check:
    v = _text(column)
    return Check(rule, v.isNotNull() & ~v.isin(list(values)), v)


# -- checks against another frame ----------------------------------------------------

def _counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.select(_text(column).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _unmatched(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    known = parent.select(_text(parent_column).alias("value")).where(F.col("value").isNotNull())
    return _counts(df, column).join(known, "value", "left_anti")


def _labelled(report: DataFrame, **labels: str) -> DataFrame:
    return report.select(*[F.lit(v).alias(k) for k, v in labels.items()], "count", "samples")


def _report(hits: DataFrame, rule: str, sample: str) -> DataFrame:
    named = hits.withColumn("rule", F.lit(rule))
    return tally(named, ["rule"], sample, "n", sole_rows([rule], hits.sparkSession))


def check_in_reference(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str,
    dataset: str = "", reference_name: str = "",
) -> DataFrame:
    """Non-empty values that the reference column does not hold."""
    hits = _unmatched(df, column, reference, reference_column)
    return _labelled(
        _report(hits, "reference", "value"),
        dataset=dataset, column=column, reference_set=reference_name or reference_column)


def check_orphans(
    df: DataFrame, column: str, parent: DataFrame, key: str, dataset: str = "", target: str = "",
) -> DataFrame:
    """Non-empty references without a parent row."""
    hits = _unmatched(df, column, parent, key)
    return _labelled(
        _report(hits, "orphan", "value"), dataset=dataset, column=column, target=target or key)


def check_pair(
    df: DataFrame, id_column: str, name_column: str, reference: DataFrame, reference_id: str,
    reference_name: str, dataset: str = "", reference_set: str = "",
) -> DataFrame:
    """(id, name) pairs that disagree with the lookup; ids it does not know are skipped.
    If the lookup repeats an id, its greatest name counts."""
    pairs = (
        df.select(_text(id_column).alias("id"), _text(name_column).alias("name"))
        .where(F.col("id").isNotNull() & F.col("name").isNotNull())
        .groupBy("id", "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    expected = (
        reference.select(_text(reference_id).alias("id"), _text(reference_name).alias("expected"))
        .where(F.col("id").isNotNull() & F.col("expected").isNotNull())
        .groupBy("id")
        .agg(F.max("expected").alias("expected"))
    )
    hits = pairs.join(expected, "id").where(F.col("expected") != F.col("name")).select(
        F.concat(F.col("id"), F.lit(" => expected="), F.col("expected"),
                 F.lit(", got="), F.col("name")).alias("value"),
        "n",
    )
    return _labelled(
        _report(hits, "pair", "value"),
        dataset=dataset, id_column=id_column, name_column=name_column,
        reference_set=reference_set or reference_id)
