"""Transaction rules: row invariants, first-seen comparisons and sequence gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import squeeze, to_number, to_time
from ..schemas import STATUSES
from .checks import Check
from .skew import sole_rows, tally


def _text(column: str) -> Column:
    return F.nullif(squeeze(F.col(column).cast("string")), F.lit(""))


# -- row rules: run any number of them in one scan with ``run_checks`` -----------------

def failed_balance_rule(
    status: str = "status", before: str = "balance_before", after: str = "balance_after", id: str = "id",
) -> Check:
    """FAILED must leave the balance as it was; numeric, unparseable values are skipped,
    and NaN is no balance that stayed the same."""
    b, a = to_number(F.col(before).cast("string")), to_number(F.col(after).cast("string"))
    return Check(
        "FAILED => balance_before == balance_after",
        (_text(status) == "FAILED") & ((b != a) | (F.isnan(b) & F.isnan(a))),
        F.col(id))


def sign_rule(column: str, allow_zero: bool, id: str = "id") -> Check:
    """>= 0 or > 0; unparseable values are skipped (the format check counts them)."""
    v = to_number(F.col(column).cast("string"))
    return Check(
        f"{column} must be {'>= 0' if allow_zero else '> 0'}",
        v < 0 if allow_zero else v <= 0,
        F.col(id))


def date_order_rule(
    created: str = "created_at", completed: str = "completed_at", id: str = "id"
) -> Check:
    return Check(
        f"{completed} >= {created}",
        to_time(F.col(completed).cast("string"), day_first=False)
        < to_time(F.col(created).cast("string"), day_first=False),
        F.col(id))


def status_rule(status: str = "status", values: Sequence[str] = STATUSES, id: str = "id") -> Check:
    v = _text(status)
    return Check(
        "status must be one of allowed values",
        v.isNotNull() & ~v.isin(list(values)),
        F.concat_ws(":", F.col(id).cast("string"), v))


def columns_differ_rule(first: str, second: str, id: str = "id") -> Check:
    """Both present and not the same; informational."""
    return Check(f"{first} != {second}", _text(first) != _text(second), F.col(id))


def available_over_balance_rule(
    available: str = "available_balance", balance: str = "balance", id: str = "id"
) -> Check:
    return Check(
        f"{available} <= {balance}",
        to_number(F.col(available).cast("string")) > to_number(F.col(balance).cast("string")),
        F.col(id))


# -- first-seen rules ------------------------------------------------------------------

def differs_from_first(
    df: DataFrame, key: str, payload: Sequence[str], order: Sequence[Column | str], rule: str
) -> DataFrame:
    """Rows whose payload differs from that of the first row with the same key.

    Two aggregations and no window: rows collapse to (key, payload) with their count and
    first position; per key, all rows less those that share the payload of the earliest
    position are the differing ones. A hot key is pre-aggregated in every task.
    ``order`` must be unique per row.
    """
    position = F.struct(*[F.col(c).alias(f"o{i}") if isinstance(c, str) else c.alias(f"o{i}")
                          for i, c in enumerate(order)])
    rows = df.select(
        _text(key).alias("key"),
        *[F.coalesce(squeeze(F.col(c).cast("string")), F.lit("")).alias(f"p{i}")
          for i, c in enumerate(payload)],
        position.alias("pos"),
    ).where(F.col("key").isNotNull())
    variants = rows.groupBy("key", *[f"p{i}" for i in range(len(payload))]).agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    per_key = variants.groupBy("key").agg(
        (F.sum("n") - F.min_by("n", "pos")).alias("n")).where(F.col("n") > 0)
    named = per_key.withColumn("rule", F.lit(rule))
    return tally(named, ["rule"], "key", "n", sole_rows([rule], df.sparkSession))


def idempotency_payload_rule(df: DataFrame, order, key="idempotency_key", amount="amount", status="status") -> DataFrame:
    return differs_from_first(
        df, key, [amount, status], order, "same idempotency_key with different payload")


def reference_amount_rule(df: DataFrame, order, reference="reference", amount="amount") -> DataFrame:
    return differs_from_first(
        df, reference, [amount], order, "same reference with different amount")


# -- sequences ---------------------------------------------------------------------------

WORD, WORDS = 64, 16              # numbers of a coverage word, words of a block
SPANS = (10, 28, 46, 64)          # bits of a number within a block and within each wider span


def _coverage(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """One row per key and block of 1,024 numbers: which of them occur, as 16 words of bits.
    Partial aggregation turns a run of rows into one, so repeats and hot keys stay small."""
    rows = df.where(F.col(sequence).isNotNull()).select(
        F.col(key).alias("key"), F.col(sequence).cast("bigint").alias("seq"))
    at = F.shiftright("seq", 6).bitwiseAND(WORDS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("seq").bitwiseAND(WORD - 1).cast("int"))
    return rows.groupBy("key", F.shiftright("seq", SPANS[0]).alias("block")).agg(*[
        F.bit_or(F.when(at == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{i}") for i in range(WORDS)])


def _neighbours(spans: Column) -> Column:
    """Of sorted (first, last) spans: the (previous, next) ends that leave a gap."""
    pairs = F.arrays_zip(
        F.slice(spans, F.lit(1), F.size(spans) - 1).alias("a"), F.slice(spans, F.lit(2), F.size(spans) - 1).alias("b"))
    ends = F.transform(pairs, lambda p: F.struct(p["a"]["last"].alias("previous"), p["b"]["first"].alias("seq")))
    return F.filter(ends, lambda e: e["seq"] - e["previous"] > 1)


def sequence_gaps(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """Missing numbers between neighbours of a per-key sequence: one row per gap.

    Numbers become coverage bitmaps of blocks, in one shuffle of some 16 bytes per 100
    numbers that follow one another; repeats vanish there. Gaps inside a block come from its bits; a
    full block has none and is not unpacked. A block sends its first and last number on,
    blocks are gathered into spans of 2**28 numbers, those into spans of 2**46, and those
    per key: each array holds 2**18 spans at most, so a key with all the rows, or with
    numbers far apart, meets in no single task. Nothing is sorted and no job runs ahead.
    """
    words = [F.col(f"w{i}") for i in range(WORDS)]
    full = F.lit(True)
    for w in words:
        full = full & (w == -1)
    base = F.shiftleft("block", SPANS[0])
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def singles(i: int, w: Column) -> Column:
        """The numbers of a word, as spans of one."""
        here = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.call_function("shiftright", w, b).bitwiseAND(1) == 1)
        at = F.transform(here, lambda b: base + F.lit(i * WORD) + b)
        return F.when(w == 0, none).otherwise(F.transform(at, lambda x: F.struct(x.alias("first"), x.alias("last"))))

    numbers = F.flatten(F.array(*[singles(i, w) for i, w in enumerate(words)]))
    whole = F.array(F.struct(base.alias("first"), (base + (1 << SPANS[0]) - 1).alias("last")))
    level = _coverage(df, key, sequence).select("key", F.when(full, whole).otherwise(numbers).alias("spans"))
    gaps = None
    for bits in SPANS[1:]:
        found = level.select("key", F.explode(_neighbours(F.col("spans"))).alias("gap"))
        gaps = found if gaps is None else gaps.unionByName(found)
        ends = level.select("key", F.get("spans", F.lit(0))["first"].alias("first"), F.element_at("spans", -1)["last"].alias("last"))
        wide = F.shiftright("first", bits) if bits < 64 else F.lit(0).cast("bigint")
        level = ends.groupBy("key", wide.alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans")).select("key", "spans")
    gaps = gaps.unionByName(level.select("key", F.explode(_neighbours(F.col("spans"))).alias("gap")))
    return gaps.select(
        F.col("key").alias(key), F.col("gap.previous").alias("previous"), F.col("gap.seq").alias(sequence),
        (F.col("gap.seq") - F.col("gap.previous") - 1).alias("missing"))
