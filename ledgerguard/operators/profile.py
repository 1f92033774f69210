"""Column profiles, type inference and duplicate checks over all-text frames.

All three read one table of value counts: (column, value, n). It is the only wide
shuffle, a hot value costs one row per task in it, and the regular expressions of type
inference run once per distinct value instead of once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.clean import squeeze, to_integer, to_number, to_time


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) for the trimmed text of each column; empty cells have value ''."""
    columns = list(columns or df.columns)
    cells = df.select(*[
        F.coalesce(squeeze(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c) for c in columns
    ]).unpivot([], columns, "column", "value")
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def inferred_type(value: Column | str) -> Column:
    """Aggregate: the narrowest label that fits every non-empty value."""
    v = F.col(value) if isinstance(value, str) else value
    filled = v != ""

    def every(test: Column) -> Column:
        return F.bool_and(F.when(filled, test.isNotNull()))

    return (
        F.when(F.count_if(filled) == 0, "empty")
        .when(every(to_integer(v)), "integer")
        .when(every(to_number(v)), "float")
        .when(every(to_time(v)), "date/datetime")
        .otherwise("string")
    )


def _filled() -> Column:
    """The value is not empty. Names the count as well, so that Catalyst leaves the filter
    above the aggregation and the value counts are shuffled once for all their readers."""
    return F.when(F.col("n") > 0, F.col("value")) != ""


def _smallest(counts: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` smallest values per column, as an array bounded by ``keep``."""
    rank = Window.partitionBy("column").orderBy("value")
    return (
        counts.withColumn("_rank", F.row_number().over(rank))
        .where(F.col("_rank") <= keep)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("values"))
    )


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The trimmed text of each column; empty cells are ''."""
    return df.select(*[
        F.coalesce(squeeze(F.col(f"`{c}`").cast("string")), F.lit("")).alias(f"c{i}") for i, c in enumerate(columns)])


def _by_column(row: DataFrame, columns: Sequence[str], *names: str) -> DataFrame:
    """One wide row (``<name><i>`` for column i) as one row per column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names])
                      for i, c in enumerate(columns)])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def approximate_profile(df: DataFrame, columns: Sequence[str] | None = None, error: float = 0.05) -> DataFrame:
    """The profile of wide tables: one scan, one row per task, no value is shuffled.

    ``distinct_count`` is a sketch's estimate with the given relative error; all else but
    the examples, which are left out, is exact."""
    columns = list(columns or df.columns)
    wide = []
    for i in range(len(columns)):
        value = F.nullif(F.col(f"c{i}"), F.lit(""))
        wide += [
            F.count(F.lit(1)).alias(f"row_count{i}"), F.count_if(value.isNull()).alias(f"empty_count{i}"),
            F.approx_count_distinct(value, error).alias(f"distinct_count{i}"),
            inferred_type(f"c{i}").alias(f"inferred_type{i}"),
            F.coalesce(F.min(value), F.lit("")).alias(f"min{i}"), F.coalesce(F.max(value), F.lit("")).alias(f"max{i}")]
    stats = _by_column(_cells(df, columns).agg(*wide), columns, "row_count", "empty_count", "distinct_count",
                       "inferred_type", "min", "max")
    return stats.withColumn(
        "empty_pct", F.try_divide(F.col("empty_count").cast("double") * 100, F.col("row_count").cast("double")))


# -- profiles that add up ------------------------------------------------------------------

SKETCH_BITS = 14  # registers of a distinct-count sketch, as a power of two: 0.8 % error


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """What a part of a table adds to its profile, one row per column: DF[column, row_count,
    empty_count, distinct, integers, numbers, times, min, max].

    ``distinct`` is a mergeable sketch; ``integers``, ``numbers`` and ``times`` say whether
    every filled cell reads as one. Store the rows of each batch and give them all to
    ``merged_profile``: a growing table is never read again. One scan; a task sends one row.
    """
    columns = list(columns or df.columns)
    wide = []
    for i in range(len(columns)):
        cell = F.col(f"c{i}")
        value = F.nullif(cell, F.lit(""))
        tests = {"integers": to_integer(cell), "numbers": to_number(cell), "times": to_time(cell)}
        wide += [
            F.count(F.lit(1)).alias(f"row_count{i}"), F.count_if(value.isNull()).alias(f"empty_count{i}"),
            F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"distinct{i}"),
            *[F.bool_and(F.when(value.isNotNull(), t.isNotNull())).alias(f"{n}{i}") for n, t in tests.items()],
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}")]
    return _by_column(_cells(df, columns).agg(*wide), columns, "row_count", "empty_count", "distinct", "integers", "numbers",
                      "times", "min", "max")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of everything that was sketched. Distinct counts are estimates; all else
    is exact, and equal however the table was cut into parts."""
    every = {n: F.bool_and(n) for n in ("integers", "numbers", "times")}
    kind = F.when(F.sum("row_count") == F.sum("empty_count"), "empty")
    for name, label in (("integers", "integer"), ("numbers", "float"), ("times", "date/datetime")):
        kind = kind.when(every[name], label)
    stats = sketches.groupBy("column").agg(
        F.sum("row_count").alias("row_count"), F.sum("empty_count").alias("empty_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        kind.otherwise("string").alias("inferred_type"),
        F.coalesce(F.min("min"), F.lit("")).alias("min"), F.coalesce(F.max("max"), F.lit("")).alias("max"))
    return stats.withColumn(
        "empty_pct", F.try_divide(F.col("empty_count").cast("double") * 100, F.col("row_count").cast("double")))


def profile(df: DataFrame, columns: Sequence[str] | None = None, examples: int = 5) -> DataFrame:
    """Per column: empties, distinct values, inferred type, least and greatest text, examples."""
    counts = value_counts(df, columns)
    filled = F.col("value") != ""
    value = F.when(filled, F.col("value"))
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0).cast("bigint")).alias("empty_count"),
        F.count_if(filled).alias("distinct_count"),
        inferred_type("value").alias("inferred_type"),
        F.coalesce(F.min(value), F.lit("")).alias("min"),
        F.coalesce(F.max(value), F.lit("")).alias("max"),
    )
    shown = _smallest(counts.where(_filled()), examples)
    return stats.join(shown, "column", "left").select(
        "column",
        "row_count",
        "empty_count",
        (F.col("empty_count").cast("double") * 100 / F.col("row_count").cast("double")).alias("empty_pct"),
        "distinct_count",
        "inferred_type",
        "min",
        "max",
        F.coalesce(F.col("values"), F.array().cast("array<string>")).alias("examples"),
    )


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The inferred label per column: one wide aggregate, so a task sends one row."""
    columns = list(columns or df.columns)
    row = _cells(df, columns).agg(*[inferred_type(f"c{i}").alias(f"inferred_type{i}") for i in range(len(columns))])
    return _by_column(row, columns, "inferred_type")


def duplicates(df: DataFrame, columns: Sequence[str], dataset: str = "", samples: int = 10) -> DataFrame:
    """Per column: empties, distinct values, repeated keys and their rows, strict uniqueness."""
    counts = value_counts(df, columns)
    filled = F.col("value") != ""
    repeated = filled & (F.col("n") > 1)
    zero = F.lit(0).cast("bigint")
    stats = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), zero).alias("empty"),
        F.count_if(filled).alias("distinct"),
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), zero).alias("duplicate_rows"),
    )
    shown = _smallest(counts.where(_filled() & (F.col("n") > 1)), samples)
    return stats.join(shown, "column", "left").select(
        F.lit(dataset).alias("dataset"),
        "column",
        "empty",
        "distinct",
        "duplicate_keys",
        "duplicate_rows",
        ((F.col("duplicate_keys") == 0) & (F.col("empty") == 0)).alias("strict_unique"),
        F.coalesce(F.col("values"), F.array().cast("array<string>")).alias("samples"),
    )
