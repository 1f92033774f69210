"""Joins and tallies that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def input_bytes(df: DataFrame) -> int:
    """Size of the tables that a plan reads, as Catalyst knows them without a job. It
    needs no optimiser run, and no join in the plan can inflate it."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """Equi-join rows to a keyed side: one plan and one answer at every size.

    Keys compare as in any join, after Catalyst's own coercion. Rows without a key, which
    never match, are spread over all partitions instead of meeting in one. Hot keys are
    left to AQE, which sees real partition sizes and splits those of the row side; the
    session switches that on (``session.DEFAULTS``). Nothing runs while the plan is built.

    The slice comes from the row and the id of its partition, both of which a retried
    task sees again. Works for inner, left, left_semi and left_anti joins.
    """
    lkey, rkey = F.col(left_key), F.col(right_key)
    atomic = [f.name for f in left.schema.fields
              if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    row = F.xxhash64(*[F.col(f"`{c}`") for c in atomic]) + F.spark_partition_id()
    spread = left.withColumn("_slice", F.when(lkey.isNull(), row).otherwise(F.lit(0)).cast("bigint"))
    # Generated, so that Catalyst keeps it as a join key and doesn't fold it away.
    side = right.withColumn("_copy", F.explode(F.array(F.lit(0).cast("bigint"))))
    joined = spread.join(side, (lkey == rkey) & (F.col("_slice") == F.col("_copy")), how)
    return joined.drop("_slice", "_copy")


def sole_rows(rules: Sequence[str], spark: SparkSession, name: str = "rule") -> DataFrame:
    """One row per rule name, so that a rule without a hit still reports zero."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in rules])).alias(name))


SAMPLE_BUCKETS = 64  # more than enough for ten samples, few enough for every task to send all


def tally(
    hits: DataFrame,
    by: Sequence[str],
    sample: str,
    weight: str | None = None,
    rules: DataFrame | None = None,
    keep: int = 10,
) -> DataFrame:
    """Count hits per group with the ``keep`` smallest distinct samples.

    The state of a group is bounded and merges: samples are dealt by hash over
    SAMPLE_BUCKETS buckets, and each keeps its count and its least sample, so a task sends
    at most that many rows per group, whether all hits share one sample or each has its
    own. The ``keep``-th least of these, which are distinct, bounds the samples that can
    be among the ``keep`` smallest; a second look at the hits collects those up to it, a
    few more than wanted, made distinct in every task before they are sent. The result is
    exact. ``rules`` adds groups without a hit; there is one row per group, so the bounds
    are broadcast.
    """
    by = list(by)
    n = F.col(weight) if weight else F.lit(1)
    shown = hits.select(*by, n.cast("bigint").alias("_n"), F.col(sample).cast("string").alias("_sample"))
    bucket = F.pmod(F.xxhash64("_sample"), F.lit(SAMPLE_BUCKETS)).alias("_bucket")
    state = shown.groupBy(*by, bucket).agg(F.sum("_n").alias("_n"), F.min("_sample").alias("_least"))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    counts = state.select(*by, "_n", "_least")
    if rules is not None:
        counts = counts.unionByName(rules.select(*by, zero.alias("_n"), none.alias("_least")))
    totals = counts.groupBy(*by).agg(
        F.sum("_n").alias("_n"), F.get(F.array_sort(F.collect_list("_least")), F.lit(keep - 1)).alias("_bound"))
    # A key that Catalyst can't fold on either side: with a constant group it would see no key at all.
    bounds = totals.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_bound", F.explode(F.array(F.lit(0).cast("bigint"))).alias("_copy"))
    same = F.pmod(F.xxhash64("_sample"), F.lit(1).cast("bigint")) == F.col("_copy")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    low = shown.join(F.broadcast(bounds), same).where(F.coalesce(F.col("_sample") <= F.col("_bound"), F.col("_sample").isNotNull()))
    samples = low.groupBy(*by, "_sample").agg(zero.alias("_n"))
    both = totals.select(*by, "_n", none.alias("_sample")).unionByName(samples)
    return both.groupBy(*by).agg(
        F.sum("_n").alias("count"),
        F.slice(F.array_sort(F.collect_list("_sample")), 1, keep).alias("samples"),
    )


def flag(test: Column) -> Column:
    """A test as a plain boolean; one that is NULL did not fire."""
    return F.coalesce(test, F.lit(False))


def any_of(columns: Sequence[str]) -> Column:
    """Is one of several non-NULL booleans true?"""
    columns = [F.col(c) for c in columns]
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def explode_hits(df: DataFrame, tests: Sequence[tuple[str, Column]], name: str) -> DataFrame:
    """One row per (row, test that fires), with the test's name in a new column.

    The tests are columns of their own, so they run in generated code; the array
    function, which Spark interprets, sees finished booleans. There is no filter on them
    in between: Catalyst's constraint inference doubles its work with every such column.
    """
    marks = [f"_hit{i}" for i in range(len(tests))]
    marked = df.select("*", *[flag(t).alias(m) for m, (_, t) in zip(marks, tests)])
    codes = F.array(*[F.when(F.col(m), F.lit(code)) for m, (code, _) in zip(marks, tests)])
    return marked.withColumn(name, F.explode(F.array_compact(codes))).drop(*marks)


def rule_hits(df: DataFrame, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """DF[rule, sample] of all rules in one scan; ``rules`` holds (name, test, sample)."""
    marks = [f"_hit{i}" for i in range(len(rules))]
    shows = [f"_show{i}" for i in range(len(rules))]
    marked = df.select(
        *[flag(t).alias(m) for m, (_, t, _) in zip(marks, rules)],
        *[s.cast("string").alias(n) for n, (_, _, s) in zip(shows, rules)])
    found = F.array(*[
        F.when(F.col(m), F.struct(F.lit(name).alias("rule"), F.col(n).alias("sample")))
        for m, n, (name, _, _) in zip(marks, shows, rules)
    ])
    hits = marked.select(F.explode(F.array_compact(found)).alias("hit"))
    return hits.select("hit.rule", "hit.sample")
