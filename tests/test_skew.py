import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import anomalies, rules, skew


@pytest.fixture
def large(spark):
    """Make every side count as large, so that the spreading join is taken."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "0b"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def sides(spark):
    # A third of the rows has key 7, a third has none.
    left = spark.range(30_000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("7")).when(F.col("id") % 3 == 1, (F.col("id") % 500).cast("string")).alias("k"))
    right = spark.range(0, 500, 2).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([("7", -1)], "key string, v bigint"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_is_a_plain_join(spark, sides, large, how):
    left, right = sides
    spread = skew.lookup_join(left, right, "k", "key", how)
    plain = left.join(right, F.col("k") == F.col("key"), how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


@pytest.mark.parametrize("left_type, right_type", [
    ("string", "bigint"), ("decimal(14,2)", "bigint"), ("int", "bigint"), ("bigint", "string")])
def test_keys_of_unequal_types(spark, sides, large, left_type, right_type):
    """A hot key written otherwise than its parent: 007 against 7, 7.00 against 7."""
    left, right = sides
    key = F.concat(F.lit("00"), F.col("k")) if left_type == "string" else F.col("k")
    left = left.withColumn("k", key.cast(left_type))
    right = right.withColumn("key", F.col("key").cast(right_type))
    spread = skew.lookup_join(left, right, "k", "key", "inner")
    plain = left.join(right, F.col("k") == F.col("key"))
    assert spread.count() == plain.count() > 10_000
    assert spread.exceptAll(plain).isEmpty()


def test_spread_join_deals_missing_keys(spark, sides, large):
    left, right = sides
    joined = skew.lookup_join(left.where("k is null"), right, "k", "key", "left").select(F.spark_partition_id().alias("p"))
    biggest = joined.groupBy("p").count().agg(F.max("count")).first()[0]
    assert biggest < 10_000 / 4  # eight partitions; unspread, one holds all


def test_no_job_while_the_plan_is_built(spark, sides):
    left, right = sides
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    skew.lookup_join(left, right, "k", "key")
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def sent(spark, df):
    """Rows that each exchange of a plan wrote, after running it without adaptive planning."""
    def walk(node, out):
        if node.nodeName() == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), out)
        return out

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan(), [])


@pytest.mark.parametrize("value", ["shared", "own", "few"])
def test_tally_sends_a_bounded_state(spark, value):
    """Whether all hits share one sample, each has its own, or there are a few."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sample = {"shared": F.lit("n/a"), "own": F.lpad(F.col("id").cast("string"), 7, "0"),
                  "few": (F.col("id") % 7).cast("string")}[value]
        hits = spark.range(0, 400_000, 1, 4).select(F.lit("r").alias("rule"), sample.alias("s"))
        df = skew.tally(hits, ["rule"], "s")
        most = {"shared": 4, "own": 4 * skew.SAMPLE_BUCKETS, "few": 4 * 7}[value]
        assert max(sent(spark, df)) <= most
        row = df.first()
        assert row["count"] == 400_000
        assert row["samples"] == {"shared": ["n/a"], "own": [f"{i:07d}" for i in range(10)],
                                  "few": [str(i) for i in range(7)]}[value]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_tally_is_exact(spark):
    """Against a plain computation, with weights, nulls and several groups."""
    rows = [(f"r{i % 3}", None if i % 11 == 0 else f"{i * 7919 % 501:03d}", i % 4) for i in range(3_000)]
    df = spark.createDataFrame(rows, "rule string, s string, n bigint")
    got = {r["rule"]: r for r in skew.tally(df, ["rule"], "s", "n").collect()}
    for rule in ("r0", "r1", "r2"):
        mine = [(s, n) for r, s, n in rows if r == rule]
        assert got[rule]["count"] == sum(n for _, n in mine)
        assert got[rule]["samples"] == sorted({s for s, _ in mine if s is not None})[:10]


def test_partitions_grow_with_the_input(spark):
    from ledgerguard import session as s
    assert s.shuffle_partitions(1 << 20) == 1
    assert s.shuffle_partitions(1 << 40) == (1 << 40) // (64 << 20)
    assert s.shuffle_partitions(100 << 40) == s.MOST_PARTITIONS
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    old = spark.conf.get(name, None)
    assert s.size_shuffles(spark, 1 << 40) == int(spark.conf.get(name)) == 16_384
    spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def test_tally_bounds_samples(spark):
    hits = spark.range(1000).select(F.lit("r").alias("rule"), F.lpad((F.col("id") % 40).cast("string"), 2, "0").alias("s"))
    rules_frame = skew.sole_rows(["r", "kept"], spark)
    got = {r["rule"]: r for r in skew.tally(hits, ["rule"], "s", rules=rules_frame).collect()}
    assert got["r"]["count"] == 1000 and got["r"]["samples"] == [f"{i:02d}" for i in range(10)]
    assert got["kept"]["count"] == 0 and got["kept"]["samples"] == []


def test_conflicts_under_a_hot_key(spark, large):
    rows = spark.range(9_000).select(
        F.col("id").cast("string").alias("id"), F.lit("r").alias("reference"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("idempotency_key"),
        (F.col("id") % 5).cast("string").alias("amount"), F.lit("S").alias("status"),
        F.lit("1").alias("source_account_id"), F.lit("2").alias("destination_account_id"))
    assert anomalies.idempotency_conflicts(rows).count() == 3_000
    group = anomalies.conflict_groups(rows).collect()
    assert len(group) == 1 and group[0]["duplicate_count"] == 3_000 and group[0]["distinct_amount"] == 5


def test_gaps_across_blocks(spark):
    """One key with most rows: gaps lie inside blocks and between them."""
    missing = {5, 6, 1_000, 1_023, 1_024, 2_500, 2_501, 2_502, 7_999}
    rows = spark.range(10_000).where(~F.col("id").isin(*missing)).select(F.lit("a").alias("k"), F.col("id").alias("seq"))
    rows = rows.unionByName(spark.createDataFrame([("b", 1), ("b", 9), ("b", 9), (None, 4), (None, 6), ("c", None)], "k string, seq bigint"))
    gaps = sorted((tuple(r) for r in rules.sequence_gaps(rows, "k", "seq").collect()), key=str)
    assert gaps == sorted([("a", 4, 7, 2), ("a", 999, 1001, 1), ("a", 1022, 1025, 2), ("a", 2499, 2503, 3), ("a", 7998, 8000, 1),
                           ("b", 1, 9, 7), (None, 4, 6, 1)], key=str)


def test_gaps_of_numbers_far_apart(spark):
    numbers = [-(2**62), -1_025, -1, 0, 3, 63, 64, 1 << 20, (1 << 30) + 5, 1 << 47, (1 << 61) + 1, (1 << 61) + 2]
    rows = spark.createDataFrame([("k", n) for n in numbers], "k string, seq bigint")
    gaps = sorted(tuple(r) for r in rules.sequence_gaps(rows, "k", "seq").collect())
    assert gaps == [("k", a, b, b - a - 1) for a, b in zip(numbers, numbers[1:]) if b - a > 1]


def test_gaps_send_few_rows(spark):
    """A million numbers that follow one another are a thousand bitmaps a task."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(0, 1_000_000, 1, 4).where("id % 100000 <> 77").select(F.lit("k").alias("k"), F.col("id").alias("seq"))
        df = rules.sequence_gaps(rows, "k", "seq")
        assert max(sent(spark, df)) <= 4 * 1_000 and df.count() == 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_first_seen_depends_on_the_given_order(frame):
    df = frame([("1", "k", "5"), ("2", "k", "6"), ("3", "k", "6"), ("4", "j", "1")], "id key amount")
    assert rules.differs_from_first(df, "key", ["amount"], ["id"], "r").first()["count"] == 2
    last = rules.differs_from_first(df, "key", ["amount"], [F.concat(F.lit("x"), (-F.col("id").cast("int")).cast("string"))], "r")
    assert last.first()["count"] in (1, 2)
