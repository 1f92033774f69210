"""The served copy of the transactions, and profiles that add up."""

from pyspark.sql import functions as F

from ledgerguard.operators import profile, reports
from ledgerguard.sources import serving


def ledger(spark, n=60_000, users=3_000):
    tx = spark.range(n).selectExpr(
        "id", "concat('R', id) as reference", f"id * 7919 % {users} as source_account_id", f"(id + 5) % {users} as destination_account_id",
        "if(id % 3 = 0, 'FAILED', 'SUCCESS') as status", "'x' as failure_reason", "cast(id as decimal(14,2)) as amount",
        "'PAY' as transaction_type", "cast(1 as decimal(14,2)) as fee", "'MRU' as currency", "cast(9 as decimal(14,2)) as balance_before",
        "cast(8 as decimal(14,2)) as balance_after",
        "date'2024-01-01' + cast(id % 180 as int) as transaction_date", "timestamp_ntz'2024-01-01 00:00:00' as created_at")
    accounts = spark.range(users).selectExpr("id", "id as user_id", "concat('A', id) as account_number")
    owners = spark.range(users - 10).selectExpr("id", "if(id % 7 = 0, null, concat('U', id)) as full_name")
    return tx, accounts, owners


def scanned(df):
    """Rows that the scans of a plan gave out, after running it without adaptive planning."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        total = 0
        nodes = [df._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("Scan"):
                total += node.metrics().apply("numOutputRows").value()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def rows(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_point_questions_read_few_rows(spark, tmp_path):
    tx, accounts, users = ledger(spark)
    path = str(tmp_path / "served")
    serving.write_served(serving.served(tx, accounts, users), path, group_bytes=32 << 10)
    served = serving.read_served(spark, path)
    assert served.count() == tx.count()
    mine = serving.history(served, 77)
    assert rows(mine.select("id", "source_account", "destination_account")) == rows(
        tx.where("source_account_id = 77").selectExpr("id", "'A77' as source_account", "concat('A', destination_account_id) as destination_account"))
    assert scanned(mine) < 0.2 * 60_000
    days = serving.history(served, 77, "2024-02-01", "2024-03-15")
    assert rows(days.select("id")) == rows(reports.user_history_between(tx, accounts, 77, "2024-02-01", "2024-03-15").select("id"))
    assert scanned(days) < scanned(mine)
    assert rows(serving.failures(served, 77)) == rows(reports.user_failures(tx, accounts, 77))
    one = serving.of_reference(served, "R4242")
    assert [r["id"] for r in one.collect()] == [4242]
    assert scanned(one) < 0.2 * 60_000
    assert serving.of_reference(served, "none").count() == 0 and scanned(serving.of_reference(served, "none")) < 0.05 * 60_000
    unknown = tx.where("source_account_id >= 2990").first()["reference"]
    assert serving.of_reference(served, unknown).count() == 0  # its owner is not known
    nameless = tx.where("source_account_id = 14").first()["reference"]
    assert serving.of_reference(served, nameless).first()["source_user"] is None


def test_point_reports_run_no_job_while_the_plan_is_built(spark):
    tx, accounts, users = ledger(spark, 100, 20)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("points", "points")
    reports.user_history(tx, accounts, 3)
    reports.by_reference(tx, accounts, users, "R3")
    reports.user_failures(tx, accounts, 3)
    assert not tracker.getJobIdsForGroup("points")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_profiles_of_parts_add_up(spark):
    df = spark.range(4_000).selectExpr(
        "string(id % 900) as whole", "if(id % 5 = 0, '', string(id / 8)) as number", "string(date'2024-01-01' + cast(id % 50 as int)) as day",
        "if(id < 3999, '12', 'x') as nearly", "cast(null as string) as nothing")
    parts = None
    for k in range(4):
        part = profile.sketch(df.where(F.col("whole").cast("int") % 4 == k))
        parts = part if parts is None else parts.unionByName(part)
    merged = {r["column"]: r.asDict() for r in profile.merged_profile(parts).collect()}
    whole = {r["column"]: r.asDict() for r in profile.merged_profile(profile.sketch(df)).collect()}
    exact = {r["column"]: r.asDict() for r in profile.profile(df).collect()}
    for c in df.columns:
        for name in ("row_count", "empty_count", "empty_pct", "inferred_type", "min", "max"):
            assert merged[c][name] == whole[c][name] == exact[c][name], (c, name)
        assert abs(merged[c]["distinct_count"] - exact[c]["distinct_count"]) <= 0.05 * exact[c]["distinct_count"]
