import pytest
from pyspark.sql import functions as F

from ledgerguard.operators.reports import daily_totals
from ledgerguard.streaming import incremental as inc

SCHEMA = "id bigint, key string, amount string, ts timestamp"


@pytest.fixture
def batches(spark):
    def make(*parts):
        return [spark.createDataFrame(p, "id bigint, key string, amount string, status string") for p in parts]
    return make


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_insert_new_over_batches_and_retries(spark, batches, tmp_path):
    path = str(tmp_path / "t")
    first, second = batches([(1, "a", "5", "S"), (2, "a", "6", "S"), (3, "b", "1", "S")], [(4, "a", "5", "S"), (5, "c", "1", "S")])
    write = inc.insert_new(path, "key", ["id"])
    write(first, 0)
    write(second, 1)
    write(second, 1)  # the batch runs again after a failure
    assert ids(inc.stored(spark, path, first.schema)) == [1, 3, 5]


def test_rows_without_a_key_are_kept(spark, batches, tmp_path):
    path = str(tmp_path / "t")
    (part,) = batches([(1, None, "5", "S"), (2, None, "6", "S"), (3, "", "1", "S"), (4, "", "1", "S"), (5, "a", "1", "S")])
    inc.insert_new(path, "key", ["id"])(part, 0)
    assert ids(inc.stored(spark, path, part.schema)) == [1, 2, 3, 4, 5]
    rows = spark.sql("select id, if(id < 3, null, 'k') as key, timestamp'2024-01-01 00:00:00' as ts from range(6)")
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    rows.write.parquet(source)
    unique = inc.unique_within(inc.stream_of(spark, source, rows.schema, "ts"), "key", "ts")
    inc.drain(unique, inc.append_to(out), str(tmp_path / "c"))
    assert spark.read.parquet(out).groupBy("key").count().orderBy("key").collect() == [(None, 3), ("k", 1)]


def test_a_horizon_opens_few_folders(spark, tmp_path):
    import datetime as dt
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "a", dt.date(2024, 1, 1 + i)) for i in range(20)], "id bigint, key string, day date")
    inc.write_batch(rows, path, 0, "day")
    late = inc.stored(spark, path, rows.schema, since=dt.date(2024, 1, 15))
    assert late.count() == 6
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_day" in plan.split("PartitionFilters")[1].split("]")[0]


def test_insert_new_within_a_horizon(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "id bigint, key string, day date").withColumn("day", F.col("day"))
    import datetime as dt
    write = inc.insert_new(path, "key", ["id"], day="day", horizon_days=10)
    write(rows((1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 30))), 0)
    write(rows((3, "a", dt.date(2024, 2, 1)), (4, "b", dt.date(2024, 2, 1))), 1)
    assert ids(inc.stored(spark, path, rows((1, "a", dt.date(2024, 1, 1))).schema)) == [1, 2, 3]


def test_accept_or_reject(spark, batches, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    tests = {"invalid_amount": F.col("amount").cast("int") <= 0}
    write = inc.accept_or_reject(tests, good, bad, "key", ["id"])
    first, second = batches(
        [(1, "a", "0", "S"), (2, "a", "5", "S"), (3, "a", "6", "S"), (4, None, "7", "S"), (5, None, "8", "S")],
        [(6, "a", "9", "S"), (7, "b", "-1", "S"), (8, "b", "1", "S")])
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert ids(inc.stored(spark, good, first.schema)) == [2, 4, 5, 8]
    rejected = {r["id"]: r["reasons"] for r in spark.read.parquet(bad).collect()}
    assert rejected == {1: ["invalid_amount"], 3: ["duplicate_key"], 6: ["duplicate_key"], 7: ["invalid_amount"]}


def test_late_conflict_retracts_what_was_accepted(spark, batches, tmp_path):
    history, gone = str(tmp_path / "h"), str(tmp_path / "r")
    write = inc.correct_conflicts(history, gone, "key", ["amount", "status"])
    parts = batches([(1, "a", "5", "S"), (2, "b", "1", "S")], [(3, "a", "6", "S"), (4, "b", "1", "S")], [(5, "c", "1", "S")])
    for n, part in enumerate(parts):
        write(part, n)
    write(parts[1], 1)
    retracted = inc.stored(spark, gone, parts[0].select("id", "key").schema)
    assert ids(retracted) == [1, 3]
    assert ids(inc.corrected(inc.stored(spark, history, parts[0].schema), retracted, "key")) == [2, 4, 5]


def test_stream_equals_batch(spark, sf, tmp_path):
    """Complete mode gives the daily report; append mode leaves only the last days open."""
    from ledgerguard.plans import bindings as b
    from ledgerguard.plans.queries.incremental import stream
    batch = {str(r["transaction_date"]): (r["total_tx"], r["success_count"], r["total_volume"])
             for r in daily_totals(b.activity(spark, sf).withColumn("transaction_type", F.lit(""))).collect()}
    totals = inc.running_totals(stream(spark, sf), "ts", F.col("amount"), F.col("status"))
    out = str(tmp_path / "append")
    inc.drain(totals, inc.append_to(out), str(tmp_path / "c"))
    closed = {str(r["window_start"].date()): (r["total_tx"], r["success_count"], r["total_volume"])
              for r in spark.read.parquet(out).collect()}
    assert len(closed) >= len(batch) - 3
    assert all(batch[d] == v for d, v in closed.items())


def test_checkpoint_remembers_files(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))
    rows = spark.range(3).withColumn("v", F.lit("x"))
    rows.write.parquet(source)
    stream = inc.stream_of(spark, source, rows.schema)
    inc.drain(stream, inc.append_to(out), checkpoint)
    rows.withColumn("id", F.col("id") + 10).write.mode("append").parquet(source)
    inc.drain(stream, inc.append_to(out), checkpoint)
    assert ids(inc.stored(spark, out, rows.schema)) == [0, 1, 2, 10, 11, 12]


def test_high_water_mark(spark):
    df = spark.sql("select id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int)) as ts from range(5)")
    mark = inc.high_water_mark(df.where("id < 3"), "ts").first()[0]
    assert ids(inc.newer_than(df, "ts", mark)) == [3, 4]
    assert inc.newer_than(df, "ts", None).count() == 5


def test_latest_rows_and_balance(spark):
    df = spark.sql("select id, id % 2 as u, id as ts, id * 10 as balance from range(10)")
    assert inc.latest_per_user(df, "u", "ts", "id", 2).count() == 4
    plan = inc.latest_per_user(df, "u", "ts", "id", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r["u"]: r["current_balance"] for r in inc.current_balance(df, "u", "ts", "balance", "id").collect()} == {0: 80, 1: 90}
