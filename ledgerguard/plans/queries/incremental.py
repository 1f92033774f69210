"""Incremental ingest: the events table as a stream."""

from dataclasses import replace

from pyspark.sql import functions as F

from ...session import scratch
from ...streaming import incremental as op
from .. import bindings as b
from ..oracle import sql
from ..changes import Arrivals, Ledger
from ..registry import query
from .core import CORE_COLUMNS, SHOWN

PAYLOAD = ["amount", "status"]


def stream(spark, sf):
    """Events as a stream of typed transactions. The pattern names one file of the folder."""
    schema = b.table(spark, sf, "events").schema
    events = op.stream_of(spark, f"{sf.rstrip('/')}/event[s].parquet", schema, "ts")
    return events.select(
        F.col("event_id").alias("id"), "ts", "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.floor(F.col("event_id") / 3).cast("string")).alias("idempotency_key"),
        F.col("value").cast("decimal(14,2)").alias("amount"),
        (F.col("value") - 5).cast("decimal(14,2)").alias("balance_after"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))


SEEN = sql("""
SELECT a.id, a.idempotency_key, CAST(a.amount AS DOUBLE) AS amount FROM activity a
""")


@query("i1_incremental_load", SEEN)
def i1(spark, sf):
    path = scratch(spark, "loaded")
    source = stream(spark, sf).select("id", "idempotency_key", "amount")
    # Run twice: the second run finds nothing new behind the checkpoint.
    for _ in range(2):
        op.drain(source, op.append_to(path), f"{path}-checkpoint")
    return op.stored(spark, path, source.schema)


def ledger_of(spark, sf, tx, batches=4):
    """Batches of transactions, while their accounts, merchants and agencies come in parts:
    rows wait for parents, and conflicts and repeats arise across batches."""
    accounts, held = b.staged_accounts(spark, sf), b.accounts(spark, sf)
    late = F.col("id").cast("bigint") % 2 == 1
    parts = [Arrivals(accounts=accounts.where(~late), core_accounts=held.where(~late)),
             Arrivals(merchants=b.merchants(spark, sf)),
             Arrivals(accounts=accounts.where(late), core_accounts=held.where(late), agencies=b.agencies(spark, sf)),
             Arrivals(accounts=accounts.where(~late))]
    ledger = Ledger(spark, scratch(spark, "changes"), tx.schema, buckets=8)
    part = F.pmod(F.floor(F.col("id").cast("bigint") / 3), F.lit(batches))
    if batches == 2:
        parts = [parts[0], replace(parts[2], merchants=parts[1].merchants)]
    for n, arrivals in enumerate(parts):
        ledger.apply(replace(arrivals, transactions=tx.where(part == n)), n)
    return ledger.tables()


@query("i1_incremental_refresh", sql("""
WITH codes AS (SELECT id, code FROM anomalies UNION SELECT id, 'idempotency_conflict' FROM conflicts
               UNION SELECT id, code FROM holds)
SELECT t.id, t.route, COALESCE(string_agg(c.code, '|' ORDER BY c.code), '') AS reasons
FROM routed t LEFT JOIN codes c ON c.id = t.id GROUP BY t.id, t.route
"""))
def i1_refresh(spark, sf):
    routed, _ = ledger_of(spark, sf, b.staged_transactions(spark, sf))
    return routed.select("id", "route", F.array_sort("reasons").alias("reasons"))


@query("i1_incremental_core", sql(f"SELECT {CORE_COLUMNS} FROM core"))
def i1_core(spark, sf):
    """Exact repeats across batches as well: core keeps the first."""
    return ledger_of(spark, sf, b.staged_with_repeats(spark, sf), 2)[1].select(*SHOWN)


@query("i1_newer_than", """
SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""")
def i1_batch(spark, sf):
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return op.newer_than(b.table(spark, sf, "events"), "ts", mark).select("event_id", "user_id")


@query("i2_insert_new", sql("""
SELECT MIN(id) AS id, idempotency_key FROM activity WHERE id % 50 <> 7 GROUP BY idempotency_key
UNION ALL SELECT unnest([id, id]), CASE WHEN id % 100 = 7 THEN '' END FROM activity WHERE id % 50 = 7
"""))
def i2(spark, sf):
    path = scratch(spark, "inserted")
    key = F.when(F.col("id") % 100 == 7, "").when(F.col("id") % 50 != 7, F.col("idempotency_key"))
    source = stream(spark, sf).select("id", key.alias("idempotency_key"))
    # The same rows again, as a retrying sender would: nothing is added but rows without a key.
    for run in ("first", "retry"):
        offset = 0 if run == "first" else 1_000
        write = op.insert_new(path, "idempotency_key", ["id"])
        op.drain(source, lambda batch, n, w=write, o=offset: w(batch, n + o), f"{path}-{run}")
    return op.stored(spark, path, source.schema)


@query("i2_unique_within", sql("SELECT DISTINCT idempotency_key FROM activity"))
def i2_state(spark, sf):
    path = scratch(spark, "unique")
    source = op.unique_within(stream(spark, sf), "idempotency_key", "ts", "2 days").select("idempotency_key")
    op.drain(source, op.append_to(path), f"{path}-checkpoint")
    return op.stored(spark, path, source.schema)


@query("i2_held_conflicts", sql("""
SELECT idempotency_key, COUNT(*) AS rows, COUNT(DISTINCT amount) > 1 OR COUNT(DISTINCT status) > 1 AS conflict
FROM activity GROUP BY idempotency_key
HAVING MAX(created_at) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY
"""))
def i2_held(spark, sf):
    path = scratch(spark, "held")
    source = op.held_until(stream(spark, sf), "idempotency_key", "ts", "1 day", PAYLOAD, ["id"]).drop("first_seen", "first_row")
    op.drain(source, op.append_to(path), f"{path}-checkpoint")
    return op.stored(spark, path, source.schema)


@query("i2_held_rows", sql("""
SELECT MIN_BY(id, (created_at, id)) AS id, idempotency_key, CAST(MIN_BY(amount, (created_at, id)) AS DOUBLE) AS amount
FROM activity GROUP BY idempotency_key
HAVING MAX(created_at) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY
   AND COUNT(DISTINCT amount) <= 1 AND COUNT(DISTINCT status) <= 1
"""))
def i2_held_rows(spark, sf):
    """Rows that come out of holding, ready for core."""
    path = scratch(spark, "released")
    held = op.held_until(stream(spark, sf), "idempotency_key", "ts", "1 day", PAYLOAD, ["id"])
    source = op.released(held).select("id", "idempotency_key", "amount")
    op.drain(source, op.append_to(path), f"{path}-checkpoint")
    return op.stored(spark, path, source.schema)


@query("i2_corrected_conflicts", sql("""
SELECT id, idempotency_key FROM activity WHERE idempotency_key IN (
  SELECT idempotency_key FROM activity GROUP BY idempotency_key
  HAVING COUNT(DISTINCT amount) <= 1 AND COUNT(DISTINCT status) <= 1)
"""))
def i2_corrected(spark, sf):
    """Four micro-batches, so that conflicts also arise against history."""
    path = scratch(spark, "corrected")
    history, gone = f"{path}/history", f"{path}/retractions"
    rows = b.activity(spark, sf).select("id", "idempotency_key", *PAYLOAD)
    rows.repartition(4, "id").write.parquet(f"{path}/source")
    source = op.stream_of(spark, f"{path}/source", rows.schema, files_per_batch=1)
    op.drain(source, op.correct_conflicts(history, gone, payload=PAYLOAD), f"{path}/checkpoint")
    kept = op.corrected(
        op.stored(spark, history, rows.schema), op.stored(spark, gone, rows.select("id", "idempotency_key").schema))
    return kept.select("id", "idempotency_key")


@query("i3_accept_or_reject", sql("""
WITH judged AS (
  SELECT *, CASE WHEN amount <= 0 THEN 'invalid_amount' END AS r1,
         CASE WHEN CAST(amount - 5 AS DECIMAL(14,2)) < 0 THEN 'negative_balance' END AS r2 FROM activity),
ranked AS (
  SELECT *, r1 IS NULL AND r2 IS NULL AS good,
         row_number() OVER (PARTITION BY idempotency_key, r1 IS NULL AND r2 IS NULL ORDER BY id) AS rk FROM judged)
SELECT id, idempotency_key, concat_ws('|', r1, r2, CASE WHEN good AND rk > 1 THEN 'duplicate_key' END) AS reasons FROM ranked
"""))
def i3(spark, sf):
    path = scratch(spark, "judged")
    source = stream(spark, sf).select("id", "idempotency_key", "amount", "balance_after")
    tests = {"invalid_amount": F.col("amount") <= 0, "negative_balance": F.col("balance_after") < 0}
    write = op.accept_or_reject(tests, f"{path}/accepted", f"{path}/rejected", "idempotency_key", ["id"])
    op.drain(source, write, f"{path}/checkpoint")
    good = op.stored(spark, f"{path}/accepted", source.schema).select(
        "id", "idempotency_key", F.array().cast("array<string>").alias("reasons"))
    bad = spark.read.parquet(f"{path}/rejected").select("id", "idempotency_key", "reasons")
    return good.unionByName(bad)


def _totals(every):
    return sql(f"""
SELECT strftime(date_trunc('{every}', created_at), '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS total_tx,
       COUNT(*) FILTER (WHERE status = 'SUCCESS') AS success_count, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_count,
       CAST(SUM(amount) FILTER (WHERE status = 'SUCCESS') AS DOUBLE) AS total_volume
FROM activity GROUP BY 1""")


def _running(spark, sf, every):
    path = scratch(spark, "totals")
    source = op.running_totals(stream(spark, sf), "ts", F.col("amount"), F.col("status"), every)
    op.drain(source, op.upsert_into(path, "window_start"), f"{path}-checkpoint", "update")
    return op.updated(spark, path, "window_start", source.schema)


@query("i4_append_totals", _totals("day").replace("GROUP BY 1", """GROUP BY 1
HAVING date_trunc('day', MIN(created_at)) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY"""))
def i4_append(spark, sf):
    """Append mode: a day comes out once, when the watermark has passed it, and leaves the state."""
    path = scratch(spark, "closed")
    source = op.running_totals(stream(spark, sf), "ts", F.col("amount"), F.col("status"), "1 day")
    op.drain(source, op.append_to(path), f"{path}-checkpoint")
    return op.stored(spark, path, source.schema)


@query("i4_running_daily_totals", _totals("day"))
def i4_daily(spark, sf):
    return _running(spark, sf, "1 day")


@query("i4_running_hourly_totals", _totals("hour"))
def i4_hourly(spark, sf):
    return _running(spark, sf, "1 hour")


@query("i5_latest_per_user", """
SELECT o_custkey, o_orderkey, recency FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency
  FROM orders) r WHERE recency <= 50
""")
def i5(spark, sf):
    return op.latest_per_user(
        b.table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey"
    ).select("o_custkey", "o_orderkey", "recency")


@query("i5_latest_incremental", """
SELECT o_custkey, o_orderkey, recency FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency
  FROM orders) r WHERE recency <= 50
""")
def i5_incremental(spark, sf):
    """Four micro-batches in no order of time, so that many rows come late."""
    path = scratch(spark, "latest")
    rows = b.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    rows.repartition(4, F.col("o_orderkey") % 4).write.parquet(f"{path}-source")
    source = op.stream_of(spark, f"{path}-source", rows.schema, files_per_batch=1)
    names = ("o_custkey", "o_orderdate", "o_orderkey")
    op.drain(source, op.keep_latest(path, *names), f"{path}-checkpoint")
    return op.latest_kept(spark, path, rows.schema, *names).select("o_custkey", "o_orderkey", "recency")


@query("i5_current_balance", sql("""
SELECT source_account_id, CAST(balance_after AS DOUBLE) AS current_balance FROM (
  SELECT *, row_number() OVER (PARTITION BY source_account_id ORDER BY created_at DESC, id DESC) AS r FROM payments) p
WHERE r = 1
"""))
def i5_balance(spark, sf):
    return op.current_balance(b.payments(spark, sf), "source_account_id", "created_at", "balance_after", "id")
