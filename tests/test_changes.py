"""The refresh by changes against the full one, and the bucketed tables under it."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import core, quarantine, routing
from ledgerguard.plans.changes import Arrivals, Ledger
from ledgerguard.sources.buckets import FANOUT, KEPT, Buckets
from ledgerguard.streaming import incremental as inc

COLUMNS = (*routing.NEEDED, "reference", "created_at", "source_position")


def transaction(rng, i, position):
    """A row with every kind of fault, among few keys, accounts and merchants."""
    ok = rng.random() < 0.8
    return {
        "id": rng.choice([str(i), str(i), str(i), f"0{i}", None]) if rng.random() < 0.1 else str(i), "reference": f"R{i}",
        "idempotency_key": rng.choice([f"k{rng.randrange(40)}", f"k{i}", f"k{i}", "", None]),
        "transaction_type": rng.choice(["PAY", "TRF"]), "amount": "5.00" if ok else rng.choice(["-1", "0", "x", "7.00"]),
        "status": rng.choice(["SUCCESS", "SUCCESS", "FAILED"]),
        "source_account_id": rng.choice([str(rng.randrange(12)), str(rng.randrange(12)), "", "abc", "007"]),
        "destination_account_id": rng.choice([str(rng.randrange(12)), str(rng.randrange(12)), str(rng.randrange(12)), None]),
        "merchant_id": rng.choice([str(rng.randrange(6)), ""]), "agency_id": rng.choice([str(rng.randrange(4)), "", "z"]),
        "balance_before": "10.00", "balance_after": rng.choice(["10", "10.00", "10.00", "5.00"]),
        "created_at": "2024-01-01T00:00:00.000Z", "source_position": position,
    }


SCHEMA = ", ".join(f"{c} string" for c in COLUMNS[:-1]) + ", source_position bigint"


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA)


def ids(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


def shown(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_equals_the_full_refresh(spark, tmp_path, seed=1):
    """Faults, conflicts, repeats, equal ids and late parents in random batches; the third
    batch runs twice."""
    rng = random.Random(seed)
    rows = [transaction(rng, rng.randrange(60), n) for n in range(120)]
    staged, typed = [str(i) for i in range(9)] + ["007", "abc"], [0, 1, 2, 3, 7]
    merchants, agencies = [0, 1, 2], [1, 2]
    ledger = Ledger(spark, str(tmp_path / "ledger"), frame(spark, rows).schema, buckets=4)
    parts = [rows[:50], rows[50:80], rows[80:119], [], rows[119:]]
    for n, part in enumerate(parts):
        arrivals = Arrivals(
            transactions=frame(spark, part) if part else None,
            accounts=ids(spark, staged[n::len(parts)], "string"), core_accounts=ids(spark, typed[n::len(parts)]),
            merchants=ids(spark, merchants[n::len(parts)]) if n < 3 else None, agencies=ids(spark, agencies) if n == 3 else None)
        changed = ledger.apply(arrivals, n)
        if n == 2:
            assert sorted(map(str, changed.collect())) == sorted(map(str, ledger.apply(arrivals, n).collect()))
    dims = (ids(spark, staged, "string"), ids(spark, typed), ids(spark, merchants), ids(spark, agencies))
    full = routing.route(frame(spark, rows), *dims)
    mine, mine_core = ledger.tables()
    names = ("source_position", "id", "route")
    assert shown(mine, *names) == shown(full, *names)
    reasons = lambda df: {r["source_position"]: sorted(r["reasons"]) for r in df.collect()}
    assert reasons(mine) == reasons(full)
    assert shown(mine_core, "id", "reference", "amount", "idempotency_key") == shown(
        core.core_from_route(full), "id", "reference", "amount", "idempotency_key")


def test_orphans_decide_as_the_parents_do(spark):
    """The decisions from the references that resolve nowhere are those from all parents."""
    rng = random.Random(8)
    rows = [transaction(rng, n, n) for n in range(300)]
    for n, column in enumerate(("source_account_id", "destination_account_id", "merchant_id", "agency_id") * 3):
        rows[n * 5][column] = ("9" * 25, "0", "007")[n % 3]
    dims = (ids(spark, [str(i) for i in range(9)] + ["007", "abc", "9" * 25], "string"), ids(spark, [0, 1, 2, 3, 7]),
            ids(spark, [0, 1, 2]), ids(spark, [1, 2]))
    tx = frame(spark, rows)
    lost = quarantine.orphans(tx, *dims)
    shape = lambda df: {r["decided_id"]: (r["anomalies"], r["quarantine"]) for r in df.collect()}
    assert shape(routing.decisions(tx, *dims, lost=lost)) == shape(routing.decisions(tx, *dims))


def test_a_batch_opens_its_own_buckets(spark, tmp_path):
    """A row releases the one that waited for its account; other buckets keep their files."""
    rng = random.Random(3)
    good = {**transaction(rng, 1, 0), "idempotency_key": None, "amount": "5.00", "status": "SUCCESS", "transaction_type": "TRF",
            "merchant_id": "", "agency_id": "", "balance_after": "5.00", "source_account_id": "1", "destination_account_id": "1"}
    rows = [{**good, "id": str(i), "source_position": i, "source_account_id": "2" if i == 5 else "1"} for i in range(200)]
    ledger = Ledger(spark, str(tmp_path / "l"), frame(spark, rows).schema, buckets=32)
    ledger.apply(Arrivals(frame(spark, rows), ids(spark, ["1"], "string"), ids(spark, [1])), 0)
    before = ledger.routed.manifest()
    changed = ledger.apply(Arrivals(accounts=ids(spark, ["2"], "string"), core_accounts=ids(spark, [2])), 1)
    assert {r["route"]: (r["rows_before"], r["rows_after"]) for r in changed.collect()} == {"QUARANTINE": (1, 0), "CORE": (0, 1)}
    after = ledger.routed.manifest()
    assert len(before) == len(after) > 20 and sum(before[b] != after[b] for b in before) == 1
    late = {**good, "id": "900", "source_position": 900, "idempotency_key": "x"}
    ledger.apply(Arrivals(frame(spark, [late])), 2)
    ledger.apply(Arrivals(frame(spark, [{**late, "id": "901", "source_position": 901, "amount": "6.00"}])), 3)
    routes = {r["id"]: r["route"] for r in ledger.tables()[0].where("id in (5, 900, 901)").collect()}
    assert routes == {"5": "CORE", "900": "ANOMALY", "901": "ANOMALY"}  # the late conflict retracts an old row
    assert ledger.tables()[1].where("id in (900, 901)").count() == 0


def test_wide_rows_are_written_once(spark, tmp_path):
    """A parent that releases every row moves their routes and core; the wide rows stay as they are."""
    rng = random.Random(4)
    good = {**transaction(rng, 1, 0), "idempotency_key": None, "amount": "5.00", "status": "SUCCESS", "transaction_type": "PAY",
            "merchant_id": "3", "agency_id": "", "balance_after": "5.00", "source_account_id": "1", "destination_account_id": "1"}
    rows = [{**good, "id": str(i), "source_position": i, "merchant_id": "3" if i % 9 else ""} for i in range(40)]
    ledger = Ledger(spark, str(tmp_path / "l"), frame(spark, rows).schema, buckets=2)
    ledger.apply(Arrivals(frame(spark, rows), ids(spark, ["1"], "string"), ids(spark, [1])), 0)
    assert {r["route"] for r in ledger.tables()[0].collect()} == {"QUARANTINE"}
    ledger.apply(Arrivals(merchants=ids(spark, [3])), 1)
    assert sum(r["route"] == "CORE" for r in ledger.tables()[0].collect()) == ledger.tables()[1].count() == 35
    written = {p.relative_to(tmp_path / "l").parts[0] for p in (tmp_path / "l").glob("*/runs/1-*/**/*.parquet")
               if "balance_after" in spark.read.parquet(str(p)).columns}
    assert written == {"core"}


def test_a_batch_stores_wide_rows_once(spark, tmp_path, monkeypatch):
    """Beside their run, and core, no table of a batch holds the columns that no rule reads."""
    from ledgerguard import session
    stored, kept_at = [], session.kept_at
    monkeypatch.setattr(session, "kept_at", lambda df, path, *a: (stored.append(df.columns), kept_at(df, path, *a))[1])
    rng = random.Random(6)
    rows = [transaction(rng, n, n) for n in range(30)]
    ledger = Ledger(spark, str(tmp_path / "l"), frame(spark, rows).schema, buckets=2)
    ledger.apply(Arrivals(frame(spark, rows), ids(spark, ["1", "2"], "string"), ids(spark, [1, 2])), 0)
    assert stored and not [c for c in stored if "created_at" in c]
    assert ledger.tables()[0].count() == 30


def test_repeats_and_old_conflicts_over_batches(spark, tmp_path):
    """Ids occur once; keys repeat exactly or clash over batches, and parents release old rows
    whose keys no new row names."""
    rng = random.Random(7)
    good = {**transaction(rng, 1, 0), "amount": "5.00", "status": "SUCCESS", "transaction_type": "TRF", "merchant_id": "",
            "agency_id": "", "balance_after": "5.00"}
    rows = []
    for n in range(90):
        key, account = n % 30, str(n % 30 % 4)
        rows.append({**good, "id": str(200 - n), "reference": f"R{n}", "source_position": 500 - n, "idempotency_key": f"k{key}" if key else None,
                     "source_account_id": account, "destination_account_id": account, "amount": "6.00" if key % 7 == 1 and n > 29 else "5.00"})
    ledger = Ledger(spark, str(tmp_path / "l"), frame(spark, rows).schema, buckets=2)
    for n, (part, accounts) in enumerate(((rows[:50], [0, 1]), (rows[50:60], []), (None, [2]), (rows[60:], [3]))):
        ledger.apply(Arrivals(frame(spark, part) if part else None, ids(spark, [str(a) for a in accounts], "string"), ids(spark, accounts)), n)
    none = ids(spark, [])
    full = routing.route(frame(spark, rows), ids(spark, list("0123"), "string"), ids(spark, [0, 1, 2, 3]), none, none)
    mine, mine_core = ledger.tables()
    assert shown(mine, "id", "route", "reasons") == shown(full, "id", "route", "reasons")
    assert {r["route"] for r in mine.collect()} == {"ANOMALY", "CORE"}
    names = ("id", "reference", "idempotency_key")
    assert shown(mine_core, *names) == shown(core.core_from_route(full), *names)


def test_known_buckets_need_no_job(spark, tmp_path):
    table = Buckets(spark, str(tmp_path / "t"), "k", "k string", 2)
    broken = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("k"))
    assert table.of_keys(broken, known=[1, 0]) == [0, 1]
    assert table.find(broken).collect() == []  # an empty table is not searched
    assert table.append(spark.createDataFrame([(f"{n}",) for n in range(20)], "k string"), 0) == [0, 1]


def test_buckets_append_merge_and_forget(spark, tmp_path):
    """Twenty batches: few files per bucket, few folders left, and nothing lost."""
    table = Buckets(spark, str(tmp_path / "t"), "k", "k string, v bigint", 3)
    for n in range(20):
        table.append(spark.createDataFrame([(f"k{n}", n), ("hot", n), (None, n)], "k string, v bigint"), n)
    assert sorted(r["v"] for r in table.read().where("k = 'hot'").collect()) == list(range(20))
    assert table.read().count() == 60
    found = table.find(spark.createDataFrame([("k7",), ("hot",), (None,), ("no",)], "x string"), "x")
    assert found.count() == 21
    levels = 3  # 20 batches, merged by fours
    assert all(len(runs) < FANOUT * levels for runs in table.manifest().values())
    assert len(table.batches()) == KEPT
    files = len(table.find(spark.createDataFrame([("k7",)], "x string"), "x").inputFiles())
    assert files <= (FANOUT - 1) * levels + 1
    kept = {f for b in table.batches() for runs in table.manifest(b + 1).values() for _, f in runs}
    left = {f"{run}/{part}" for run in table._names("runs") for part in table._names("runs", run) if part.startswith("bucket__")}
    assert left == kept
    table.append(spark.createDataFrame([("again", 1)], "k string, v bigint"), 19)  # the last batch runs again
    assert table.read().where("v = 19").count() == 0 and table.read().count() == 58


def test_upsert_replaces_keys_and_keeps_the_old_state_readable(spark, tmp_path):
    table = Buckets(spark, str(tmp_path / "t"), "k", "k string, v bigint", 4)
    table.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v bigint"), 0)
    table.upsert(spark.createDataFrame([("a", 2), ("c", 2)], "k string, v bigint"), 1)
    table.upsert(spark.createDataFrame([("a", 2), ("c", 2)], "k string, v bigint"), 1)
    assert shown(table.read(), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]
    assert shown(table.read(before=1), "k", "v") == [("a", 1), ("b", 1)]

    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    commit, table._commit = table._commit, killed
    with pytest.raises(Killed):  # the batch dies after its files are written
        table.upsert(spark.createDataFrame([("a", 9)], "k string, v bigint"), 2)
    assert shown(table.read(), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]
    table._commit = commit
    table.upsert(spark.createDataFrame([("a", 9)], "k string, v bigint"), 2)
    assert shown(table.read(), "k", "v") == [("a", 9), ("b", 1), ("c", 2)]


def test_streams_leave_no_scratch_and_read_few_files(spark, tmp_path):
    """A sink after eight batches: no intermediate tables, and a bounded index."""
    from ledgerguard.session import _shared
    path = str(tmp_path / "t")
    write = inc.insert_new(path, "k", ["v"])
    fs, root = Buckets(spark, _shared(spark), "k", "k string")._path()
    tables = lambda: len(fs.listStatus(root))
    before, schema = tables(), "k string, v bigint"
    for n in range(8):
        write(spark.createDataFrame([(f"k{n % 7}", n), (None, n)], schema), n)
    assert tables() == before
    assert sorted(r["v"] for r in inc.stored(spark, path, spark.createDataFrame([], schema).schema).where(
        "k is not null").collect()) == list(range(7))
    index = Buckets(spark, f"{path}/{inc.INDEX}", "k", "k string")
    assert index.read().count() == 7
    assert len(index.find(spark.createDataFrame([("k3",)], "k string")).inputFiles()) == 1


def test_latest_rows_over_batches(spark, tmp_path):
    rows = [(u, t, u * 1000 + t) for u in range(5) for t in range(30)]
    random.Random(5).shuffle(rows)
    schema = "u bigint, t bigint, id bigint"
    write = inc.keep_latest(str(tmp_path / "t"), "u", "t", "id", keep=4, buckets=3)
    for n in range(6):
        write(spark.createDataFrame(rows[n * 25:(n + 1) * 25], schema), n)
    whole = spark.createDataFrame(rows, schema)
    got = inc.latest_kept(spark, str(tmp_path / "t"), whole.schema, "u", "t", "id", keep=4, buckets=3)
    assert shown(got, "u", "t", "id", "recency") == shown(inc.latest_per_user(whole, "u", "t", "id", 4), "u", "t", "id", "recency")
    one = inc.latest_kept(spark, str(tmp_path / "t"), whole.schema, "u", "t", "id", whole.where("u = 3"), 4, 3)
    assert {r["u"] for r in one.collect()} == {3}


def test_totals_in_update_mode(spark, tmp_path):
    """Each micro-batch writes the windows that it changed; the end is the whole table's totals."""
    rows = spark.sql("select id, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 60 as int)) as ts, "
                     "cast(id as decimal(14,2)) as amount, if(id % 3 = 0, 'FAILED', 'SUCCESS') as status from range(300)")
    source = str(tmp_path / "source")
    rows.repartition(5, F.col("id") % 5).write.parquet(source)
    stream = inc.stream_of(spark, source, rows.schema, "ts", files_per_batch=1)
    totals = inc.running_totals(stream, "ts", F.col("amount"), F.col("status"), "1 day", "10 days")
    path = str(tmp_path / "totals")
    inc.drain(totals, inc.upsert_into(path, "window_start"), str(tmp_path / "c"), "update")
    got = inc.updated(spark, path, "window_start", totals.schema)
    want = rows.groupBy(F.date_trunc("day", "ts").cast("timestamp").alias("window_start")).agg(
        F.count("*").alias("total_tx"), F.count_if(F.col("status") == "FAILED").alias("failed_count"))
    names = ("window_start", "total_tx", "failed_count")
    assert shown(got, *names) == shown(want, *names)
