import pytest
from pyspark.sql import functions as F

from ledgerguard import session as sessions
from ledgerguard.operators import core
from ledgerguard.plans import refresh as flow
from ledgerguard.schemas import STAGING
from ledgerguard.sources.csv import malformed_rows, read_lenient, read_raw
from ledgerguard.sources.layers import LayerStore, issue_rows, upsert, write_fact, write_report
from tests import ledger as L


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_empty_cells_keep_their_kind(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,a,b\n1,,""\n2,"x, ""y""",Télécom\n3,NaN, padded \n')
    rows = {r["id"]: r for r in read_raw(spark, path, ["id", "a", "b"]).collect()}
    assert rows["1"]["a"] is None and rows["1"]["b"] == ""
    assert rows["2"]["a"] == 'x, "y"' and rows["2"]["b"] == "Télécom"
    assert rows["3"]["a"] == "NaN" and rows["3"]["b"] == " padded "
    assert rows["1"]["loaded_at"] is not None


def test_no_row_is_lost(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,a,b\n1\n2,x\n3,x,y,z\n4,x,y\n")
    rows = read_raw(spark, path, ["id", "a", "b"]).collect()
    assert sorted(r["id"] for r in rows) == ["1", "2", "3", "4"]
    assert [r["a"] for r in rows if r["id"] == "1"] == [None]


def test_header_must_match(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,other\n1,2\n")
    with pytest.raises(Exception):
        read_raw(spark, path, ["id", "a"]).collect()


def test_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,a\n1,"two\nlines"\n2,x\n')
    rows = read_raw(spark, path, ["id", "a"], multi_line=True).collect()
    assert [r["a"] for r in rows] == ["two\nlines", "x"]


def test_lenient_reader(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id , name,note\n1,  x y \t\n2\n3,a,b,c\n")
    df = read_lenient(spark, path)
    assert df.columns == ["id", "name", "note"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x y", ""), ("2", "", ""), ("3", "a", "b")]


def test_first_row_of_the_file_wins(spark, tmp_path):
    lines = "\n".join(f"{i % 3},{9 - i}" for i in range(9))
    path = write(tmp_path / "a.csv", f"id,v\n{lines}\n")
    df = read_raw(spark, path, ["id", "v"], position=True).repartition(4)
    got = {r["id"]: r["v"] for r in core.first_wins(df, "id").collect()}
    assert got == {"0": "9", "1": "8", "2": "7"}


def test_a_failed_refresh_leaves_the_old_version(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layers"))
    store.replace(spark.range(3), "core", "t")
    with pytest.raises(Exception):
        store.replace(spark.range(5).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id")), "core", "t")
    assert store.read("core", "t").count() == 3
    store.replace(spark.range(4), "core", "t")
    assert store.read("core", "t").count() == 4
    store.replace(spark.range(6), "core", "t")
    store.drop_old(keep=1)
    assert store.versions("core", "t") == [store.versions("core", "t")[-1]] and store.read("core", "t").count() == 6


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        LayerStore(spark, str(tmp_path)).read("core", "none")


def test_fact_is_pruned_by_quarter(spark, tmp_path):
    days = spark.range(400).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    path = str(tmp_path / "fact")
    write_fact(days, path, "d")
    quarter = spark.read.parquet(path).where("tx_quarter = '2024q2'")
    assert quarter.count() == 91
    assert "PartitionFilters: [isnotnull(tx_quarter" in quarter._jdf.queryExecution().executedPlan().toString()


def test_payload_keeps_null_fields(frame):
    df = frame([("1", "r", "k", None)], "id reference idempotency_key amount")
    row = issue_rows(df, "c", "d", "reject").first()
    assert row["raw_payload"] == '{"id":"1","reference":"r","idempotency_key":"k","amount":null}'
    assert row["reject_reason"] == "c"


def test_upsert(frame):
    old = frame([("a", "1"), ("b", "2")], "code text")
    new = frame([("b", "3"), ("c", "4")], "code text")
    assert sorted(tuple(r) for r in upsert(old, new, "code").collect()) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("r", ["a", "b"])], "rule string, samples array<string>")
    for fmt in ("parquet", "json"):
        write_report(df, str(tmp_path / fmt), fmt)
        assert spark.read.format(fmt).load(str(tmp_path / fmt)).first()["samples"] == ["a", "b"]


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = sessions.scratch(spark, "x")
    assert path != sessions.scratch(spark, "x")
    assert not shared or path.startswith(shared.rstrip("/"))


# -- the whole flow from files ---------------------------------------------------------------------

def csv_of(columns, used, rows):
    """CSV text: NULL as nothing, '' as quotes, columns that the rows do not have empty."""
    names = used.split()
    lines = [",".join(columns)]
    for row in rows:
        cells = dict(zip(names, row))
        lines.append(",".join(
            "" if cells.get(c) is None else '"' + cells[c].replace('"', '""') + '"' for c in columns))
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def raw_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    users = [u for u in L.USER_ROWS if "\n" not in u[1]]
    types = [(str(i), c, "", "", "false", "false", "false", "false")
             for i, c in enumerate("DEP WIT TRF PAY BIL AIR SAL REV".split(), 1)]
    parts = {
        "users": (L.USERS, users), "accounts": (L.ACCOUNTS, L.ACCOUNT_ROWS),
        "merchants": (L.MERCHANTS, L.MERCHANT_ROWS), "agencies": (L.AGENCIES, L.AGENCY_ROWS),
        "transactions": (L.TX, L.rows()),
        "wilayas": ("id code name", [("1", "W1", "North"), ("2", "W2", "South")]),
        "tx_types": (" ".join(STAGING["tx_types"]), types),
        "categories": ("id code mcc", [("1", "ALM", "5411"), ("2", "RST", "5812")]),
    }
    return {
        name: write(folder / f"{name}.csv", csv_of(STAGING[name], used, rows))
        for name, (used, rows) in parts.items()
    }


def test_refresh_from_files(spark, raw_files, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layers"))
    flow.stage(spark, store, raw_files)
    sizes = {"wilayas": 2, "tx_types": 8, "categories": 2}
    counts = {r["table_name"]: r["row_count"] for r in flow.refresh(spark, store, sizes, drop_repeats=False).collect()}
    routes = [route for _, route, _ in L.CASES.values()]
    reasons = [c for _, route, codes in L.CASES.values() for c in codes if route == "QUARANTINE"]
    conflicts = [c for _, _, codes in L.CASES.values() for c in codes if c == "idempotency_conflict"]
    anomalies = [c for _, route, codes in L.CASES.values() for c in codes if route == "ANOMALY"]
    assert counts["staging.transactions"] == len(L.CASES)
    assert counts["core.transactions"] == routes.count("CORE")
    assert counts["quarantine.quarantine_transactions"] == len(reasons)
    assert counts["anomalies.idempotency_conflicts"] == len(conflicts)
    assert counts["anomalies.transaction_anomalies"] == len(anomalies) - len(conflicts)
    assert counts["core.users"] == 5 and counts["core.accounts"] == 4

    before = sorted(store.read("core", "transactions").collect())
    flow.refresh(spark, store, sizes, drop_repeats=False)
    assert sorted(store.read("core", "transactions").collect()) == before
    shares = {r["layer"]: r["rows"] for r in flow.shares(store).collect()}
    assert shares["CORE (trusted)"] == routes.count("CORE")

    # By default the first of exact repeats stays and the others are reported.
    flow.refresh(spark, store, sizes)
    keys = [r["idempotency_key"] for r in store.read("core", "transactions").where("idempotency_key <> ''").collect()]
    repeats = store.read("reports", "repeated_transactions").count()
    assert len(keys) == len(set(keys)) and repeats == 1
    assert store.read("core", "transactions").count() == routes.count("CORE") - repeats
    assert store.read("staging", "malformed_rows").count() == 0


def test_a_run_that_dies_leaves_all_layers(spark, raw_files, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path / "layers"))
    flow.stage(spark, store, raw_files)
    sizes = {"wilayas": 2, "tx_types": 8, "categories": 2}
    flow.refresh(spark, store, sizes)
    seen = store.manifest()

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(flow, "constraint_report", lost)
    with pytest.raises(RuntimeError, match="lost"):
        flow.refresh(spark, store, sizes)
    assert store.manifest() == seen
    assert store.versions("core", "users")[-1] > seen["core.users"]
    assert store.read("core", "users").inputFiles()[0].count(f"v={seen['core.users']}/") == 1


def test_malformed_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n2\n3,y,z\n4,w\n")
    path = str(tmp_path / "x.csv")
    assert sorted(r["record"] for r in malformed_rows(spark, path, ["a", "b"]).collect()) == ["2", "3,y,z"]
    assert read_raw(spark, path, ["a", "b"]).count() == 4
    with pytest.raises(Exception):
        read_raw(spark, path, ["a", "b"], strict=True).collect()


def test_refresh_stops_on_a_wrong_lookup(spark, raw_files, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layers"))
    flow.stage(spark, store, raw_files)
    with pytest.raises(AssertionError, match="wilayas"):
        flow.refresh(spark, store)


def test_explorer(spark, raw_files):
    from ledgerguard.plans import explore
    reports = explore.explore(explore.load(spark, raw_files))
    formats = {r["rule"]: r["count"] for r in reports["formats"].collect()}
    assert formats["nni must be 10 digits"] == 1
    assert formats["transactions.amount > 0"] == 3
    assert formats["transactions.balance_after >= 0"] == 2
    rules = {r["rule"]: r["count"] for r in reports["transaction_rules"].collect()}
    assert rules["FAILED => balance_before == balance_after"] == 2
    assert rules["amount must be > 0"] == 3 and rules["completed_at >= created_at"] == 1
    assert rules["same idempotency_key with different payload"] == 2
    orphans = {r["column"]: r["count"] for r in reports["orphans"].collect()}
    assert orphans["source_account_id"] == 3 and orphans["destination_account_id"] == 1
    assert orphans["merchant_id"] == 1 and orphans["agency_id"] == 1
    dup = {(r["dataset"], r["column"]): r["duplicate_rows"] for r in reports["duplicates"].collect()}
    assert dup[("transactions", "idempotency_key")] == 8 and dup[("users", "phone")] == 2
    kinds = {(r["dataset"], r["column"]): r["inferred_type"] for r in reports["profiling"].collect()}
    assert kinds[("transactions", "id")] == "integer" and kinds[("transactions", "description")] == "empty"
    assert kinds[("transactions", "created_at")] == "date/datetime"
    assert all(r["count"] == 0 for r in reports["pair_consistency"].collect())
    assert {r["column"]: r["count"] for r in reports["references"].where("dataset = 'merchants'").collect()}["category_code"] == 1
