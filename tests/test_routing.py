import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerguard.operators import anomalies, core, quarantine, routing
from ledgerguard.operators.constraints import ConstraintError, constraint_report, table_report
from tests import ledger as L


@pytest.fixture(scope="module")
def dims(spark):
    def make(rows, columns):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))
    staged = make(L.ACCOUNT_ROWS, L.ACCOUNTS)
    users = core.core_users(make(L.USER_ROWS, L.USERS)).cache()
    return {
        "staged": staged, "users": users, "accounts": core.core_accounts(staged, users).cache(),
        "merchants": core.core_merchants(make(L.MERCHANT_ROWS, L.MERCHANTS)).cache(),
        "agencies": core.core_agencies(make(L.AGENCY_ROWS, L.AGENCIES)).cache(),
    }


def run(tx, dims, **options):
    return routing.route(
        tx, dims["staged"], dims["accounts"], dims["merchants"], dims["agencies"], **options)


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(L.rows(), ", ".join(f"{c} string" for c in L.TX.split()))


def test_truth_table(tx, dims):
    got = {int(r["id"]): (r["route"], sorted(r["reasons"])) for r in run(tx, dims).collect()}
    assert got == {n: (route, sorted(reasons)) for n, (_, route, reasons) in L.CASES.items()}


def test_text_comparison_tells_5_from_5_00(tx, dims):
    routes = {r["id"]: r["route"] for r in run(tx, dims, text_compare=True).collect()}
    assert routes["4"] == "ANOMALY" and routes["2"] == "CORE"


def test_stored_tables_give_the_same_core(tx, dims):
    flagged, conflicts = anomalies.transaction_anomalies(tx), anomalies.idempotency_conflicts(tx)
    held = quarantine.quarantine(
        tx, [flagged, conflicts], dims["staged"], dims["accounts"], dims["merchants"], dims["agencies"])
    by_tables = core.core_transactions(tx, flagged, conflicts, held)
    by_route = core.core_from_route(run(tx, dims))
    assert sorted(by_tables.collect()) == sorted(by_route.collect())
    pairs = {(r["staging_transaction_id"], r["reject_reason"]) for r in held.collect()}
    assert pairs == {(str(n), c) for n, (_, route, codes) in L.CASES.items() if route == "QUARANTINE" for c in codes}


def test_issue_rows_keep_the_whole_row(tx):
    row = anomalies.invalid_amount(tx).where("staging_transaction_id = '5'").first()
    assert '"amount":"0"' in row["raw_payload"] and row["created_at"] is not None


def test_conflict_groups_count_values(spark, tx):
    groups = {r["idempotency_key"]: r for r in anomalies.conflict_groups(tx).collect()}
    assert set(groups) == {"ka", "kc"}
    assert groups["ka"]["duplicate_count"] == 2 and groups["ka"]["distinct_amount"] == 2
    assert groups["kc"]["distinct_destination_account_id"] == 2  # '' is a value


def test_empty_text_conflicts_but_null_does_not(frame):
    columns = "id reference idempotency_key amount status source_account_id destination_account_id"
    rows = [("1", "r", "a", "5", "S", "1", ""), ("2", "r", "a", "5", "S", "1", "2"),
            ("3", "r", "b", "5", "S", "1", None), ("4", "r", "b", "5", "S", "1", "2")]
    keys = {r[0] for r in anomalies.conflict_keys(frame(rows, columns)).collect()}
    assert keys == {"a"}


def test_one_anomalous_copy_holds_back_the_other(spark, dims):
    good = L.rows({1: L.CASES[1]})[0]
    bad = L.rows({1: (dict(amount="0", idempotency_key="other"), "", [])})[0]
    df = spark.createDataFrame([good, bad], ", ".join(f"{c} string" for c in L.TX.split()))
    assert {r["route"] for r in run(df, dims).collect()} == {"ANOMALY"}


def test_dimensions(dims):
    users = {r["id"]: r["full_name"] for r in dims["users"].collect()}
    assert set(users) == {1, 2, 3, 4, 7} and users[4] == "User 4"
    accounts = {r["id"]: r for r in dims["accounts"].collect()}
    assert set(accounts) == {1, 2, 3, 4}
    assert accounts[1]["is_primary"] and not accounts[2]["is_primary"] and accounts[1]["currency"] == "MRU"
    merchants = {r["id"]: r["name"] for r in dims["merchants"].collect()}
    assert merchants == {1: "Alimentation El Khair", 2: "Progrès", 3: "Chez undefined "}
    agencies = {r["id"]: r["float_balance"] for r in dims["agencies"].collect()}
    assert agencies[1] is None and float(agencies[2]) == 5.5


def test_constraints_show_what_routing_does_not(tx, dims):
    rows = core.core_from_route(run(tx, dims), drop_repeats=False)
    parents = {k: dims[k] for k in ("accounts", "merchants", "agencies")}
    report = {r["constraint"]: r for r in table_report("transactions", rows, parents, tx).collect()}
    broken = {c: r["violations"] for c, r in report.items() if r["violations"]}
    assert broken == {
        "not_null:amount": 1, "check:completed_after_created": 1, "unique:reference": 1,
        "unique:idempotency_key": 2, "cast:agency_id": 1}
    assert report["unique:reference"]["samples"] == ["TX1"]
    assert report["check:completed_after_created"]["samples"] == ["29"]


def test_strict_report_raises(tx, dims):
    with pytest.raises(ConstraintError):
        constraint_report({"transactions": core.core_from_route(run(tx, dims))}, strict=True)


def test_repeats_can_be_dropped(tx, dims):
    rows = core.core_from_route(run(tx, dims), drop_repeats=True)
    ids = {r["id"] for r in rows.collect()}
    assert 12 in ids and 13 not in ids and {18, 19} <= ids


def test_lookup_with_a_repeated_key_fails(frame):
    columns = "id code label description requires_destination requires_merchant requires_agency is_credit"
    row = ("1", "DEP", "", "", "false", "false", "false", "")
    assert core.load_lookup(frame([row], columns), "tx_types").count() == 1
    with pytest.raises(Exception, match="duplicate id"):
        core.load_lookup(frame([row, row], columns), "tx_types").collect()


def test_merchant_code_loses_leading_zeros(frame):
    df = frame([("1", "ALM", "0541", "", "", "1", "2")], "id code mcc label description avg_min avg_max")
    assert core.load_lookup(df, "categories").first()["mcc"] == "541"


def test_count_assertion(spark):
    core.assert_count(spark.range(15), 15)
    for n in (14, 16):
        with pytest.raises(AssertionError):
            core.assert_count(spark.range(n), 15)


def test_strict_cast_raises(spark, tx):
    with pytest.raises(Exception):
        core.cast_transactions(tx, strict=True).collect()


def test_required_by_type(frame, tx):
    types = frame(
        [("TRF", True, False, False), ("PAY", False, True, True)],
        "code requires_destination requires_merchant requires_agency", ["string"] + ["boolean"] * 3)
    got = {(r[0], r[3]) for r in quarantine.missing_required(tx, types).collect()}
    assert ("17", "missing_destination_account") in got and ("24", "missing_agency") in got
    assert ("24", "missing_merchant") in got and ("23", "missing_destination_account") not in got


row = st.fixed_dictionaries({
    "amount": st.sampled_from(["10.00", "0", "-3", "", None]),
    "status": st.sampled_from(["SUCCESS", "FAILED", "PENDING"]),
    "balance_after": st.sampled_from(["500.00", "1.00", "-1"]),
    "source_account_id": st.sampled_from(["1", "5", "99", "", None]),
    "destination_account_id": st.sampled_from(["1", "2", "98", "", None]),
    "merchant_id": st.sampled_from(["", "1", "77", "x"]),
    "transaction_type": st.sampled_from(["PAY", "TRF"]),
    "key": st.integers(0, 4),
})


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_invariants(spark, dims, changes):
    """Each id has one route; nothing is lost; order does not matter; core keeps its rules."""
    cases = {n: ({**{k: v for k, v in c.items() if k != "key"}, "idempotency_key": f"k{c['key']}"}, "", [])
             for n, c in enumerate(changes)}
    data = L.rows(cases)
    schema = ", ".join(f"{c} string" for c in L.TX.split())
    first = {r["id"]: (r["route"], tuple(r["reasons"])) for r in run(spark.createDataFrame(data, schema), dims).collect()}
    assert len(first) == len(data)
    shuffled = data[:]
    random.Random(1).shuffle(shuffled)
    routed = run(spark.createDataFrame(shuffled, schema), dims).cache()
    assert {r["id"]: (r["route"], tuple(r["reasons"])) for r in routed.collect()} == first
    for route, reasons in first.values():
        assert (route == "CORE") == (not reasons)
    kept = core.core_from_route(routed)
    bad = kept.where("amount <= 0 or balance_after < 0 or (status = 'FAILED' and balance_after <> balance_before)")
    assert bad.count() == 0
    assert kept.join(dims["accounts"], kept["source_account_id"] == dims["accounts"]["id"], "left_anti").count() == 0
