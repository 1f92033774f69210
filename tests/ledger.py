"""The truth-table ledger: hand-made rows, at least one per rule."""

TX = ("id reference idempotency_key transaction_type amount fee total_amount currency source_account_id "
      "destination_account_id merchant_id agency_id status failure_reason balance_before balance_after "
      "sequence_number transaction_date transaction_time created_at completed_at")

GOOD = dict(
    transaction_type="TRF", amount="100.00", fee="1.00", total_amount="101.00", currency="MRU",
    source_account_id="1", destination_account_id="2", merchant_id="", agency_id="", status="SUCCESS",
    failure_reason="", balance_before="500.00", balance_after="399.00", sequence_number="1",
    transaction_date="2024-03-01", transaction_time="10:00:00", created_at="2024-03-01T10:00:00.000Z",
    completed_at="2024-03-01T10:00:05.000Z")

# number -> (changes, route, reasons)
CASES = {
    1: ({}, "CORE", []),
    2: (dict(status="FAILED", balance_after="500.00"), "CORE", []),
    3: (dict(status="FAILED", balance_after="400.00"), "ANOMALY", ["invalid_failed_balance"]),
    4: (dict(status="FAILED", balance_before="5", balance_after="5.00"), "CORE", []),
    5: (dict(amount="0"), "ANOMALY", ["invalid_amount"]),
    6: (dict(amount="-800"), "ANOMALY", ["invalid_amount"]),
    7: (dict(amount=None), "CORE", []),
    8: (dict(balance_after="-1"), "ANOMALY", ["negative_balance"]),
    9: (dict(status="FAILED", balance_after="-1"), "ANOMALY", ["invalid_failed_balance", "negative_balance"]),
    10: (dict(idempotency_key="ka"), "ANOMALY", ["idempotency_conflict"]),
    11: (dict(idempotency_key="ka", amount="101.00"), "ANOMALY", ["idempotency_conflict"]),
    12: (dict(idempotency_key="kb"), "CORE", []),
    13: (dict(idempotency_key="kb"), "CORE", []),
    14: (dict(idempotency_key="kc", status="PENDING"), "ANOMALY", ["idempotency_conflict"]),
    15: (dict(idempotency_key="kc", destination_account_id=""), "ANOMALY", ["idempotency_conflict"]),
    16: (dict(idempotency_key="kd"), "CORE", []),
    17: (dict(idempotency_key="kd", destination_account_id=None), "QUARANTINE", ["missing_destination_account"]),
    18: (dict(idempotency_key=""), "CORE", []),
    19: (dict(idempotency_key="", amount="7.00"), "CORE", []),
    20: (dict(source_account_id=""), "QUARANTINE", ["missing_source_account"]),
    21: (dict(source_account_id="999"), "QUARANTINE", ["missing_source_account"]),
    22: (dict(source_account_id="999", destination_account_id="998"), "QUARANTINE",
         ["missing_source_account", "missing_destination_account"]),
    23: (dict(transaction_type="DEP", destination_account_id=""), "QUARANTINE", ["missing_destination_account"]),
    24: (dict(transaction_type="PAY"), "QUARANTINE", ["missing_merchant"]),
    25: (dict(merchant_id="999"), "QUARANTINE", ["missing_core_reference"]),
    26: (dict(agency_id="abc"), "CORE", []),
    27: (dict(source_account_id="5"), "QUARANTINE", ["missing_core_reference"]),
    28: (dict(amount="0", source_account_id="999"), "ANOMALY", ["invalid_amount"]),
    29: (dict(completed_at="2024-02-28T10:00:00.000Z"), "CORE", []),
    30: (dict(reference="TX1"), "CORE", []),
    31: (dict(currency="", fee=""), "CORE", []),
    32: (dict(transaction_type="PAY", merchant_id="1", agency_id="2"), "CORE", []),
}


def rows(cases=CASES):
    out = []
    for n, (changes, _, _) in cases.items():
        row = {"id": str(n), "reference": f"TX{n}", "idempotency_key": f"k{n}", **GOOD, **changes}
        out.append(tuple(row[c] for c in TX.split()))
    return out


USERS = "id nni phone full_name gender birth_date email wilaya_id status registration_date created_at updated_at"
USER_ROWS = [
    (str(i), f"000000000{i}", f"+2220000000{i}", f"User {i}", "F", "1990-01-01", "", "1", "ACTIVE", "2020-01-01",
     "2020-01-01T00:00:00.000Z", "") for i in (1, 2, 3, 4)
] + [
    ("5", "030164XX71", "+22200000005", "Bad number", "M", "1990-01-01", "", "1", "ACTIVE", "2020-01-01", "", ""),
    ("6", "0000000006\n", "+22200000006", "Line break", "M", "1990-01-01", "", "1", "ACTIVE", "2020-01-01", "", ""),
    ("7", "0000000007", "+22200000001", "Same phone", "M", "1990-01-01", "", "1", "ACTIVE", "2020-01-01", "", ""),
    ("4", "0000000008", "+22200000008", "Zed again", "M", "1990-01-01", "", "1", "ACTIVE", "2020-01-01", "", ""),
    ("9", "0000000009", "+22200000009", "No region", "M", "1990-01-01", "", "", "ACTIVE", "2020-01-01", "", ""),
]

ACCOUNTS = ("id user_id account_number account_type currency balance available_balance daily_limit monthly_limit "
            "status is_primary opened_date last_activity created_at updated_at")
ACCOUNT_ROWS = [
    (str(i), str(i), f"A{i}", "WALLET", "", "10.00", "10.00", "1.00", "1.00", "ACTIVE",
     {1: "true", 2: "yes"}.get(i, "false"), "2020-01-01", "", "", "") for i in (1, 2, 3, 4, 5)
]

MERCHANTS = "id code name category_code wilaya_id status created_at"
MERCHANT_ROWS = [
    ("1", "M1", "undefined El Khair", "ALM", "1", "ACTIVE", "2021-01-01T00:00:00.000Z"),
    ("2", "M2", "undefined Progrès", "???", "1", "ACTIVE", ""),
    ("3", "M3", "Chez undefined ", "RST", "1", "", ""),
    ("4", "", "No code", "RST", "1", "", ""),
]

AGENCIES = "id code name wilaya_id float_balance tier license_number status created_at"
AGENCY_ROWS = [
    ("1", "G1", "One", "1", "", "GOLD", "L1", "ACTIVE", ""),
    ("2", "G2", "Two", "1", "5.50", "SILVER", "L2", "ACTIVE", ""),
]
