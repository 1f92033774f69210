import pytest
from pyspark.sql import functions as F

from ledgerguard.functions import clean
from ledgerguard.operators import checks, profile, rules


def values(frame, items, expression):
    df = frame([(v,) for v in items], "v")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_casts(frame):
    assert values(frame, [" 5 ", "", None, "1.5", "x", "+7"], lambda c: clean.clean_cast(c, "bigint")) == [5, None, None, None, None, 7]
    money = values(frame, ["1.005", "-2", "abc"], lambda c: clean.clean_cast(c, clean.MONEY).cast("string"))
    assert money == ["1.01", "-2.00", None]
    assert values(frame, ["2024", "2024-02-30", "2024-02-29"], lambda c: clean.clean_cast(c, "date").cast("string")) == [
        None, None, "2024-02-29"]
    zoned = values(frame, ["2024-01-02T03:04:05.918Z"], lambda c: clean.clean_cast(c, "timestamp_ntz").cast("string"))
    assert zoned == ["2024-01-02 03:04:05.918"]
    assert values(frame, ["8:00", "08:00", "24:00:00", "23:59:59"], clean.clean_time) == [None, "08:00:00", None, "23:59:59"]


def test_numbers(frame):
    items = ["1", "+1", "-1.5", ".5", "1e3", "1.0d", "0x10", "NaN", "inf", "1e999", "", "1 2"]
    got = values(frame, items, lambda c: clean.to_number(c).isNotNull())
    assert got == [True, True, True, True, True, False, False, True, True, False, False, False]


def test_times(frame):
    items = ["2024-01-02", "2024-01-02 03:04:05", "2024-01-02 03:04:05.123456", "2024-01-02T03:04:05Z",
             "2024-01-02T03:04:05.9+01:00", "02/01/2024", "2024-1-2", "2024-13-01", "2024", "2024-01-02T03:04:05"]
    assert values(frame, items, lambda c: clean.to_time(c).isNotNull()) == [True] * 6 + [False] * 4
    assert values(frame, ["02/01/2024"], lambda c: clean.to_time(c, day_first=False)) == [None]
    assert str(values(frame, ["02/01/2024"], clean.to_time)[0]) == "2024-01-02 00:00:00"


def test_patterns_refuse_a_final_newline(frame):
    assert values(frame, ["0123456789", "0123456789\n"], lambda c: clean.matches(c, clean.NNI)) == [True, False]


def test_trimming_takes_all_white_space(frame):
    assert values(frame, ["  a b\t "], clean.squeeze) == ["a b"]


def test_prefix_repair(frame):
    df = frame([("undefined undefined A", "X"), ("A undefined ", "X"), ("undefined B", "?"), (None, "X")], "name key")
    got = [r[0] for r in df.select(clean.fix_prefix("name", clean.lookup("key", {"X": "Ex "}), "undefined ")).collect()]
    assert got == ["Ex Ex A", "A undefined ", "B", None]


def test_types(frame):
    rows = [("1", "1", "2024-01-01", "a", "", "1"), ("+2", "1.5", "01/02/2024", "1", " ", "x")]
    got = {r[0]: r[1] for r in profile.infer_types(frame(rows, "i f d s e m")).collect()}
    assert got == {"i": "integer", "f": "float", "d": "date/datetime", "s": "string", "e": "empty", "m": "string"}


def test_profile(frame):
    df = frame([("b",), (" a ",), ("",), (None,), ("a",)], "c")
    r = profile.profile(df).first()
    assert (r["row_count"], r["empty_count"], r["empty_pct"], r["distinct_count"]) == (5, 2, 40.0, 2)
    assert (r["min"], r["max"], r["examples"]) == ("a", "b", ["a", "b"])


def test_profile_of_an_empty_column_and_an_empty_frame(frame):
    r = profile.profile(frame([("",), (None,)], "c")).first()
    assert (r["inferred_type"], r["min"], r["examples"]) == ("empty", "", [])
    assert profile.profile(frame([], "c")).count() == 0


def test_duplicates(frame):
    df = frame([("a",), ("a",), ("b",), ("",)], "c")
    r = profile.duplicates(df, ["c"], "d").first()
    assert (r["empty"], r["distinct"], r["duplicate_keys"], r["duplicate_rows"], r["strict_unique"]) == (1, 2, 1, 2, False)
    assert profile.duplicates(frame([("a",), ("b",)], "c"), ["c"]).first()["strict_unique"]


def test_malformed_numbers_count_in_checks_but_not_in_rules(frame):
    df = frame([("1", "x"), ("2", "-1"), ("3", "0"), ("4", "")], "id v")
    got = {r["rule"]: r for r in checks.run_checks(df, [
        checks.positive_check("v", "p"), checks.non_negative_check("v", "n"),
        rules.sign_rule("v", False), rules.sign_rule("v", True)]).collect()}
    assert got["p"]["count"] == 3 and got["p"]["samples"] == ["-1", "0", "x"]
    assert got["n"]["count"] == 2
    assert got["v must be > 0"]["samples"] == ["2", "3"] and got["v must be >= 0"]["samples"] == ["2"]


def test_empty_frame_reports_zero(frame):
    r = checks.run_checks(frame([], "id v"), [checks.positive_check("v", "p")]).first()
    assert (r["count"], r["samples"]) == (0, [])


def test_references(frame):
    df = frame([("1", "One"), ("1", "Uno"), ("9", "Nine"), ("", "x"), ("1", "")], "id name")
    ref = frame([("1", "One"), ("2", "Two")], "id name")
    r = checks.check_in_reference(df, "id", ref, "id").first()
    assert (r["count"], r["samples"]) == (1, ["9"])
    p = checks.check_pair(df, "id", "name", ref, "id", "name").first()
    assert (p["count"], p["samples"]) == (1, ["1 => expected=One, got=Uno"])


def test_row_rules(frame):
    rows = [("1", "FAILED", "5", "5.00", "2024-01-02", "2024-01-01", "n1", "n2", "2", "1"),
            ("2", "FAILED", "5", "6", "2024-01-01", "2024-01-02", "n1", "n1", "1", "2"),
            ("3", "ODD", "5", "x", "2024-01-01", "", "n1", "", "", "1"),
            ("4", "FAILED", "NaN", "NaN", "02/01/2024", "01/01/2024", "", "n", "x", "1")]
    df = frame(rows, "id status balance_before balance_after created_at completed_at a b available_balance balance")
    got = {r["rule"]: r["samples"] for r in checks.run_checks(df, [
        rules.failed_balance_rule(), rules.date_order_rule(), rules.status_rule(),
        rules.columns_differ_rule("a", "b"), rules.available_over_balance_rule()]).collect()}
    assert got["FAILED => balance_before == balance_after"] == ["2", "4"]
    assert got["completed_at >= created_at"] == ["1"]
    assert got["status must be one of allowed values"] == ["3:ODD"]
    assert got["a != b"] == ["1"]
    assert got["available_balance <= balance"] == ["1"]


def test_strict_time(frame):
    from ledgerguard.functions.clean import clean_cast
    good, bad = frame([("08:15",), ("",), (None,)], "t"), frame([("25:99",)], "t")
    assert [r[0] for r in good.select(clean_cast("t", "time", strict=True)).collect()] == ["08:15:00", None, None]
    assert bad.select(clean_cast("t", "time")).first()[0] is None
    with pytest.raises(Exception, match="malformed time"):
        bad.select(clean_cast("t", "time", strict=True)).collect()
